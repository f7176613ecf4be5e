"""Benchmark decontamination by spaced-seed hashing.

Each mask picks ``WEIGHT`` of the tokens (words, A-Z lower-cased) in a short window; the hash of the picked tokens ignores
the others, so a substituted word spoils only the masks that pick it. Hashes of every position of every test item are
joined with those of every position of every training text. Around a hit, text and item are compared token by token
along the hit's diagonal: an overlap of ``WINDOW`` tokens, or of the whole item if it is shorter, of which at least
``SIMILAR`` are equal is a leak.

Before the join, a Bloom filter of the items' hashes (its size is fixed, whatever the benchmark's) lets a text's hits
through and nearly nothing else; with them go the token hashes around, so no text is shuffled.

Nulls and odd cases: NULL texts count as empty; items of fewer than ``WEIGHT`` words match nothing; items or documents
without an id are compared too and come back with a NULL id; repeated rows come back each; an empty benchmark leaves
every document clean; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Bloom, bloom_test, plain_text, stage, without
from .paragraphs import Cutter, runs

# The masks; 1 marks a token that counts.
MASKS = ("11111", "1101011", "110010011", "10110001001", "111000101", "1010100011")
WEIGHT = 5
SPAN = max(map(len, MASKS))
WINDOW = 20
SIMILAR = 0.8
MIX = np.uint64(0x9E3779B97F4A7C15)


def seeds(tokens: np.ndarray, mask: int) -> np.ndarray:
    """The hash under a mask at each position where it fits."""
    picked = [i for i, c in enumerate(MASKS[mask]) if c == "1"]
    size = max(0, len(tokens) - len(MASKS[mask]) + 1)
    out = np.full(size, mask + 1, dtype=np.uint64)
    for i in picked:
        out = (out ^ (out >> np.uint64(32))) * MIX + tokens[i:i + size]
    return ((out ^ (out >> np.uint64(29))) * MIX).view(np.int64)


def hits(tokens: np.ndarray, ends: np.ndarray, filled: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) where seeds of texts that follow each other, up to ``ends``, may be those of an item."""
    at, found = [], []
    for mask in range(len(MASKS)):
        codes = seeds(tokens, mask)
        where = np.arange(len(codes))
        for probe in range(Bloom.PROBES):  # few are left after the first
            where = where[bloom_test(filled, codes[where] >> np.int64(13 * probe), bits - 1, 1)]
        # Others run on into the next text.
        where = where[where + len(MASKS[mask]) <= ends[np.searchsorted(ends, where, "right")]]
        at.append(where)
        found.append(codes[where])
    return np.concatenate(at), np.concatenate(found)


def regions(at: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Stretches of tokens around hits; each holds every window that a hit in it could be verified in."""
    out: list[tuple[int, int]] = []
    for position in np.unique(at).tolist():
        low, high = max(0, position - WINDOW), min(length, position + SPAN + WINDOW)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def equal_share(text: np.ndarray, start: int, item: np.ndarray, diagonal: int) -> float:
    """The largest share of equal tokens in a window on a diagonal (text position less item position)."""
    low, high = max(start, diagonal), min(start + len(text), diagonal + len(item))
    window = min(WINDOW, len(item))
    if high - low < window:
        return 0.0
    same = np.concatenate([[0], np.cumsum(text[low - start:high - start] == item[low - diagonal:high - diagonal])])
    return float((same[window:] - same[:-window]).max()) / window


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, tokens) of items with words enough."""

    @F.pandas_udf("array<long>")
    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cutter = Cutter()
        for texts in batches:
            yield pd.Series([cutter.tokens([text])[0].view(np.int64).tolist() for text in texts], dtype=object)

    return benchmark.select(
        F.col("item_id").cast("long"), hashes(plain_text()).alias("tokens")
    ).where(F.size("tokens") >= WEIGHT).distinct()


def item_seeds(items: DataFrame) -> DataFrame:
    """(hash, item, item_pos): the seeds of every position of every item; ``item`` numbers it by its tokens."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for item, tokens in zip(frame["item"], frame.tokens):
                tokens = np.asarray(tokens, dtype=np.int64).view(np.uint64)
                for mask in range(len(MASKS)):
                    codes = seeds(tokens, mask)
                    yield pd.DataFrame({"hash": codes, "item": item, "item_pos": np.arange(len(codes))})

    return items.mapInPandas(cut, "hash long, item long, item_pos int")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, key, item_ids, share) of the documents with a leak; ``key`` is the text's xxhash64."""
    named = items_of(benchmark).withColumn("item", F.xxhash64("tokens"))
    # Items of equal tokens are compared once.
    items = stage(named.groupBy("item").agg(F.first("tokens").alias("tokens"), F.collect_set("item_id").alias("item_ids")),
                  "leak-items")
    seeds_of_items = stage(item_seeds(items.select("item", "tokens")), "leak-seeds")
    bloom = Bloom(seeds_of_items.select("hash").distinct())
    filled, bits = bloom.shared, bloom.bits

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = Cutter()
        for frame in frames:
            out = []
            for part in runs(frame):
                tokens, ends = cutter.tokens(part.text)
                at, found = hits(tokens, ends, filled.value, bits)
                owner = np.searchsorted(ends, at, "right")
                for k in np.unique(owner).tolist():
                    first = ends[k - 1] if k else 0
                    own, codes = at[owner == k] - first, found[owner == k]
                    for low, high in regions(own, ends[k] - first):
                        inside = (own >= low) & (own < high)
                        out.append((part.doc_id.iloc[k], part.key.iloc[k], low, tokens[first + low:first + high].view(np.int64),
                                    own[inside], codes[inside]))
            yield pd.DataFrame(out, columns=["doc_id", "key", "start", "tokens", "at", "hash"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), plain_text().alias("text"))
    found = stage(
        rows.mapInPandas(
            scan, "doc_id long, key long, start int, tokens array<long>, at array<int>, hash array<long>"
        ).withColumn("region", F.xxhash64("doc_id", "key", "start", F.monotonically_increasing_id())),
        "leak-regions",
    )
    pairs = (
        found.select("region", F.explode(F.arrays_zip("at", "hash")).alias("hit"))
        .select("region", F.col("hit.at").alias("at"), F.col("hit.hash").alias("hash"))
        .join(seeds_of_items, "hash")
        .select("region", "item", (F.col("at") - F.col("item_pos")).alias("diagonal")).distinct()
    )

    @F.pandas_udf("double")
    def compare(text: pd.Series, start: pd.Series, item: pd.Series, diagonal: pd.Series) -> pd.Series:
        return pd.Series([
            equal_share(np.asarray(t), s, np.asarray(i), d) for t, s, i, d in zip(text, start, item, diagonal)
        ], dtype="float64")

    seen = (
        pairs.join(found.select("region", "doc_id", "key", "start", F.col("tokens").alias("text")), "region")
        .join(items, "item")
        .withColumn("share", compare("text", "start", "tokens", "diagonal"))
        .where(F.col("share") >= SIMILAR)
    )
    return seen.select("doc_id", "key", "share", F.explode("item_ids").alias("item_id")).groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("share").alias("share"))


def marked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, item_ids, share) of every row of ``docs (doc_id, text)``."""
    found = stage(leaks(docs, benchmark), "leaks").withColumnRenamed("doc_id", "d").withColumnRenamed("key", "k")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"))
    return rows.join(found, rows.doc_id.eqNullSafe(found.d) & (rows.key == found.k), "left").select(
        "doc_id", F.col("k").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"), F.coalesce("share", F.lit(0.0)).alias("share"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a leak, all their columns kept."""
    return without(docs, stage(leaks(docs, benchmark).select("doc_id", "key"), "leaks"))
