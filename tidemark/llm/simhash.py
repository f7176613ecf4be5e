"""SimHash near-duplicates through pivot distance tables.

A text's fingerprint has 64 bits over its 3-word shingles. Linked are fingerprints at Hamming distance 2 or less.

The pivots are eight fixed 64-bit reference fingerprints. The distance to a pivot is precomputed in four parts, one for
each 16-bit segment, so a fingerprint has four rows of eight coordinates; a row is packed into one long. A coordinate
differs by at most the distance of the two segments, and the distances of the segments add up to that of the
fingerprints. Hence, within distance 2, two of the four rows at least are equal in every coordinate: the join keys are
the six pairs of rows. A colliding pair is discarded if the largest coordinate differences of its rows add up to more
than 2, and verified by the fingerprints themselves otherwise. Discarding happens inside the join, which emits true links
only.

Copies are summed up before anything is joined: the tables hold each fingerprint once. A key that more than ``HOT``
different fingerprints share is not paired. Its fingerprints meet, exactly, at the 65 values within one bit of each:
two are within distance 2 if and only if they have such a value in common, and a value has at most 65 of them.

Nulls and odd cases: a NULL text counts as empty; without words the fingerprint is zero; shorter texts than three words
hash as one sequence; repeated rows come back each; a NULL id is kept and is never the smallest; extra columns go.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import components, plain_text, stage, without, words

SHINGLE = 3
SEED = 42
DISTANCE = 2
HOT = 1000  # different fingerprints of one key that are still paired
PIVOTS = 8
SEGMENTS = 4
WIDTH = 16
STEP = 5  # bits of a packed coordinate, which is at most 16
SLICE = 1 << 16  # hashes whose bits are counted at once


def shingles(text: str) -> list[bytes]:
    w = words(text)
    if len(w) < SHINGLE:
        return [b" ".join(w)] if w else []
    return [a + b" " + b + b" " + c for a, b, c in zip(w, w[1:], w[2:])]


def fingerprint(text: str) -> int:
    """The fingerprint as a signed 64-bit number."""
    found = shingles(text)
    if not found:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(found), SLICE):
        part = found[at:at + SLICE]
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in part), dtype="<u8", count=len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(found), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, key, fp) of every row; ``key`` is the text's xxhash64."""

    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(text) for text in texts], dtype="int64")

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), simhash(plain_text()).alias("fp"))


def pivot(number: int, segment: int) -> int:
    """A segment of a reference fingerprint."""
    return xxh64_intdigest(b"pivot %d %d" % (number, segment)) & ((1 << WIDTH) - 1)


def row_of(fp: Column, segment: int) -> Column:
    """The packed distances of a fingerprint's segment to the pivots."""
    part = F.shiftrightunsigned(fp, segment * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))
    total = F.lit(0).cast("long")
    for i in range(PIVOTS):
        distance = F.bit_count(part.bitwiseXOR(F.lit(pivot(i, segment)))).cast("long")
        total = total.bitwiseOR(F.shiftleft(distance, i * STEP))
    return total


def difference(a: Column, b: Column) -> Column:
    """The largest difference of two packed rows' coordinates."""
    mask = F.lit((1 << STEP) - 1)
    return F.greatest(*[
        F.abs(F.shiftright(a, i * STEP).bitwiseAND(mask) - F.shiftright(b, i * STEP).bitwiseAND(mask))
        for i in range(PIVOTS)
    ])


def pivot_table(distinct: DataFrame) -> DataFrame:
    """One row per fingerprint and pair of segments: the key (which, k1, k2), the rest (r1, r2) and fp."""
    rows = distinct.select("fp", *[row_of(F.col("fp"), s).alias(f"s{s}") for s in range(SEGMENTS)])
    entries = []
    for number, (s, t) in enumerate(combinations(range(SEGMENTS), 2)):
        u, v = (x for x in range(SEGMENTS) if x not in (s, t))
        entries.append(F.struct(
            F.lit(number).alias("which"), F.col(f"s{s}").alias("k1"), F.col(f"s{t}").alias("k2"),
            F.col(f"s{u}").alias("r1"), F.col(f"s{v}").alias("r2"),
        ))
    return rows.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.*")


def links(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """(src, dst) pairs that join all fingerprints of ``distinct (fp)`` within the distance."""
    key = ["which", "k1", "k2"]
    entries = pivot_table(distinct)
    crowded = stage(entries.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > hot).drop("n"), "simhash-hot")
    some = not crowded.isEmpty()
    cool = entries.join(crowded, key, "left_anti") if some else entries
    a, b = cool.alias("a"), cool.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]
    pairs = a.join(
        b,
        same + [
            F.col("a.fp") < F.col("b.fp"),
            difference(F.col("a.r1"), F.col("b.r1")) + difference(F.col("a.r2"), F.col("b.r2")) <= DISTANCE,
            F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= DISTANCE,
        ],
    ).select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))
    if not some:
        return pairs.distinct()
    within = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), i)) for i in range(64)])
    meeting = (
        entries.join(crowded, key, "left_semi").select("fp").distinct()
        .select("fp", F.explode(within).alias("point"))
        .groupBy("point").agg(F.collect_set("fp").alias("fps"))  # 65 at most
        .where(F.size("fps") > 1)
        .select(F.array_min("fps").alias("src"), F.explode("fps").alias("dst")).where("src < dst")
    )
    return pairs.union(meeting).distinct()


def near_duplicates(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, key, fingerprint, component_id) of every row of ``docs (doc_id, text)``."""
    rows = stage(fingerprints(docs), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    joined = components(links(distinct.select("fp"), hot), "simhash-components")
    members = distinct.join(joined.withColumnRenamed("node", "fp"), "fp")
    lowest = members.groupBy("component").agg(F.min("first").alias("component_id"))
    moved = members.join(lowest, "component").select("fp", "component_id")
    ids = distinct.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return rows.join(ids, "fp").select(
        "doc_id", "key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component; rows of one id and text are one document.

    Near copies are what ``near_duplicates`` links, by its shingle length and bit distance and nothing else. A row
    without an id goes if a row with one is in its component.
    """
    members = near_duplicates(docs).where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    return without(docs, stage(members.select("doc_id", "key").distinct(), "simhash-gone"))
