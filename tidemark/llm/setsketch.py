"""Near-duplicates by SetSketch registers: mergeable sketches of shingle sets, banded, estimated jointly, then verified.

A text's set are its distinct 3-word shingles (A-Z lower-cased; fewer words: the whole sequence as one). Its sketch has
``REGISTERS`` registers. Register i takes, for every shingle, an exponentially distributed value of rate ``RATE`` from the
shingle's hash, keeps the least value h, and stores floor(1 - log_BASE(h)) cut to 0..LIMIT. Registers of a union are the
maxima of the registers, which is how a long text is sketched: in slices of ``SLICE`` shingles, merged.

1. Equal sets (128-bit hash) are one node: copies are summed up before anything is joined.
2. Registers are banded, ``ROWS`` to a band. At similarity 0.85 a pair shares no band with probability 3e-7.
3. Within a band every member is paired with the band's hub only: the member whose registers agree with most others,
   summed over its bands. A pair is dropped if its sizes rule the similarity out, or if the likelihood of its registers
   under similarity 0.85, given both sizes, is ``DOUBT`` below their greatest (a true link fails that test with
   probability 1e-9). Sets of the pairs that are left are compared exactly.
4. If the components of those links leave a band in several parts, members of different parts are compared with one
   another too, in cells of two blocks of the band: a block has about ``CELL`` sketches and ``CELL_HASHES`` hashes of
   sets, however large the band. A first pass over sketches keeps the members that may have a link in a cell, a second
   one has their sets too. A pair is compared in the first of its bands only, and not once its parts are linked; so what
   leaves either pass grows with the members of the bands, not with their pairs.

Nulls and odd cases: a text that is NULL or has no words has an empty set, no link, and is its own component; repeated
rows come back each; a NULL id is kept, is never the smallest, and stays where no row of its component has an id; extra
columns go; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import Bloom, components, plain_text, stage, words

SHINGLE = 3
SIMILAR = 85  # of 100
ROWS = 6
BANDS = 32
REGISTERS = ROWS * BANDS
# Fixed values of the sketch: base and rate as in its publication, registers of 16 bits.
BASE = 1.001
RATE = 20.0
LIMIT = (1 << 16) - 1
# How far below its maximum the log-likelihood may be, half the square of six standard deviations.
DOUBT = 18.0
CELL = 512
CELL_HASHES = 1 << 20
SLICE = 1 << 15
TEXTS = 200  # texts whose sets are in memory at once
MEMO = 1 << 18
MIX = np.uint64(0x9E3779B97F4A7C15)
RANDOM = np.random.default_rng(13)
MULTIPLY = RANDOM.integers(1, 1 << 63, size=REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(32))) * MIX
    return keys ^ (keys >> np.uint64(29))


class Codes(dict):
    """Hashes of words, 63 bits each, remembered up to ``MEMO`` words; one per task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        code = self[word] = xxh3_64_intdigest(word) >> 1
        return code


class Shingler:
    """Sets of texts as sorted arrays of 64-bit hashes; one per task."""

    def __init__(self, size: int = SHINGLE) -> None:
        self.size = size
        self.codes = Codes()

    def __call__(self, text: str) -> np.ndarray:
        found = words(text)
        if not found:
            return np.empty(0, dtype=np.uint64)
        codes = np.fromiter(map(self.codes.__getitem__, found), dtype=np.int64, count=len(found)).view(np.uint64)
        width = min(self.size, len(codes))
        count = len(codes) - width + 1
        # The width goes in, so a short text never equals a shingle of another length.
        keys = codes[:count] + np.uint64(width)
        for k in range(1, width):
            keys = mixed(keys) + codes[k:count + k]
        keys = np.sort(mixed(keys))
        return keys[np.concatenate(([True], keys[1:] != keys[:-1]))]


def least(sets: list[np.ndarray]) -> np.ndarray:
    """For each non-empty set and register the least of its hashes, as a fraction of the range."""
    out = np.empty((len(sets), REGISTERS), dtype=np.uint64)
    at = 0
    while at < len(sets):
        # Sets are taken together up to a slice; a longer one comes in slices whose minima are merged.
        stop, total = at + 1, len(sets[at])
        while stop < len(sets) and total + len(sets[stop]) <= SLICE:
            total += len(sets[stop])
            stop += 1
        if stop == at + 1 and total > SLICE:
            parts = [least([sets[at][k:k + SLICE]]) for k in range(0, total, SLICE)]
            out[at] = np.minimum.reduce(parts)[0]
        else:
            keys = np.concatenate(sets[at:stop])
            first = np.cumsum([0, *map(len, sets[at:stop - 1])])
            spread = np.empty_like(keys)
            for i in range(REGISTERS):  # keys are hashes: products with different odd numbers order them independently
                np.multiply(keys, MULTIPLY[i], out=spread)
                out[at:stop, i] = np.minimum.reduceat(spread, first)
        at = stop
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The sketches of non-empty sets, one row each."""
    fraction = (least(sets).astype(np.float64) + 0.5) / 2.0**64
    value = -np.log1p(-np.minimum(fraction, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(value) / math.log(BASE)), 0, LIMIT).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One key per band, of its registers."""
    out = np.empty((len(sketches), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(sketches), band + 1, dtype=np.uint64)
        for i in range(band * ROWS, (band + 1) * ROWS):
            key = mixed(key) + sketches[:, i]
        out[:, band] = mixed(key)
    return out.view(np.int64)


def log_likelihood(j: np.ndarray, u: np.ndarray, more: np.ndarray, less: np.ndarray) -> np.ndarray:
    """Of similarity ``j`` where a share ``u`` of both sizes is the first set's, and so many registers are more or less."""
    step = (BASE - 1) / BASE

    def unequal(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.maximum(x, 0.0) * step) / math.log(BASE), 1e-12, 1.0)

    above, below = unequal(u - (1 - u) * j), unequal((1 - u) - u * j)
    same = np.maximum(1 - above - below, 1e-12)
    return more * np.log(above) + less * np.log(below) + (REGISTERS - more - less) * np.log(same)


def plausible(n_a: np.ndarray, n_b: np.ndarray, more: np.ndarray, less: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes may be similar enough, by the joint likelihood of their registers."""
    n_a, n_b = np.asarray(n_a, dtype=np.float64), np.asarray(n_b, dtype=np.float64)
    ratio = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    share, wanted = n_a / (n_a + n_b), SIMILAR / 100
    # The likelihood has one maximum: thirds of the interval narrow it down.
    low, high = np.zeros_like(ratio), ratio.copy()
    for _ in range(24):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        up = log_likelihood(a, share, more, less) < log_likelihood(b, share, more, less)
        low, high = np.where(up, a, low), np.where(up, high, b)
    best = (low + high) / 2
    drop = log_likelihood(best, share, more, less) - log_likelihood(np.minimum(wanted, ratio), share, more, less)
    return (ratio >= wanted - 1e-9) & ((best >= wanted) | (drop <= DOUBT))


def sketched(rows: DataFrame, size: int) -> DataFrame:
    """(doc_id, key, unit, n, sketch) of ``rows (doc_id, key, text)``; unit and sketch are NULL where there are no words."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(size)
        for frame in frames:
            for at in range(0, len(frame), TEXTS):
                part = frame.iloc[at:at + TEXTS]
                sets = [shingler(text) for text in part.text]
                found = iter(registers([s for s in sets if len(s)]))
                yield pd.DataFrame({
                    "doc_id": part.doc_id.astype("Int64").array, "key": part.key.to_numpy(),
                    "unit": [name_of(s) for s in sets], "n": [len(s) for s in sets],
                    "sketch": [next(found).tobytes() if len(s) else None for s in sets],
                })

    return rows.mapInPandas(read, "doc_id long, key long, unit binary, n long, sketch binary")


def name_of(hashes: np.ndarray) -> bytes | None:
    """128 bits that tell a set from others; None for the empty set."""
    if not len(hashes):
        return None
    halves = mixed(hashes).sum(dtype=np.uint64), mixed(hashes ^ MIX).sum(dtype=np.uint64)
    return np.array(halves, dtype=">u8").tobytes()


def matrix(sketches: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), dtype=np.uint16).reshape(-1, REGISTERS)


def hubs(found: DataFrame) -> DataFrame:
    """(band, number, unit, hub) of the members of bands that several units share; ``found (unit, sketch)`` has each once."""

    @F.pandas_udf("array<long>")
    def banded(sketches: pd.Series) -> pd.Series:
        return pd.Series(list(band_keys(matrix(sketches))), dtype=object)

    bands = found.select("unit", F.posexplode(banded("sketch")).alias("number", "band"))
    shared = stage(bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "setsketch-shared")
    # Bands of one unit, which most are, are sifted out before the second shuffle.
    sift = Bloom(shared.select("band"), bits=1 << 26)
    members = stage(bands.where(sift(F.col("band"))).join(shared, "band"), "setsketch-members")
    weight = members.groupBy("unit").agg(F.sum("size").alias("weight"))
    weighed = members.join(weight, "unit").select("band", F.struct("weight", "unit").alias("w"))
    best = stage(
        weighed.groupBy("band").agg(F.max("w").alias("hub")).select("band", F.col("hub.unit").alias("hub")), "setsketch-best")
    return members.join(best, "band").select("band", "number", "unit", "hub")


def likely(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (src, dst) whose sizes and registers allow the similarity."""
    side = found.select("unit", "n", "sketch")
    both = (
        pairs.join(side.select(F.col("unit").alias("dst"), F.col("n").alias("n_b"), F.col("sketch").alias("b")), "dst")
        .join(side.select(F.col("unit").alias("src"), F.col("n").alias("n_a"), F.col("sketch").alias("a")), "src")
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * SIMILAR)
    )

    @F.pandas_udf("boolean")
    def passes(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        x, y = matrix(a), matrix(b)
        return pd.Series(plausible(n_a, n_b, (x > y).sum(axis=1), (x < y).sum(axis=1)))

    return both.where(passes("a", "b", "n_a", "n_b")).select("src", "dst")


def shingle_sets(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(unit, hashes) of the units in ``wanted (unit, place)``, made once more from the text at ``place (doc_id, key)``.

    A Bloom filter lets the other texts pass before the shuffle; their sets are never kept.
    """
    places = stage(wanted.select("unit", "place.doc_id", "place.key"), "setsketch-places")
    may = rows.where(Bloom(places.select("key"))(F.col("key"))).alias("r")
    texts = may.join(places.alias("p"), F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("r.key") == F.col("p.key")))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(size)
        for frame in frames:
            for at in range(0, len(frame), TEXTS):
                part = frame.iloc[at:at + TEXTS]
                yield pd.DataFrame({"unit": part.unit.array, "hashes": [shingler(text).tobytes() for text in part.text]})

    made = texts.select("p.unit", "r.text").mapInPandas(read, "unit binary, hashes binary")
    return made.dropDuplicates(["unit"])  # rows that repeat an id and a text


def verified(pairs: DataFrame, rows: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """The pairs (src, dst) whose whole sets are similar enough.

    The side that stands in few pairs is fetched first; the other, which may be a hub with very many, is met where it is.
    """
    ends = pairs.select(F.explode(F.array("src", "dst")).alias("unit")).distinct()
    side = stage(shingle_sets(rows, found.join(ends, "unit"), size), "setsketch-sets")
    both = pairs.join(side.select(F.col("unit").alias("dst"), F.col("hashes").alias("b")), "dst").join(
        side.select(F.col("unit").alias("src"), F.col("hashes").alias("a")), "src")

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same_enough(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b)], dtype=bool)

    return both.where(similar("a", "b")).select("src", "dst")


def same_enough(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets' intersection is at least ``SIMILAR`` percent of their union."""
    if min(len(a), len(b)) * 100 < max(len(a), len(b)) * SIMILAR:
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= SIMILAR * (len(a) + len(b) - shared)


CELL_KEY = ["band", "low", "high"]


def cells(members: DataFrame, parts: DataFrame, found: DataFrame) -> DataFrame:
    """Members (band, number, low, high, block, unit, part) of the cells of bands that are in several ``parts``."""
    labelled = members.join(parts.withColumnRenamed("node", "unit"), "unit", "left").select(
        "band", "number", "unit", F.coalesce("component", "unit").alias("part")).join(found.select("unit", "n"), "unit")
    split = labelled.groupBy("band").agg(
        F.min("part").alias("a"), F.max("part").alias("b"), F.count("*").alias("size"), F.sum("n").alias("hashes")).where("a < b")
    blocks = F.ceil(F.greatest(F.col("size") / CELL, F.col("hashes") / CELL_HASHES)).cast("int")
    left = labelled.join(split.select("band", blocks.alias("blocks")), "band").withColumn(
        "block", F.pmod(F.xxhash64("unit", "band"), F.col("blocks")).cast("int"))
    # A cell is two blocks of a band; each block goes to all cells it is in, marked with its place there.
    dealt = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("low"), F.greatest("block", k).alias("high")))
    return left.select("band", "number", "unit", "part", "block", F.explode(dealt).alias("cell")).select(
        "band", "number", "cell.low", "cell.high", "block", "unit", "part")


def by_cell(members: DataFrame, apply: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``apply`` over frames of whole cells."""

    def over(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            # The last cell of a batch may go on in the next one; a cell is small.
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = (frame[CELL_KEY] == frame[CELL_KEY].iloc[-1]).all(axis=1).to_numpy() if len(frame) else np.empty(0, bool)
            rest = frame[last]
            if not last.all():
                yield apply(frame[~last].reset_index(drop=True))
        if rest is not None and len(rest):
            yield apply(rest.reset_index(drop=True))

    return members.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY).mapInPandas(over, schema)


def across(members: DataFrame, parts: DataFrame, rows: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """Links (src, dst) that connect similar units of different ``parts`` that share a band."""
    side = found.select("unit", "n", "sketch")
    doubtful = stage(by_cell(
        cells(members, parts, found).join(side, "unit"), in_doubt,
        "band long, number int, low int, high int, block int, unit binary, part binary"), "setsketch-doubtful")
    wanted = doubtful.select("unit").distinct()
    sets = stage(shingle_sets(rows, found.join(wanted, "unit"), size), "setsketch-sets")
    with_sets = doubtful.join(side.join(sets, "unit"), "unit")
    return by_cell(with_sets, linked, "src binary, dst binary").distinct()


PAIRS = 1 << 14  # pairs of sketches compared at once
CELL_PAIRS = 1 << 19  # pairs of rows that are listed at once, or one cell's


def candidates(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Likely pairs of rows (a, b, equal registers) of different parts in the cells of ``frame``, which are whole.

    Of the bands that two units share the first one counts.
    """
    band, number, low, high, block = (frame[c].to_numpy() for c in ("band", "number", "low", "high", "block"))
    n, part, sketches = frame.n.to_numpy(), pd.factorize(frame.part)[0], matrix(frame.sketch)
    new = np.flatnonzero((band[1:] != band[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
    start = np.concatenate([[0], new])
    size = np.diff(np.concatenate([start, [len(frame)]]))
    total = np.cumsum(size * (size - 1) // 2)
    at = 0
    while at < len(size):
        before = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, before + CELL_PAIRS, side="right")))
        first, ends = start[at], np.repeat(start[at:stop] + size[at:stop], size[at:stop])
        row = first + np.arange(len(ends))
        count = ends - 1 - row
        a = np.repeat(row, count)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
        fits = (part[a] != part[b]) & ((low[a] == high[a]) | (block[a] != block[b]))
        fits &= np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * SIMILAR
        a, b = a[fits], b[fits]
        for k in range(0, len(a), PAIRS):
            x, y = a[k:k + PAIRS], b[k:k + PAIRS]
            p, q = sketches[x], sketches[y]
            equal = p == q
            whole = equal.reshape(-1, BANDS, ROWS).all(axis=2)
            here = whole.argmax(axis=1) == number[x]
            x, y, p, q, equal = x[here], y[here], p[here], q[here], equal[here].sum(axis=1)
            more = (p > q).sum(axis=1)
            good = plausible(n[x], n[y], more, REGISTERS - more - equal)
            yield x[good], y[good], equal[good]
        at = stop


def in_doubt(frame: pd.DataFrame) -> pd.DataFrame:
    """The rows of ``frame`` that have a likely partner in their cell."""
    marked = np.zeros(len(frame), dtype=bool)
    for a, b, _ in candidates(frame):
        marked[a] = marked[b] = True
    return frame.loc[marked, [*CELL_KEY[:1], "number", *CELL_KEY[1:], "block", "unit", "part"]]


def linked(frame: pd.DataFrame) -> pd.DataFrame:
    """Links (src, dst) that connect the parts of similar rows in the cells of ``frame``, verified on whole sets."""
    part, unit = pd.factorize(frame.part)[0], frame.unit.to_numpy()
    root = list(range(len(frame)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    sets = [np.frombuffer(h, np.uint64) for h in frame.hashes]
    out = []
    for a, b, equal in candidates(frame):
        # The most similar first: the sooner parts are linked, the fewer sets are compared.
        for k in np.argsort(-equal, kind="stable"):
            i, j = int(a[k]), int(b[k])
            p, q = top(part[i]), top(part[j])
            if p != q and same_enough(sets[i], sets[j]):
                root[p] = q
                out.append((min(unit[i], unit[j]), max(unit[i], unit[j])))
    return pd.DataFrame(out, columns=["src", "dst"], dtype=object)


def links(rows: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """(src, dst) that connect all similar units of ``found (unit, n, sketch, place)``, made from ``rows``."""
    members = stage(hubs(found), "setsketch-hubs")
    star = members.where("unit <> hub").select(F.col("hub").alias("src"), F.col("unit").alias("dst")).distinct()
    near = stage(likely(star, found), "setsketch-likely")
    direct = stage(verified(near, rows, found, size), "setsketch-links")
    parts = stage(components(direct, "setsketch-parts"), "setsketch-parts")
    return direct.union(stage(across(members, parts, rows, found, size), "setsketch-across"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs (doc_id, text)``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), plain_text().alias("text"))
    read = stage(sketched(rows, size), "setsketch")
    # One row per set: which of the equal rows is taken makes no difference.
    once = stage(read.where("unit IS NOT NULL").groupBy("unit").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "key")).alias("place"),
        F.first("n").alias("n"), F.first("sketch").alias("sketch")), "setsketch-units")
    joined = components(links(rows, once, size), "setsketch-components")
    members = once.join(joined.withColumnRenamed("node", "unit"), "unit", "left").select(
        "unit", "first", F.coalesce("component", "unit").alias("component"))
    lowest = members.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = stage(members.join(lowest, "component").select("unit", "component_id"), "setsketch-ids")
    own = F.when(F.col("unit").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return read.select("doc_id", "unit", F.col("n").alias("n_shingles")).join(ids, "unit", "left").select(
        "doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
