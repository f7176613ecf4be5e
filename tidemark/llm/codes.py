"""Vector code compression: product codebooks by k-means over integers, with adaptive distance bounds.

Components become floor(4096 * x); a vector is cut into ``PARTS`` equal parts, each with a codebook of its own. Every
round assigns each part to its nearest entry and moves the entries to the floor of their parts' mean. Most assignments
need no distance: with each part are persisted its b closest entries, ordered, a lower bound of the distance to each of
them, one outer bound for all other entries, and an upper bound of the distance to its own entry. A moved entry loosens
the bounds by the way it went. Where the upper bound is below the z-th lower bound, only the first z entries are in
question: none for z = 1, else their exact integer distances are compared; where it is not below the outer bound, all
are. Bounds are rounded away from certainty, so that a tie is always left to the integers. b starts at a quarter of the
entries, shrinks to the deepest z that was needed, though not below an eighth, and doubles when over a quarter of the
parts had to be compared with all.

A round is one pass over the persisted rows, which writes the next ones, and a sum per part and entry, made once per task
before it is shuffled. The codebooks, at most 128 entries, are what a task is given.

Rows whose vector is NULL or holds a NULL, NaN or infinite component take no part; nor do components beyond +-16,384,
whose squared distances would not fit a long, and vectors that are empty, of a length that 8 does not divide, or of
another length than that of the smallest vec_id. Repeated rows count and come back each; a NULL vec_id comes last in
order; fewer than 16 rows make codebooks of fewer entries; extra columns go; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, unstage

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LIMIT = 1 << 26
# Relative slack of a bound: more than the rounding of a root and of a few sums.
SLACK = 1e-12
ABSENT = 255  # stands in a list where there is no entry
FAR = 1e150  # the outer bound of a list of all entries

STATE = "vec_id long, label {label}, ints array<int>, near binary, bounds binary, depth int, full int, verified int, error long"


@dataclass(frozen=True)
class Bounds:
    """Of n parts: ``near (n, b)`` entries in order; ``upper (n)`` of near[:, 0]; ``lower (n, b)``: of near[:, 1:], then outer."""

    near: np.ndarray
    upper: np.ndarray
    lower: np.ndarray


def squared(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of (n, width) parts to (n, m, width) or (m, width) entries."""
    difference = parts[:, None, :] - entries
    return np.einsum("nmw,nmw->nm", difference, difference)


def nearest(parts: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
    """Bounds from the distances to all entries."""
    distance = squared(parts, entries)
    order = np.argsort(distance, axis=1, kind="stable")  # ties to the lower index
    root = np.sqrt(np.take_along_axis(distance, order, axis=1).astype(np.float64))
    b = min(b, len(entries))
    outer = root[:, b:b + 1] if b < len(entries) else np.full((len(parts), 1), FAR)
    return Bounds(order[:, :b].astype(np.uint8), root[:, 0] * (1 + SLACK), np.hstack([root[:, 1:b], outer]) * (1 - SLACK))


def widened(bounds: Bounds, b: int) -> Bounds:
    """The same bounds with lists of ``b``: what is cut off falls under the outer bound, what is added is absent."""
    have = bounds.near.shape[1]
    if b <= have:
        return Bounds(bounds.near[:, :b], bounds.upper, bounds.lower[:, :b])
    near = np.full((len(bounds.near), b), ABSENT, dtype=np.uint8)
    near[:, :have] = bounds.near
    return Bounds(near, bounds.upper, np.hstack([bounds.lower, np.repeat(bounds.lower[:, -1:], b - have, axis=1)]))


def moved(bounds: Bounds, way: np.ndarray) -> Bounds:
    """Bounds after entries went ``way``, ordered: no bound is above a later one."""
    far = way.max() * (1 + SLACK)
    by = np.append(way * (1 + SLACK), np.full(256 - len(way), far))
    lower = bounds.lower.copy()
    lower[:, :-1] -= by[bounds.near[:, 1:]]
    lower[:, -1] -= far
    lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]
    lower -= np.abs(lower) * SLACK
    return Bounds(bounds.near, (bounds.upper + by[bounds.near[:, 0]]) * (1 + SLACK), lower)


def assigned(parts: np.ndarray, entries: np.ndarray, way: np.ndarray, before: Bounds, b: int) -> tuple[Bounds, np.ndarray]:
    """The next bounds, and of every part how many entries were in question: 1 to b, or 0 for all of them."""
    now = widened(moved(before, way), min(b, len(entries)))
    near, upper, lower = now.near.copy(), now.upper.copy(), now.lower.copy()
    sure = upper[:, None] < lower
    depth = np.where(sure.any(axis=1), sure.argmax(axis=1) + 1, 0)
    # A list that is in question beyond its known entries says no more than the outer bound.
    depth[depth > (near != ABSENT).sum(axis=1)] = 0
    for z in np.unique(depth):
        rows = np.flatnonzero(depth == z)
        if z == 1:
            continue
        if z == 0:
            every = nearest(parts[rows], entries, near.shape[1])
            near[rows], upper[rows], lower[rows] = every.near, every.upper, every.lower
            continue
        some = near[rows, :z]
        distance = squared(parts[rows], entries[some])
        order = np.lexsort((some, distance), axis=1)
        root = np.sqrt(np.take_along_axis(distance, order, axis=1).astype(np.float64))
        near[rows, :z] = np.take_along_axis(some, order, axis=1)
        upper[rows] = root[:, 0] * (1 + SLACK)
        lower[rows, :z - 1] = np.minimum(root[:, 1:] * (1 - SLACK), lower[rows, z - 1:z])
    return Bounds(near, upper, lower), depth


def integers(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, ints) of the rows that take part."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < LIMIT // SCALE))
    return embeddings.where(fine & (F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", scaled.cast("array<int>").alias("ints"))


def first_rows(vectors: DataFrame, count: int) -> list:
    return vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(count).select("ints").collect()


def next_state(state: DataFrame, books: np.ndarray, before: np.ndarray | None, b: int, final: bool) -> DataFrame:
    """Every row assigned by ``books (PARTS, entries, width)``; ``before`` are the last round's, None in the first round."""
    way = None if before is None else np.sqrt(((books - before) ** 2).sum(axis=2).astype(np.float64))
    width = books.shape[2]

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            n = len(frame)
            if not n:
                continue
            parts = np.stack(frame.ints.to_numpy()).astype(np.int64).reshape(n, PARTS, width)
            out, error = [], np.zeros(n, dtype=np.int64)
            depth = np.zeros((n, PARTS), dtype=np.int64)
            if way is not None:
                near = np.frombuffer(b"".join(frame.near), dtype=np.uint8).reshape(n, PARTS, -1)
                bounds = np.frombuffer(b"".join(frame.bounds), dtype=np.float64).reshape(n, PARTS, -1)
            for p in range(PARTS):
                own = parts[:, p]
                if way is None:
                    found = nearest(own, books[p], b)
                else:
                    kept = Bounds(near[:, p], bounds[:, p, 0], bounds[:, p, 1:])
                    found, depth[:, p] = assigned(own, books[p], way[p], kept, b)
                out.append(found)
                if final:
                    difference = own - books[p][found.near[:, 0]]
                    error += np.einsum("nw,nw->n", difference, difference)
            near = np.stack([f.near for f in out], axis=1)
            bounds = np.stack([np.hstack([f.upper[:, None], f.lower]) for f in out], axis=1)
            yield frame[["vec_id", "label", "ints"]].assign(
                near=[x.tobytes() for x in near], bounds=[x.tobytes() for x in bounds],
                depth=depth.max(axis=1).astype(np.int32), full=(depth == 0).sum(axis=1).astype(np.int32),
                verified=(depth != 1).sum(axis=1).astype(np.int32), error=error,
            )

    return state.mapInPandas(assign, STATE.format(label=state.schema["label"].dataType.simpleString()))


def sums(state: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums (PARTS, entries, width) and counts (PARTS, entries) of the assigned parts."""
    entries, width = books.shape[1:]
    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((PARTS, entries, width + 1), dtype=np.int64)
        for frame in frames:
            n = len(frame)
            if not n:
                continue
            parts = np.stack(frame.ints.to_numpy()).astype(np.int64).reshape(n, PARTS, width)
            near = np.frombuffer(b"".join(frame.near), dtype=np.uint8).reshape(n, PARTS, -1)[:, :, 0]
            for p in range(PARTS):
                np.add.at(total[p], near[:, p], np.hstack([parts[:, p], np.ones((n, 1), dtype=np.int64)]))
        p, e, w = np.indices(total.shape).reshape(3, -1)
        yield pd.DataFrame({"part": p, "entry": e, "pos": w, "total": total.ravel()})

    rows = (
        state.select("ints", "near").mapInPandas(add, "part int, entry int, pos int, total long")
        .groupBy("part", "entry", "pos").agg(F.sum("total").alias("total")).collect()  # PARTS * entries * (width + 1)
    )
    out = np.zeros((PARTS, entries, width + 1), dtype=np.int64)
    for part, entry, pos, total in rows:
        out[part, entry, pos] = total
    return out[:, :, :width], out[:, :, width]


def adapted(b: int, state: DataFrame, entries: int) -> int:
    """The next length of the lists."""
    depth, full, rows = state.agg(F.max("depth"), F.sum("full"), F.count("*")).first()
    if full > rows * PARTS / 4:
        return min(2 * b, entries)
    return min(b, max(depth, entries // 8, 1))


def fitted(vectors: DataFrame, rounds: int = ROUNDS, report: list | None = None) -> tuple[DataFrame, np.ndarray]:
    """The rows of ``vectors (vec_id, label, ints)`` assigned by the final codebooks, and these.

    ``report`` gets (b, parts compared at all, parts compared with all entries) of every round.
    """
    first = first_rows(vectors, 1)
    width = len(first[0].ints) // PARTS
    state = stage(vectors.where(F.size("ints") == width * PARTS), "codes-vectors")
    start = np.array([r.ints for r in first_rows(state, ENTRIES)], dtype=np.int64)
    books = start.reshape(len(start), PARTS, width).transpose(1, 0, 2)
    before, b = None, max(len(start) // 4, 1)
    for number in range(rounds + 1):
        new = stage(next_state(state, books, before, b, number == rounds), "codes-state")
        unstage(state)
        state = new
        if report is not None:
            report.append((b, *state.agg(F.sum("verified"), F.sum("full")).first()))
        if number == rounds:
            return state, books
        total, count = sums(state, books)
        moved_to = total // np.maximum(count, 1)[:, :, None]  # floor, also of negative numbers
        before, books = books, np.where(count[:, :, None] > 0, moved_to, books)
        if number:
            b = adapted(b, state, len(start))


def encode(embeddings: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row of ``embeddings`` that takes part."""
    vectors = integers(embeddings)
    if vectors.isEmpty():
        return vectors.select(
            "vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    state, books = fitted(vectors, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

    @F.pandas_udf("string")
    def hexed(near: pd.Series) -> pd.Series:
        return pd.Series([bytes(x[::len(x) // PARTS]).hex() for x in near], dtype=object)

    totals = stage(state.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    s, t = state.alias("s"), totals.alias("t")
    return s.join(t, F.col("s.label").eqNullSafe(F.col("t.label"))).select(
        "s.vec_id", hexed("s.near").alias("code"), "s.error", "t.label_error", F.lit(digest).alias("codebooks_sha256"))
