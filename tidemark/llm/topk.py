"""Exact top-k search by inner product with pivot-table elimination.

Vectors are integers, floor(1024 * x). With d the Euclidean distance, 2 <q, x> = |q|^2 + |x|^2 - d(q, x)^2, and for any
pivot p d(q, x) >= |d(q, p) - d(x, p)|: the largest such difference over all pivots bounds the score from above. Each
vector's distances to the pivots, a bounded sample, are computed once. In a cell, one block of queries against one block
of vectors, each query takes the vectors in order of their bounds and stops when the next bound is below its k-th best
score so far; that score starts from a bounded sample of vectors, so most of a block is never evaluated.

Blocks have a bounded number of rows, cells are independent tasks, and a cell gives k rows per query at most; the k best
of those are the result. Vectors are replicated once per block of queries and queries once per block of vectors.

Nulls and odd cases: vectors that are NULL or hold NULL, NaN or infinite components take no part, nor do rows without an
id; vectors of different lengths are compared as if the shorter ended in zeros; a repeated row is a candidate of its
twin; ties go to the smaller id; fewer candidates than k are all returned; scores past 2^53 are added up in 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SCALE = 1024
PIVOTS = 16
SAMPLE = 1024  # vectors that give each query its first k-th best score
BLOCK = 32_768  # rows of a block at most, on average
STEP = 256  # candidates evaluated at once
EXACT = float(1 << 53)


def matrix(vectors: pd.Series, width: int | None = None) -> np.ndarray:
    """Integer vectors as rows, shorter ones filled up with zeros."""
    width = max((len(v) for v in vectors), default=0) if width is None else width
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (a, b))
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, width)
    if largest < EXACT:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = max(vectors.shape[1], pivots.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))).astype(np.float64) for m in (vectors, pivots))
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def best(
    query: np.ndarray, own: int, floor: float, near: np.ndarray, rows: np.ndarray, ids: np.ndarray,
    block: np.ndarray, squares: np.ndarray, table: np.ndarray, k: int,
) -> tuple[list[int], list[int], int]:
    """The k best (ids, scores) of a block for one query, and how many vectors were evaluated."""
    square = float((query.astype(np.float64) ** 2).sum())
    lower = np.abs(table - near).max(axis=1, initial=0)
    # A slack far above the rounding of square roots keeps the bound safe.
    bound = (square + squares - lower * lower) / 2 + 1e-6 * (square + squares) + 1
    order = np.argsort(-bound, kind="stable")
    order = order[rows[order] != own]
    scores, found, done = np.empty(0, np.int64), np.empty(0, np.int64), 0
    for at in range(0, len(order), STEP):
        part = order[at:at + STEP]
        if bound[part[0]] < floor:
            break
        part = part[bound[part] >= floor]
        done += len(part)
        scores = np.concatenate([scores, inner(query[None, :], block[part])[0]])
        found = np.concatenate([found, ids[part]])
        keep = np.lexsort((found, -scores))[:k]
        scores, found = scores[keep], found[keep]
        if len(scores) == k:
            floor = max(floor, float(scores[-1]))
    return found.tolist(), scores.tolist(), done


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    whole = (
        vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(sound)
        .select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("long")).alias("v"),
                F.monotonically_increasing_id().alias("row"))
    )
    whole = stage(whole, "topk-vectors")
    # Bounded samples: the rows whose id hashes are smallest.
    sample = whole.orderBy(F.xxhash64("vec_id"), "row").limit(SAMPLE).toPandas()
    seen = matrix(sample.v)
    pivots = seen[:PIVOTS]
    first = spark.sparkContext.broadcast((sample.row.to_numpy(), seen))

    @F.pandas_udf("array<double>")
    def to_pivots(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(distances(matrix(batch), pivots)))

    @F.pandas_udf("double")
    def start(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known_rows, known = first.value
        for row, batch in batches:
            scores = inner(matrix(batch), known).astype(np.float64)
            scores[row.to_numpy()[:, None] == known_rows[None, :]] = -math.inf
            if scores.shape[1] < k:
                yield pd.Series(np.full(len(batch), -math.inf))
            else:
                yield pd.Series(np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])

    ready = stage(whole.withColumn("near", to_pivots("v")), "topk-pivots")
    asked = ready.where(F.col("vec_id") % every == 0)
    total, queries = ready.count(), asked.count()
    x_blocks = max(math.ceil(total / block), 2 * spark.sparkContext.defaultParallelism)
    q_blocks = max(1, math.ceil(queries / block))
    x = ready.withColumn("i", (F.col("row") % x_blocks).cast("int")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    q = asked.withColumn("floor", start("row", "v")).withColumn("j", (F.col("row") % q_blocks).cast("int")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.lit(x_blocks - 1))))

    def cell(queries: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int]] = []
        if len(frame) and len(queries):
            width = max(max(map(len, frame.v)), max(map(len, queries.v)))
            rows, ids, table = frame.row.to_numpy(), frame.vec_id.to_numpy(), np.stack(frame.near.to_list())
            vectors = matrix(frame.v, width)
            squares = (vectors.astype(np.float64) ** 2).sum(1)
            for row, query, floor, near, v in zip(
                queries.row, queries.vec_id, queries.floor, queries.near, matrix(queries.v, width)
            ):
                found, scores, _ = best(v, row, floor, np.asarray(near), rows, ids, vectors, squares, table, k)
                out += [(row, query, i, s) for i, s in zip(found, scores)]
        return pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "score"], dtype="int64")

    found = q.groupBy("i", "j").cogroup(x.groupBy("i", "j")).applyInPandas(
        cell, "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
