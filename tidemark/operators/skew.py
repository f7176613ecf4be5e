"""Windows and joins that survive a key holding a large share of all rows.

A plain window or join sends every row of one key to one task. Which keys are hot is counted first, on a sample
of the key columns alone; frames small enough for one task skip the count. In a window, hot keys are cut into
slices along their own order by range partitioning; the window then runs per slice, and the first row of the next
slice is carried over the cut. In a join, the rows of hot keys stay where they are and meet their partners, at most
one per key, by broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions import column, null_safe_match, same_key
from ..sizing import at_most, fits_broadcast

# Rows of one key a single window task may hold.
ROWS_PER_SLICE = 5_000_000
# Rows of a key at that limit which the sample for finding hot keys is expected to hold.
SAMPLE_PER_SLICE = 2_000
# A frame below this estimated size is fine in one task, however its keys are spread.
SMALL_FRAME_BYTES = 256 << 20
# Hot keys (at most 2 * total rows / ROWS_PER_SLICE) are broadcast up to this count, else joined by shuffle.
MAX_BROADCAST_ROWS = 1_000_000


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder in ``spark.checkpoint.dir``."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    # Without the setting the warehouse is the folder that all executors share.
    context.setCheckpointDir(shared or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")


def join_partner(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    how: str,
    columns: Callable[[DataFrame], DataFrame] = lambda joined: joined,
    rows_per_slice: int | None = None,
    small_frame_bytes: int | None = None,
) -> DataFrame:
    """Join ``many`` (alias ``m``) with ``one`` (alias ``o``), which has at most one row per key.

    ``how`` is left, left_semi, left_anti or inner; ``columns`` picks the columns of the joined frame. Adaptive
    execution only splits a hot key where both sides come straight from a shuffle, which an aggregated or ranked
    partner side does not.
    """
    rows_per_slice = ROWS_PER_SLICE if rows_per_slice is None else rows_per_slice
    small_frame_bytes = SMALL_FRAME_BYTES if small_frame_bytes is None else small_frame_bytes

    def joined(rows: DataFrame, partners: DataFrame) -> DataFrame:
        return columns(rows.alias("m").join(partners.alias("o"), same_key(keys, "m", "o"), how))

    if at_most(many, small_frame_bytes) or fits_broadcast(one):
        return joined(many, one)
    hot, hot_keys, _ = _hot_keys(many, keys, rows_per_slice)
    if hot_keys == 0:
        return joined(many, one)

    def marked(rows: DataFrame, how_marked: str) -> DataFrame:
        return rows.alias("r").join(_bounded(hot, hot_keys).alias("h"), null_safe_match(keys, "r", "h"), how_marked)

    partners_of_hot = _bounded(marked(one, "left_semi"), hot_keys)
    return joined(marked(many, "left_anti"), one).union(joined(marked(many, "left_semi"), partners_of_hot))


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_slice: int | None = None,
    small_frame_bytes: int | None = None,
) -> DataFrame:
    """Add ``_has_next``, false on the last row of each key, and ``_next``, the next row's first order column."""
    rows_per_slice = ROWS_PER_SLICE if rows_per_slice is None else rows_per_slice
    small_frame_bytes = SMALL_FRAME_BYTES if small_frame_bytes is None else small_frame_bytes
    if at_most(df, small_frame_bytes):
        return _next_in_window(df, keys, order)

    hot, hot_keys, hot_rows = _hot_keys(df, keys, rows_per_slice)
    if hot_keys == 0:
        return _next_in_window(df, keys, order)

    match = null_safe_match(keys, "r", "h")
    marks = _bounded(hot, hot_keys).alias("h")
    rows = df.alias("r")
    cold = _next_in_window(rows.join(marks, match, "left_anti"), keys, order)
    slices = max(2, math.ceil(hot_rows / rows_per_slice))
    return cold.unionByName(_next_in_slices(rows.join(marks, match, "left_semi"), keys, order, slices, hot_keys))


def _hot_keys(df: DataFrame, keys: Sequence[str], rows_per_slice: int) -> tuple[DataFrame, int, int]:
    """Keys with about ``rows_per_slice`` rows or more, their number, and their rows in total.

    The sample only decides how rows are distributed over tasks, never which rows are kept. A key at the limit is
    expected in it ``SAMPLE_PER_SLICE`` times and counts as hot from half of that, so it is not missed.
    """
    fraction = min(1.0, SAMPLE_PER_SLICE / rows_per_slice)
    at_least = rows_per_slice + 1 if fraction == 1.0 else SAMPLE_PER_SLICE // 2
    names = [column(k) for k in keys]
    seen = df.select(*names) if fraction == 1.0 else df.select(*names).sample(fraction, seed=0)
    counts = seen.groupBy(*names).agg(F.count(F.lit(1)).alias("_rows"))
    hot = checkpoint(counts.filter(F.col("_rows") >= at_least))
    hot_keys, sampled = hot.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    return hot.drop("_rows"), hot_keys, math.ceil(sampled / fraction)


def _next_in_window(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*[column(c) for c in partition]).orderBy(*[column(c) for c in order])
    return df.withColumns(
        {
            "_has_next": F.lead(F.lit(1)).over(window).isNotNull(),
            "_next": F.lead(column(order[0])).over(window),
        }
    )


def content_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """A hash of the columns' values; maps, which cannot be hashed, are hashed as their sorted JSON entries."""

    def holds_map(kind: DataType) -> bool:
        if isinstance(kind, MapType):
            return True
        if isinstance(kind, ArrayType):
            return holds_map(kind.elementType)
        return isinstance(kind, StructType) and any(holds_map(f.dataType) for f in kind.fields)

    def value(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, MapType) and not holds_map(kind.keyType):
            return F.to_json(F.struct(F.array_sort(F.transform(F.map_entries(column(name)), lambda e: F.to_json(F.struct(e))))))
        return F.to_json(F.struct(column(name))) if holds_map(kind) else column(name)

    return F.xxhash64(*[value(c) for c in columns])


def _next_in_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int, hot_keys: int
) -> DataFrame:
    # Rows that are equal in the order columns can still be cut apart by what else they hold.
    others = [c for c in df.columns if c not in {*keys, *order}]
    if others:
        rows = df.withColumn("_tie", content_hash(df, others))
        order = [*order, "_tie"]
    else:
        rows = df
    # The slice numbers feed two branches below, so they are fixed once by the checkpoint.
    cut = rows.repartitionByRange(slices, *[column(c) for c in (*keys, *order)])
    sliced = checkpoint(cut.withColumn("_slice", F.spark_partition_id()))
    within = _next_in_window(sliced, ["_slice", *keys], order)
    first_rows = sliced.groupBy(*[column(k) for k in keys], "_slice").agg(
        F.min(F.struct(*[column(c) for c in order])).alias("_first")
    )
    by_key = Window.partitionBy(*[column(k) for k in keys]).orderBy("_slice")
    carry = first_rows.withColumn("_carry", F.lead("_first").over(by_key)).drop("_first")
    joined = within.alias("w").join(
        _bounded(carry, slices + hot_keys).alias("c"),
        null_safe_match((*keys, "_slice"), "w", "c"),
        "left",
    )
    has_next, carried = F.col("w._has_next"), F.col("c._carry")
    following = F.when(has_next, F.col("w._next")).otherwise(carried.getField(order[0]))
    return joined.select(
        *[column(c, "w") for c in df.columns],
        (has_next | carried.isNotNull()).alias("_has_next"),
        following.alias("_next"),
    )


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df
