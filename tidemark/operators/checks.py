"""Checks that guard the loads: unique keys, parents, and an unbroken change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import column, flag, null_safe_match
from ..sizing import at_most
from .skew import SMALL_FRAME_BYTES, checkpoint, join_partner


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows ``n``."""
    return df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, **skew) -> DataFrame:
    """Rows of ``child`` without a row in ``parent``.

    The parent keys are made distinct first: that drops repeats before the shuffle, and a key repeated without
    limit reaches the join once. Keys that are hot among the children are kept apart by the join.
    """
    known = parent.select(column(parent_key).alias(child_key)).distinct()
    return join_partner(child, known, [child_key], "left_anti", **skew)


def position_bounds(df: DataFrame, position: str, by: Sequence[str] = ()) -> DataFrame:
    """Lowest and highest log position, over all rows or per group."""
    return df.groupBy(*[column(c) for c in by]).agg(
        F.min(column(position)).alias("min_lsn"), F.max(column(position)).alias("max_lsn")
    )


def range_chain(
    ranges: DataFrame,
    lower: str,
    upper: str,
    by: Sequence[str] = (),
    slices: int | None = None,
    small_frame_bytes: int = SMALL_FRAME_BYTES,
) -> DataFrame:
    """Holes and overlaps in chains of ranges ``(lower, upper]``, one chain per group.

    One row per range that does not start where all ranges before it (by lower, then upper bound) have reached:
    ``kind`` is hole or overlap, ``fault_from`` and ``fault_to`` bound what is missing or covered again. A missing lower
    bound is the start of the log. Ranges that are missing their upper bound, empty or given twice count once or not
    at all, so a load that is repeated is no fault. A group may hold any share of the ranges: a large frame is cut along the chains, and the
    furthest reach of earlier slices is carried over each cut.
    """
    names = [column(c) for c in by]
    chain = ranges.select(*names, column(lower).alias("_lower"), column(upper).alias("_upper")).filter(
        F.col("_upper").isNotNull() & (F.col("_lower").isNull() | (F.col("_lower") < F.col("_upper")))).distinct()
    order = [F.col("_lower").asc_nulls_first(), F.col("_upper")]

    def earlier(partition: Sequence[Column], by_order: Sequence[Column]) -> Column:
        window = Window.partitionBy(*partition).orderBy(*by_order)
        return F.max("_upper").over(window.rowsBetween(Window.unboundedPreceding, -1))

    if slices is None and at_most(chain, small_frame_bytes):
        reached = chain.withColumn("_reached", earlier(names, order))
    else:
        count = slices or int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        cut = chain.repartitionByRange(count, *names, *order)
        # The slice numbers feed two branches, so the checkpoint fixes them.
        sliced = checkpoint(cut.withColumn("_slice", F.spark_partition_id()))
        # One row per group and slice that holds some of it: at most the groups plus the slices in number.
        ends = sliced.groupBy(*names, "_slice").agg(F.max("_upper").alias("_upper"))
        carried = ends.withColumn("_carried", earlier(names, [F.col("_slice")])).drop("_upper")
        within = sliced.withColumn("_within", earlier(["_slice", *names], order))
        match = null_safe_match((*by, "_slice"), "w", "c")
        reached = within.alias("w").join(carried.alias("c"), match, "left").select(
            *[column(c, "w") for c in chain.columns],
            F.greatest("w._within", "c._carried").alias("_reached"),  # NULLs are skipped
        )
    hole = F.col("_reached") < F.col("_lower")
    again = F.col("_lower").isNull() | (F.col("_reached") > F.col("_lower"))
    return reached.filter(F.col("_reached").isNotNull() & (hole | again)).select(
        *names,
        F.when(hole, "hole").otherwise("overlap").alias("kind"),
        F.when(hole, F.col("_reached")).otherwise(F.col("_lower")).alias("fault_from"),
        F.when(hole, F.col("_lower")).otherwise(F.least("_reached", "_upper")).alias("fault_to"),
    )


def change_log_gaps(df: DataFrame, position: str, by: Sequence[str], last_position: Column) -> DataFrame:
    """Per group: the lowest position still in the log, and whether it lies after the last one applied."""
    lowest = df.groupBy(*[column(c) for c in by]).agg(F.min(column(position)).alias("min_lsn"))
    return lowest.withColumn("has_gap", flag(F.col("min_lsn") > last_position))
