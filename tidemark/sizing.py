"""Size checks that decide between plans. An unknown size always means the plan that scales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .functions import column

# Estimated bytes per bucket that a hash table is built for.
HASHED_BYTES_PER_BUCKET = 32 << 20


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate for a frame, or None where it is not available."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own broadcast threshold in bytes; negative when broadcasts are off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    if text.lstrip("-").isdigit():
        return int(text)
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    number = text.rstrip("bkmg")
    return int(number) * units[text[len(number):]]


def fits_broadcast(df: DataFrame) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= broadcast_limit(df.sparkSession)


def at_most(df: DataFrame, limit_bytes: int) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit_bytes


def beside_buckets(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` as the other side of a join with a table bucketed by ``keys``; unchanged without buckets.

    Shuffled into the very same buckets, or Spark might move the table to the partitioning ``df`` already has. A
    small share per bucket is joined by hash table, which spares sorting the table. Both hints keep the join per
    bucket even where ``df`` could be broadcast, so that a rewrite brings the files of a bucket together again.
    """
    if not buckets:
        return df
    hashed = at_most(df, buckets * HASHED_BYTES_PER_BUCKET)
    return df.repartition(buckets, *[column(k) for k in keys]).hint("shuffle_hash" if hashed else "merge")
