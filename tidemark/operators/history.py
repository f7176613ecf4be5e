"""Batches and versions: which rows are pending, which row of a key is the newest, how long each one held."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import column, flag, null_safe_match
from .ingest import INGESTED_AT
from .skew import content_hash, with_next

IS_CURRENT = "is_current"
VALID_FROM = "valid_from"
VALID_TO = "valid_to"
# Columns of this prefix tell how a row came here, not what it says.
AUDIT_PREFIX = "bronze_"


def latest_batch(df: DataFrame, batch_column: str = INGESTED_AT) -> DataFrame:
    """Rows of the newest batch. The maximum is a scalar subquery, so it is one plan without a driver trip."""
    newest = df.agg(F.max(column(batch_column)).alias("newest")).scalar()
    return df.filter(column(batch_column) == newest)


def unprocessed_batches(df: DataFrame, applied: Column | None, batch_column: str = INGESTED_AT) -> DataFrame:
    """Rows of every batch after the last one applied; all of them when none was."""
    return df if applied is None else df.filter(column(batch_column) > applied)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``, which must be a total order within a key.

    Rank-then-filter lets Spark drop all but one row per key in each task before the shuffle, so a key that
    holds much of the table still sends one row per task.
    """
    window = Window.partitionBy(*[column(k) for k in keys]).orderBy(*[column(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def current_flag(df: DataFrame, keys: Sequence[str], order: Sequence[str], **skew) -> DataFrame:
    """Add ``is_current``: 1 on the newest version of each key, else 0."""
    following = with_next(df, keys, order, **skew)
    return following.withColumn(IS_CURRENT, flag(~F.col("_has_next"))).drop("_has_next", "_next")


def validity(df: DataFrame, keys: Sequence[str], order: Sequence[str], **skew) -> DataFrame:
    """Add ``valid_from``, ``valid_to`` and ``is_current``; the newest version stays open."""
    following = with_next(df, keys, order, **skew)
    return following.withColumns(
        {
            VALID_FROM: column(order[0]),
            VALID_TO: F.col("_next"),
            IS_CURRENT: flag(~F.col("_has_next")),
        }
    ).drop("_has_next", "_next")


def append_versions(
    history: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    prefer: Sequence[str] = (),
    intervals: bool = False,
    audit_prefix: str = AUDIT_PREFIX,
    **skew,
) -> DataFrame:
    """History plus the versions of ``batch`` it does not hold yet, with ``is_current`` right for every key.

    A version is identified by its key, its order columns and its content, which is every column but audit columns and
    those made here; so applying a batch again changes nothing, and a correction under an equal watermark is a version
    of its own. Of rows with one identity the first in ``prefer`` order counts, stored ones before all; of versions equal
    in ``order`` the last in ``prefer`` order is current. NULL keys are a key, NULLs in ``order`` come first.

    One plan at every size: only keys that the batch holds are ranked anew, the other rows of the history pass by. With
    ``intervals`` the validity columns are kept too; a history that lacks them gets them as a whole.
    """
    made = [IS_CURRENT, VALID_FROM, VALID_TO]
    rank = validity if intervals else current_flag
    added = batch.drop(*made).withColumn("_added", F.lit(1))
    if history is None:
        rows, untouched = added, None
    else:
        marked = history.alias("h")
        touched_keys = batch.select(*[column(k) for k in keys]).distinct().alias("b")
        match = null_safe_match(keys, "h", "b")
        if intervals and VALID_FROM not in history.columns:
            stored, untouched = history, None
        else:
            stored = marked.join(touched_keys, match, "left_semi")
            untouched = marked.join(touched_keys, match, "left_anti")
        rows = stored.drop(*made).withColumn("_added", F.lit(0)).unionByName(added, allowMissingColumns=True)
    content = [c for c in rows.columns if not c.startswith(audit_prefix) and c not in {"_added", *keys, *order}]
    hashed = rows.withColumn("_content", content_hash(rows, content)) if content else rows.withColumn("_content", F.lit(0))
    distinct = _distinct_versions(hashed, [*keys, *order, "_content"], ["_added", *prefer]).drop("_content", "_added")
    ranked = rank(distinct, keys, [*order, *prefer], **skew)
    return ranked if untouched is None else untouched.unionByName(ranked, allowMissingColumns=True)


def _distinct_versions(df: DataFrame, identity: Sequence[str], prefer: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*[column(c) for c in identity]).orderBy(*[column(c) for c in prefer])
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
