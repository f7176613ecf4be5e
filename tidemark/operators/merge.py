"""Merging a batch into a table by key, written as joins so that any table format can take the result."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions import column, flag, lsn_hex
from ..sizing import beside_buckets, estimated_bytes, fits_broadcast
from .history import latest_per_key
from .ingest import CDC_TO, CHANGE_COLUMNS, OPERATION, SEQVAL, START_LSN

IS_DELETED = "is_deleted"
# Log position of the last change applied to a key: (start_lsn, seqval, operation).
CDC_POSITION = "cdc_position"

# Operation codes of the change feed.
OP_DELETE, OP_INSERT, OP_UPDATE_BEFORE, OP_UPDATE_AFTER = 1, 2, 3, 4

# The target must outweigh the batch this many times before a second scan of it beats shuffling it.
LOOKUP_RATIO = 8


def relevant_changes(df: DataFrame, operation: str = OPERATION) -> DataFrame:
    """Deletes, inserts and after-images; before-images carry nothing to apply."""
    return df.filter(column(operation).isin(OP_DELETE, OP_INSERT, OP_UPDATE_AFTER))


def newest_changes(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (START_LSN, SEQVAL, OPERATION)
) -> DataFrame:
    """The last change of each key by log position."""
    return latest_per_key(df, keys, order)


def change_delete_flag(df: DataFrame, operation: str = OPERATION) -> DataFrame:
    return df.withColumn(IS_DELETED, flag(column(operation) == OP_DELETE))


def with_change_position(df: DataFrame) -> DataFrame:
    """Keeps a change's place in the log in one column."""
    return df.withColumn(CDC_POSITION, F.struct(
        column(START_LSN).alias("start_lsn"), column(SEQVAL).alias("seqval"), column(OPERATION).alias("operation")))


def soft_delete_flag(df: DataFrame, soft_delete_column: str | None) -> DataFrame:
    """1 where the delete date is set; 0 for every row when the table has no such column."""
    if not soft_delete_column:
        return df.withColumn(IS_DELETED, F.lit(0))
    return df.withColumn(IS_DELETED, flag(column(soft_delete_column).isNotNull()))


def default_delete_flag(df: DataFrame) -> DataFrame:
    return df if IS_DELETED in df.columns else df.withColumn(IS_DELETED, F.lit(0))


def drop_change_columns(df: DataFrame, names: Sequence[str] = CHANGE_COLUMNS) -> DataFrame:
    return df.drop(*names)


def align_to_target(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """The columns both sides have, in target order: new source columns go, missing ones stay missing."""
    have = set(df.columns)
    return df.select(*[column(c) for c in target_columns if c in have])


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], buckets: int = 0, newer_by: Sequence[str] = ()
) -> DataFrame:
    """Matched rows take every source value, new keys are added, all other target rows stay.

    With ``newer_by`` a source row that is older by these columns, as one of a late batch may be, changes nothing. Keys must be unique in ``source`` (see ``latest_per_key``) and in ``target``. ``buckets`` is the number of
    buckets the target is stored in by key, 0 when it is not bucketed.
    """
    takes = F.col("s._present") & not_older(newer_by, "s", "t")
    return _merge(target, source, keys, lambda _name: takes, buckets)


def not_older(order: Sequence[str], source: str, target: str) -> Column:
    """True unless the source row comes before the target row; NULLs come first."""
    if not order:
        return F.lit(True)
    rows = [F.struct(*[column(c, side) for c in order]) for side in (source, target)]
    return rows[0] >= rows[1]


def merge_changes(target: DataFrame, source: DataFrame, keys: Sequence[str], buckets: int = 0) -> DataFrame:
    """Merge changes flagged by ``is_deleted``; keys and buckets as for ``merge_upsert``.

    A delete only sets the flag and keeps the target's values; a live change takes all values and revives a
    deleted row; an unseen key is added, even when its last change is a delete. Where ``source`` has log positions
    (see ``with_change_position``), the table keeps them, and a change before the key's last one changes nothing.
    """
    if CDC_POSITION in source.columns and CDC_POSITION not in target.columns:
        target = target.withColumn(CDC_POSITION, F.lit(None).cast(source.schema[CDC_POSITION].dataType))
    takes = F.col("s._present") & not_before(source, target.columns, "s", "t")
    live = takes & ((column(IS_DELETED, "s") == 0) | F.col("t._present").isNull())

    def takes_source(name: str) -> Column:
        return takes if name in (IS_DELETED, CDC_POSITION) else live

    return _merge(target, source, keys, takes_source, buckets)


def not_before(changes: DataFrame, target_columns: Sequence[str], source: str, target: str) -> Column:
    """True unless the change comes before the last one of its key.

    A row that no change with a position has reached, as those of a snapshot, counts as read at its ``CDC_TO``.
    """
    if CDC_POSITION not in changes.columns:
        return F.lit(True)
    tests = [column(CDC_POSITION, source) >= column(CDC_POSITION, target)]
    if CDC_TO in target_columns and isinstance(changes.schema[CDC_POSITION].dataType["start_lsn"].dataType, BinaryType):
        position = F.lower(lsn_hex(column(CDC_POSITION, source).getField("start_lsn")))
        tests.append(position >= F.lower(column(CDC_TO, target)))
    return F.coalesce(*tests, F.lit(True))


def _merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], takes_source: Callable[[str], Column], buckets: int
) -> DataFrame:
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"source columns not in the target: {', '.join(unknown)}")
    types = {f.name: f.dataType for f in target.schema.fields}
    typed = source.select(*[column(c).cast(types[c]).alias(c) for c in source.columns])
    t = target.withColumn("_present", F.lit(True)).alias("t")
    s = typed.withColumn("_present", F.lit(True)).alias("s")

    def merged(name: str) -> Column:
        if name in keys:
            return F.coalesce(column(name, "t"), column(name, "s")).alias(name)
        if name not in source.columns:
            return column(name, "t").alias(name)
        return F.when(takes_source(name), column(name, "s")).otherwise(column(name, "t")).alias(name)

    on = [column(k, "t") == column(k, "s") for k in keys]
    columns = [merged(c) for c in target.columns]
    if buckets or not _prefers_lookup(target, source):
        # A bucketed target stays where it is and only the batch is shuffled, into the same buckets.
        return t.join(beside_buckets(s, keys, buckets), on, "full_outer").select(*columns)

    # Catalyst broadcasts the batch by its estimate, adaptive execution by its measured size; no hint binds either.
    updated = t.join(s, on, "left").select(*columns)
    target_keys = target.select(*[column(k) for k in keys]).alias("t")
    # One row per matched batch row at most, because keys are unique in the target.
    matched = target_keys.join(s, on, "left_semi")
    added = typed.alias("s").join(matched.alias("t"), on, "left_anti")
    return updated.unionByName(added, allowMissingColumns=True)


def _prefers_lookup(target: DataFrame, source: DataFrame) -> bool:
    if not fits_broadcast(source) or fits_broadcast(target):
        return False
    target_bytes, source_bytes = estimated_bytes(target), estimated_bytes(source)
    return target_bytes is not None and target_bytes > LOOKUP_RATIO * source_bytes
