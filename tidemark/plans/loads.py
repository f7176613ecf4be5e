"""The two load steps of a table: source to raw layer, raw layer to conformed layer.

The watermark and the log position are those of the committed raw batches, the applied batches those that the
published conformed table names; ``batches`` tells how both are kept. Raw tables from before there were records are asked for
their rows and properties.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import column, watermark_text
from ..operators import (
    align_to_target,
    append_versions,
    change_delete_flag,
    default_delete_flag,
    drop_change_columns,
    latest_batch,
    latest_per_key,
    merge_changes,
    merge_upsert,
    newest_changes,
    range_chain,
    relevant_changes,
    soft_delete_flag,
    unprocessed_batches,
    with_audit_columns,
)
from ..operators.merge import CDC_POSITION, with_change_position
from ..operators.ingest import BATCH_DATE, BATCH_ID, CDC_TO, INGESTED_AT
from ..sources.base import Source
from ..sources.tables import TableStore
from ..spec import LoadStrategy, TableSpec
from .batches import EPOCH, SEQUENCE, Ledger, RawBatches

POSITION = "tidemark.position"
WATERMARK = "tidemark.watermark"
# Ingestion time of the newest raw batch applied, and of the snapshot the table starts from, before which no batch counts.
APPLIED = "tidemark.applied"
FLOOR = "tidemark.floor"


class LoadError(RuntimeError):
    """A load that must not go on, e.g. because changes were lost."""


@dataclass(frozen=True)
class LoadResult:
    table_id: str
    # Rows written; None where the step does not count them.
    rows: int | None
    # Watermark, log position or applied batch after the step.
    mark: str | None
    changed: bool
    # Id of the raw batch that was written.
    batch_id: str | None = None


def load_raw(store: TableStore, spec: TableSpec, source: Source) -> LoadResult:
    """Read what is new in the source and commit it to the raw table, in one pass over the source."""
    if spec.strategy is LoadStrategy.FULL_SNAPSHOT:
        return _load_snapshot(store, spec, source)
    if spec.strategy is LoadStrategy.INCREMENTAL_CDC:
        return _load_changes(store, spec, source)
    last, batch_id = raw_watermark(store, spec), str(uuid.uuid4())
    rows = with_audit_columns(source.rows(spec, last), spec, source.system, last_watermark=last, batch_id=batch_id)
    highest = watermark_text(F.max(column(spec.watermark_column)))
    return _append(store, spec, rows, batch_id, highest, unchanged=last)


def preview(store: TableStore, spec: TableSpec, batch_id: str, n: int = 5) -> DataFrame:
    """A few rows of the newest raw batch as it was written; the source is not read again."""
    return _newest_raw_rows(store, spec.raw_table).filter(column(BATCH_ID) == batch_id).limit(n)


def _load_snapshot(store: TableStore, spec: TableSpec, source: Source) -> LoadResult:
    position = None
    if spec.baseline_capture_instance:
        # Taken before the rows are read: a change in between is then applied twice rather than never.
        position = source.max_position(spec.baseline_capture_instance)
    batch_id = str(uuid.uuid4())
    rows = with_audit_columns(source.rows(spec), spec, source.system, cdc_to=position, batch_id=batch_id)
    observed = Observation()
    store.replace(
        rows.observe(observed, F.count(F.lit(1)).alias("rows")),
        spec.raw_table,
        {POSITION: position} if position else None,
    )
    return LoadResult(spec.table_id, observed.get["rows"], position, changed=True, batch_id=batch_id)


def _load_changes(store: TableStore, spec: TableSpec, source: Source) -> LoadResult:
    feed = spec.change_feed
    lower = raw_position(store, spec)
    upper = source.max_position(feed.capture_instance)
    if upper is None:
        raise LoadError(f"{spec.table_id}: the source reports no log position")
    if lower is not None:
        if lower == upper:
            return LoadResult(spec.table_id, 0, upper, changed=False)
        check_log_reaches(spec, lower, source.min_position(feed.capture_instance))
    batch_id = str(uuid.uuid4())
    rows = with_audit_columns(
        source.changes(spec, lower, upper), spec, source.system, cdc_from=lower, cdc_to=upper, batch_id=batch_id
    )
    result = _append(store, spec, rows, batch_id, None, unchanged=upper, log_range=(lower, upper))
    store.set_property(spec.raw_table, POSITION, upper)
    return result


def _append(
    store: TableStore, spec: TableSpec, rows: DataFrame, batch_id: str, highest: Column | None, unchanged: str | None,
    log_range: tuple[str | None, str | None] = (None, None),
) -> LoadResult:
    """Append one batch; row count and highest watermark are observed by the write itself.

    The batch and its mark count from its record on. A crash before it leaves rows that no reader takes, and the next
    load reads the same rows of the source again.
    """
    batches = RawBatches(store, spec.raw_table)
    batches.begin(batch_id)
    observed = Observation()
    metrics = {"rows": F.count(F.lit(1))}
    if highest is not None:
        metrics["mark"] = highest
    dated = rows.withColumn(BATCH_DATE, F.to_date(column(INGESTED_AT)))
    watched = dated.observe(observed, *[metric.alias(name) for name, metric in metrics.items()])
    store.append(watched, spec.raw_table, partition_by=[BATCH_DATE])
    seen = observed.get
    watermark = None if highest is None else seen.get("mark") or unchanged
    batches.commit(batch_id, seen["rows"], watermark, *log_range)
    if seen.get("mark") is not None:
        # For whoever looks at the table; loads go by the record.
        store.set_property(spec.raw_table, WATERMARK, seen["mark"])
    return LoadResult(spec.table_id, seen["rows"], seen.get("mark") or unchanged, seen["rows"] > 0, batch_id)


def check_log_reaches(spec: TableSpec, lower: str, lowest: str | None) -> None:
    """The log must still hold every position after ``lower``."""
    if lowest is not None and int(lower, 16) + 1 < int(lowest, 16):
        raise LoadError(
            f"{spec.table_id}: the change log starts at {lowest}, after the last loaded position {lower}; "
            "changes in between are gone, take a new snapshot"
        )


def raw_watermark(store: TableStore, spec: TableSpec) -> str | None:
    """Highest committed watermark, else the spec's initial one.

    Told by the records of the batches. A table without any has it as a property; where the catalog lists partitions
    the newest one is asked as well. Without either, the table is read.
    """
    if not store.exists(spec.raw_table):
        return spec.initial_watermark
    recorded = RawBatches(store, spec.raw_table).mark("watermark")
    if recorded is not None:
        return recorded
    stored = store.properties(spec.raw_table).get(WATERMARK)
    newest = _newest_raw_rows(store, spec.raw_table, whole=stored is None)
    if newest is not None:
        highest = newest.agg(watermark_text(F.max(column(spec.watermark_column))).alias("mark")).first()["mark"]
        return max(filter(None, (stored, highest)), default=spec.initial_watermark)
    return stored


def raw_position(store: TableStore, spec: TableSpec) -> str | None:
    """Last loaded log position: of the change rows, of an empty range, or of the snapshot to start from.

    None means the snapshot found an empty table, so the whole log applies.
    """
    known = [_table_position(store, spec.raw_table)]
    baseline = spec.change_feed.baseline_table
    if baseline is not None:
        known.append(_table_position(store, baseline))
    positions = [p for p in known if p]
    if positions:
        return max(positions)
    if baseline is None or not store.exists(baseline):
        raise LoadError(f"{spec.table_id}: no position to start from; run the snapshot load first")
    return None


def _table_position(store: TableStore, table: str) -> str | None:
    if not store.exists(table):
        return None
    recorded = RawBatches(store, table).mark("to_position")
    if recorded is not None:
        return recorded
    stored = store.properties(table).get(POSITION)
    # A crash may come between a committed batch and its property, so the rows are asked as well.
    newest = _newest_raw_rows(store, table, whole=stored is None)
    committed = newest.agg(F.max(column(CDC_TO)).alias("mark")).first()["mark"] if newest is not None else None
    return max(filter(None, (stored, committed)), default=None)


def _newest_raw_rows(store: TableStore, table: str, whole: bool = True) -> DataFrame | None:
    """Rows of the newest partition; where the catalog lists none, the whole table if ``whole`` is set."""
    rows = committed_rows(store, table)
    day = None if rows is None or BATCH_DATE not in rows.columns else store.latest_partition(table, BATCH_DATE)
    if rows is None or day is None:
        return rows if whole else None
    return rows.filter(column(BATCH_DATE) == F.lit(day).cast("date"))


def newest_batch(store: TableStore, table: str) -> DataFrame | None:
    """Rows of the newest batch of a raw table; None where there is no table.

    Found by the records of the batches, else by the highest ingestion time among the rows.
    """
    rows = store.read_if_exists(table)
    if rows is None:
        return None
    newest = RawBatches(store, table).newest(rows)
    return latest_batch(rows) if newest is None else newest


def committed_rows(store: TableStore, table: str) -> DataFrame | None:
    """Rows of a raw table without those of loads that run or have crashed; None where there is no table."""
    rows = store.read_if_exists(table)
    return None if rows is None else RawBatches(store, table).committed(rows)


def log_coverage(store: TableStore, spec: TableSpec) -> DataFrame:
    """Holes and overlaps in the log ranges of the committed raw batches (see ``range_chain``).

    An overlap is what two loads at a time leave, and harmless; a hole means changes that were never loaded.
    """
    records = RawBatches(store, spec.raw_table).records()
    if records is None:
        raise LoadError(f"{spec.table_id}: no batch of {spec.raw_table} has a record")
    return range_chain(records, "from_position", "to_position")


def load_conformed(store: TableStore, spec: TableSpec) -> LoadResult:
    """Apply every raw batch that the conformed table has not seen yet, however late it was committed."""
    raw = committed_rows(store, spec.raw_table)
    target = store.read_if_exists(spec.conformed_table)
    known = {} if target is None else store.properties(spec.conformed_table)
    if spec.strategy is LoadStrategy.FULL_SNAPSHOT:
        if raw is None:
            raise LoadError(f"{spec.table_id}: nothing to conform, its raw table is missing")
        newest = raw.agg(F.max(F.unix_micros(column(INGESTED_AT))).alias("at")).first()["at"]
        if newest is not None and known.get(FLOOR) == str(newest):
            # Applied before; what changes have made of it since must stay.
            return LoadResult(spec.table_id, 0, known.get(APPLIED), changed=False)
        applied = {} if newest is None else {APPLIED: str(newest), FLOOR: str(newest)}
        # Batches of changes applied so far are no part of the new content.
        applied |= {SEQUENCE: known[SEQUENCE], EPOCH: known[SEQUENCE]} if SEQUENCE in known else {}
        _publish(store, spec, conform(spec, raw, None), applied)
        return LoadResult(spec.table_id, None, applied.get(APPLIED), changed=True)
    if spec.strategy is LoadStrategy.INCREMENTAL_CDC and target is None:
        raise LoadError(_no_baseline(spec))

    ledger, newest = Ledger(store, spec.conformed_table), known.get(APPLIED)
    pending = None if raw is None else ledger.pending(_after(raw, _floor(known, target)), known)
    if pending is None or pending.isEmpty():
        return LoadResult(spec.table_id, 0, newest, changed=False)
    sequence = int(known.get(SEQUENCE, 0)) + 1
    ledger.enter(pending, sequence)
    added = ledger.entered(sequence).agg(F.max(F.unix_micros("batch_at")).alias("at")).first()["at"]
    newest = str(max(int(newest or 0), added or 0))
    mark = {**known, APPLIED: newest, SEQUENCE: str(sequence)}
    if SEQUENCE not in known:
        # The table's first ledger entry: what came before is told by its time, once and for all.
        floor = _floor(known, target)
        mark |= {} if floor is None else {FLOOR: str(floor)}
    batch = ledger.rows_of(raw, sequence)
    if target is None:
        _publish(store, spec, conform(spec, batch, None), mark)
    elif spec.strategy is LoadStrategy.INCREMENTAL_UPSERT:
        if store.parts(spec.conformed_table):
            store.rewrite_touched(spec.conformed_table, batch, lambda stored: conform(spec, batch, stored), mark)
        else:
            store.replace(conform(spec, batch, target), spec.conformed_table, mark)
    else:
        changes = spec.strategy is LoadStrategy.INCREMENTAL_CDC
        store.merge(
            merge_rows(spec, batch, target.columns), spec.conformed_table, spec.primary_key, changes, mark,
            newer_by=() if changes else spec.version_order,
        )
    return LoadResult(spec.table_id, None, newest, changed=True)


def _publish(store: TableStore, spec: TableSpec, rows: DataFrame, properties: dict[str, str]) -> None:
    store.replace(
        rows, spec.conformed_table, properties, bucket_by=spec.primary_key, buckets=spec.buckets, parts=spec.parts)


def _no_baseline(spec: TableSpec) -> str:
    return f"{spec.table_id}: changes need a table to go into, {spec.conformed_table} is not there yet"


def conform(spec: TableSpec, batch: DataFrame, target: DataFrame | None, buckets: int = 0) -> DataFrame:
    """The conformed table after applying raw rows ``batch`` to ``target``, itself stored in ``buckets``."""
    if spec.strategy is LoadStrategy.FULL_SNAPSHOT:
        return default_delete_flag(latest_batch(batch).drop(BATCH_DATE))
    if spec.strategy is LoadStrategy.INCREMENTAL_UPSERT:
        return append_versions(
            target, batch.drop(BATCH_DATE), spec.primary_key, spec.version_order, [INGESTED_AT], intervals=True)
    if spec.strategy is LoadStrategy.INCREMENTAL_SOFT_DELETE:
        if target is None:
            return merge_rows(spec, batch)
        rows = merge_rows(spec, batch, target.columns)
        return merge_upsert(target, rows, spec.primary_key, buckets, newer_by=spec.version_order)
    if target is None:
        raise LoadError(_no_baseline(spec))
    return merge_changes(target, merge_rows(spec, batch, target.columns), spec.primary_key, buckets)


def merge_rows(spec: TableSpec, batch: DataFrame, target_columns: list[str] | None = None) -> DataFrame:
    """Raw rows reduced to what a merge takes: the newest row per key, with its delete flag."""
    batch = batch.drop(BATCH_DATE)
    if spec.strategy is LoadStrategy.INCREMENTAL_CDC:
        newest = newest_changes(relevant_changes(batch), spec.primary_key)
        changes = drop_change_columns(with_change_position(change_delete_flag(newest)))
        return align_to_target(changes, dict.fromkeys([*target_columns, CDC_POSITION]))
    newest = latest_per_key(batch, spec.primary_key, [INGESTED_AT, *spec.version_order])
    return soft_delete_flag(newest, spec.soft_delete_column)


def _floor(known: dict[str, str], target: DataFrame | None) -> int | None:
    """Ingestion time (microseconds) up to which no batch counts: of the snapshot the table starts from.

    A table that was loaded before it had a ledger starts from its newest batch.
    """
    if SEQUENCE in known or target is None:
        return int(known[FLOOR]) if FLOOR in known else None
    stored = known.get(APPLIED)
    if stored is None and INGESTED_AT in target.columns:
        return target.agg(F.max(F.unix_micros(column(INGESTED_AT))).alias("at")).first()["at"]
    return None if stored is None else int(stored)


def _after(raw: DataFrame, floor: int | None) -> DataFrame:
    """Raw rows of batches that began after the floor; the days before it are pruned."""
    if floor is None:
        return raw
    bound = F.timestamp_micros(F.lit(floor))
    rows = unprocessed_batches(raw, bound)
    # A day of slack covers a change of the session's time zone.
    return rows.filter(column(BATCH_DATE) >= F.date_sub(F.to_date(bound), 1)) if BATCH_DATE in raw.columns else rows
