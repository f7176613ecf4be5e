"""Both load steps over tables of the session catalog: reruns, pending batches, marks, gaps."""

from __future__ import annotations

import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge_upsert
from tidemark.operators.ingest import AUDIT_COLUMNS, BATCH_DATE, with_audit_columns
from tidemark.plans import LoadError, load_conformed, load_raw, preview
from tidemark.plans.loads import APPLIED, POSITION, raw_position, raw_watermark
from tidemark.sources import FrameSource, TableStore
from tidemark.spec import ChangeFeed, SpecError, TableSpec
from tidemark.streaming import apply_change_feed, stream_raw_changes

NUMBERS = itertools.count(1)
FEED_SCHEMA = (
    "`__$start_lsn` binary, `__$seqval` binary, `__$operation` int, `__$update_mask` binary, id int, v string"
)


@pytest.fixture
def store(spark):
    return TableStore(spark)


def lsn(n):
    return n.to_bytes(10, "big")


def text(n):
    return f"0x{n:020X}"


def spec_for(strategy, **more):
    n = next(NUMBERS)
    values = dict(
        table_id=f"t{n}",
        source_schema="dbo",
        source_table="T",
        raw_table=f"raw{n}.t",
        conformed_table=f"conformed{n}.t",
        primary_key=("id",),
        strategy=strategy,
        columns=("id", "v", "gone", "at"),
        initial_watermark="1900-01-01 00:00:00",
        watermark_column="at",
    )
    return TableSpec(**{**values, **more})


def at(second, micro=0):
    return datetime(2024, 1, 1, 12, 0, second, micro)


def rows_source(spark, rows):
    df = spark.createDataFrame(rows, "id int, v string, gone timestamp_ntz, at timestamp_ntz, secret string")
    return FrameSource({"T": df})


def load(store, spec, source):
    result = load_raw(store, spec, source)
    load_conformed(store, spec)
    return result


def content(store, spec, *columns):
    return sorted(map(tuple, store.read(spec.conformed_table).select(*columns).collect()))


def test_raw_rows_carry_audit_columns_and_no_secrets(spark, store):
    spec = spec_for("incremental_upsert", columns=("*",), exclude_columns=("secret",))
    result = load_raw(store, spec, rows_source(spark, [(1, "a", None, at(1), "s")]))
    raw = store.read(spec.raw_table)
    assert raw.columns == ["id", "v", "gone", "at", *AUDIT_COLUMNS, BATCH_DATE]
    row = raw.first()
    assert row["bronze_table_id"] == spec.table_id and row["bronze_watermark_used"] == "1900-01-01 00:00:00"
    assert row["bronze_soft_delete_column"] == "" and row["bronze_cdc_to_lsn"] == ""
    assert row["bronze_batch_id"] == result.batch_id
    assert (result.rows, result.mark) == (1, "2024-01-01 12:00:01")
    assert preview(store, spec, result.batch_id).count() == 1


def test_incremental_reads_only_what_is_new_to_the_microsecond(spark, store):
    spec = spec_for("incremental_upsert")
    first = rows_source(spark, [(1, "a", None, at(0, 123456), "s")])
    assert load_raw(store, spec, first).mark == "2024-01-01 12:00:00.123456"
    again = load_raw(store, spec, first)
    assert (again.rows, again.changed, again.mark) == (0, False, "2024-01-01 12:00:00.123456")
    assert store.read(spec.raw_table).count() == 1
    assert raw_watermark(store, spec) == "2024-01-01 12:00:00.123456"


def test_source_is_read_in_one_job_per_load(spark, store):
    spec = spec_for("incremental_upsert")
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        reads.add(1)
        yield from batches

    df = rows_source(spark, [(1, "a", None, at(1), "s")]).tables["T"].coalesce(1).mapInArrow(
        seen, "id int, v string, gone timestamp_ntz, at timestamp_ntz, secret string"
    )
    load_raw(store, spec, FrameSource({"T": df}))
    assert reads.value == 1


def test_lookback_rereads_and_stays_idempotent(spark, store):
    spec = spec_for("incremental_upsert", lookback_seconds=5)
    load(store, spec, rows_source(spark, [(1, "a", None, at(10), "s")]))
    late = [(1, "a", None, at(10), "s"), (2, "late", None, at(8), "s"), (3, "too late", None, at(4), "s")]
    load(store, spec, rows_source(spark, late))
    assert content(store, spec, "id", "v", "is_current") == [(1, "a", 1), (2, "late", 1)]


def test_upsert_keeps_versions_and_rerun_changes_nothing(spark, store):
    spec = spec_for("incremental_upsert")
    load(store, spec, rows_source(spark, [(1, "a", None, at(1), "s"), (2, "x", None, at(1), "s")]))
    load(store, spec, rows_source(spark, [(1, "b", None, at(2), "s"), (2, "x", None, at(1), "s")]))
    expected = [(1, "a", 0), (1, "b", 1), (2, "x", 1)]
    assert content(store, spec, "id", "v", "is_current") == expected
    assert not load_conformed(store, spec).changed
    load(store, spec, rows_source(spark, [(1, "b", None, at(2), "s")]))
    assert content(store, spec, "id", "v", "is_current") == expected


def test_two_pending_batches_are_both_applied(spark, store):
    for strategy in ("incremental_upsert", "incremental_with_soft_delete"):
        spec = spec_for(strategy)
        load(store, spec, rows_source(spark, [(1, "a", None, at(1), "s")]))
        load_raw(store, spec, rows_source(spark, [(1, "b", None, at(2), "s"), (2, "only here", None, at(2), "s")]))
        load_raw(store, spec, rows_source(spark, [(1, "c", None, at(3), "s")]))
        load_conformed(store, spec)
        newest = store.read(spec.conformed_table)
        if "is_current" in newest.columns:
            assert newest.count() == 4
            newest = newest.filter("is_current = 1")
        assert sorted(tuple(r) for r in newest.select("id", "v").collect()) == [(1, "c"), (2, "only here")]


def test_soft_delete(spark, store):
    spec = spec_for("incremental_with_soft_delete", soft_delete_column="gone")
    load(store, spec, rows_source(spark, [(1, "a", None, at(1), "s"), (2, "b", None, at(1), "s")]))
    load(store, spec, rows_source(spark, [(1, "a", at(2), at(2), "s")]))
    assert content(store, spec, "id", "v", "is_deleted") == [(1, "a", 1), (2, "b", 0)]


def test_snapshot_replaces_also_with_nothing(spark, store):
    spec = spec_for("full_snapshot", watermark_column=None)
    load(store, spec, rows_source(spark, [(1, "a", None, at(1), "s"), (2, "b", None, at(1), "s")]))
    load(store, spec, rows_source(spark, [(3, "c", None, at(1), "s")]))
    assert content(store, spec, "id", "v", "is_deleted") == [(3, "c", 0)]
    load(store, spec, rows_source(spark, []))
    assert content(store, spec, "id") == []


def test_versions_are_swapped_and_old_ones_dropped(spark, store):
    spec = spec_for("full_snapshot", watermark_column=None)
    for n in range(4):
        load(store, spec, rows_source(spark, [(n, "a", None, at(1), "s")]))
    schema, table = spec.conformed_table.split(".")
    kept = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {schema}").collect()]
    assert table in kept and len(kept) == 3
    assert APPLIED in store.properties(spec.conformed_table)


def feed_specs(**more):
    snapshot = spec_for(
        "full_snapshot", watermark_column=None, columns=("id", "v"), baseline_capture_instance="dbo_T", **more
    )
    feed = spec_for(
        "incremental_cdc",
        watermark_column=None,
        columns=("*",),
        conformed_table=snapshot.conformed_table,
        change_feed=ChangeFeed("dbo_T", baseline_table=snapshot.raw_table),
        **more,
    )
    return snapshot, feed


def feed_source(spark, rows, changes):
    table = spark.createDataFrame(rows, "id int, v string")
    log = [(lsn(p), lsn(s), op, None, k, v) for p, s, op, k, v in changes]
    return FrameSource({"T": table}, {"dbo_T": spark.createDataFrame(log, FEED_SCHEMA)})


def test_change_feed_from_snapshot_to_merge(spark, store):
    snapshot, feed = feed_specs()
    before = [(10, 1, 2, 1, "a"), (11, 1, 2, 2, "b")]
    assert load(store, snapshot, feed_source(spark, [(1, "a"), (2, "b")], before)).mark == text(11)
    assert raw_position(store, feed) == text(11)
    log = [*before, (12, 1, 3, 1, "a"), (12, 2, 4, 1, "a2"), (13, 1, 1, 2, "b"), (14, 1, 2, 3, "c"), (15, 1, 1, 4, "d")]
    result = load(store, feed, feed_source(spark, [], log))
    assert (result.rows, result.mark) == (4, text(15))
    expected = [(1, "a2", 0), (2, "b", 1), (3, "c", 0), (4, "d", 1)]
    assert content(store, feed, "id", "v", "is_deleted") == expected
    assert not load_raw(store, feed, feed_source(spark, [], log)).changed
    assert not load_conformed(store, feed).changed
    assert store.properties(feed.conformed_table)[APPLIED]
    revived = [*log, (16, 1, 2, 2, "b2")]
    load(store, feed, feed_source(spark, [], revived))
    assert content(store, feed, "id", "v", "is_deleted") == [(1, "a2", 0), (2, "b2", 0), (3, "c", 0), (4, "d", 1)]


def test_feed_position_survives_a_crash_before_the_property(spark, store):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a")], [(10, 1, 2, 1, "a")]))
    log = [(10, 1, 2, 1, "a"), (12, 1, 4, 1, "b")]
    load_raw(store, feed, feed_source(spark, [], log))
    store.set_property(feed.raw_table, POSITION, text(10))
    assert raw_position(store, feed) == text(12)


def test_empty_range_advances_the_position(spark, store):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a")], [(10, 1, 2, 1, "a")]))
    only_before_image = [(10, 1, 2, 1, "a"), (12, 1, 3, 1, "a")]
    result = load_raw(store, feed, feed_source(spark, [], only_before_image))
    assert (result.rows, result.mark) == (0, text(12))
    assert raw_position(store, feed) == text(12)
    assert not load_conformed(store, feed).changed


def test_empty_snapshot_starts_from_the_whole_log(spark, store):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [], []))
    result = load(store, feed, feed_source(spark, [], [(10, 1, 2, 1, "a"), (11, 1, 4, 1, "b")]))
    assert result.rows == 2
    assert content(store, feed, "id", "v", "is_deleted") == [(1, "b", 0)]


def test_lost_log_asks_for_a_snapshot(spark, store):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a")], [(10, 1, 2, 1, "a")]))
    with pytest.raises(LoadError, match="new snapshot"):
        load_raw(store, feed, feed_source(spark, [], [(20, 1, 4, 1, "b")]))


def test_change_feed_needs_its_snapshot(spark, store):
    _, feed = feed_specs()
    with pytest.raises(LoadError, match="snapshot"):
        load_raw(store, feed, feed_source(spark, [], [(10, 1, 2, 1, "a")]))
    with pytest.raises(LoadError, match="not there yet"):
        load_conformed(store, feed)


def test_absent_raw_table_is_an_empty_batch(spark, store):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a")], [(10, 1, 2, 1, "a")]))
    assert not load_conformed(store, feed).changed
    assert not load_conformed(store, spec_for("incremental_upsert")).changed


def test_stream_ends_where_the_batch_load_ends(spark, store, tmp_path):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a"), (2, "b")], [(10, 1, 2, 1, "a")]))
    log = [(10, 1, 2, 1, "a"), (12, 1, 4, 1, "a2"), (13, 1, 1, 2, "b")]
    load_raw(store, feed, feed_source(spark, [], log))

    def run_stream():
        query = apply_change_feed(store, feed, stream_raw_changes(store, feed), str(tmp_path / "checkpoint"))
        query.awaitTermination()

    run_stream()
    assert content(store, feed, "id", "v", "is_deleted") == [(1, "a2", 0), (2, "b", 1)]
    load_raw(store, feed, feed_source(spark, [], [*log, (14, 1, 2, 2, "b2"), (15, 1, 1, 9, "z")]))
    run_stream()
    streamed = content(store, feed, "id", "v", "is_deleted")
    assert streamed == [(1, "a2", 0), (2, "b2", 0), (9, "z", 1)]
    load_conformed(store, feed)
    assert content(store, feed, "id", "v", "is_deleted") == streamed


def test_pending_batches_prune_partitions(spark, store):
    spec = spec_for("incremental_upsert")
    load(store, spec, rows_source(spark, [(1, "a", None, at(1), "s")]))
    from tidemark.plans.loads import _after

    applied = int(store.properties(spec.conformed_table)[APPLIED])
    plan = _after(store.read(spec.raw_table), applied)._jdf.queryExecution().executedPlan().toString()
    assert BATCH_DATE in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [IsNotNull(bronze_ingestion_timestamp), GreaterThan" in plan


def files_of(store, spec):
    return len(store.read(spec.conformed_table).inputFiles())


def scan_keeps_buckets(df):
    return "Bucketed: true" in df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_merge_shuffles_only_the_batch(spark, store):
    spec = spec_for("incremental_with_soft_delete", buckets=4)
    load(store, spec, rows_source(spark, [(n, "a", None, at(1), "s") for n in range(200)]))
    assert store.buckets(spec.conformed_table) == 4 and files_of(store, spec) == 4
    for second in (2, 3, 4):
        rows = [(n, f"b{second}", None, at(second), "s") for n in range(150, 150 + 40 * second)]
        load(store, spec, rows_source(spark, rows))
        assert files_of(store, spec) == 4
    newest = store.read(spec.conformed_table)
    assert newest.count() == 310 and newest.select("id").distinct().count() == 310
    assert newest.filter("v = 'b4'").count() == 160 and newest.filter("v = 'a'").count() == 150

    # Partitions have to be pruned for the size of a partitioned table to be known.
    raw = store.read(spec.raw_table).filter("bronze_batch_date >= '2024-01-01'")
    batch = raw.groupBy("id").agg({"v": "max"}).select("id", "max(v)").toDF("id", "v")
    merged = merge_upsert(newest, batch, ["id"], buckets=4)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert scan_keeps_buckets(merged) and "ShuffledHashJoin" in plan
    target_side = plan[plan.index("ShuffledHashJoin") :].split("+- ")[0]
    assert "FileScan" in target_side and "Exchange" not in target_side and "Sort" not in target_side


def test_bucketed_change_feed(spark, store):
    snapshot, feed = feed_specs(buckets=4)
    load(store, snapshot, feed_source(spark, [(n, "a") for n in range(100)], [(10, 1, 2, 1, "a")]))
    log = [(10, 1, 2, 1, "a"), *[(20 + n, 1, 4 if n % 2 else 1, n, "b") for n in range(90, 120)]]
    load(store, feed, feed_source(spark, [], log))
    assert store.buckets(feed.conformed_table) == files_of(store, feed) == 4
    merged = store.read(feed.conformed_table)
    assert merged.count() == 120 and merged.filter("v = 'b' AND is_deleted = 0").count() == 15
    assert merged.filter("is_deleted = 1").count() == 15 and merged.filter("is_deleted = 1 AND v = 'a'").count() == 5


def test_versions_are_not_bucketed():
    with pytest.raises(SpecError, match="bucketed"):
        spec_for("incremental_upsert", buckets=4)


def test_a_batch_committed_late_is_applied(spark, store):
    spec = spec_for("incremental_upsert")
    load(store, spec, rows_source(spark, [(1, "a", None, at(1), "s")]))
    raw = store.read(spec.raw_table)
    # Another load started before the first one and commits after that was conformed.
    late = spark.createDataFrame(raw.collect(), raw.schema).withColumns({
        "id": F.lit(2), "bronze_batch_id": F.lit("late"),
        "bronze_ingestion_timestamp": F.expr("bronze_ingestion_timestamp - INTERVAL '1' HOUR"),
    })
    store.append(late, spec.raw_table, ["bronze_batch_date"])
    assert load_conformed(store, spec).changed
    assert content(store, spec, "id", "is_current", "valid_to") == [(1, 1, None), (2, 1, None)]
    assert not load_conformed(store, spec).changed


def test_a_late_batch_does_not_take_back_newer_rows(spark, store):
    spec = spec_for("incremental_with_soft_delete", soft_delete_column="gone")
    load(store, spec, rows_source(spark, [(1, "old", None, at(1), "s")]))
    load(store, spec, rows_source(spark, [(1, "new", None, at(3), "s")]))
    raw = store.read(spec.raw_table)
    late = spark.createDataFrame(raw.limit(1).collect(), raw.schema).withColumns({
        "v": F.lit("between"), "at": F.lit(at(2)).cast("timestamp_ntz"), "bronze_batch_id": F.lit("late")})
    store.append(late, spec.raw_table, ["bronze_batch_date"])
    assert load_conformed(store, spec).changed
    assert content(store, spec, "id", "v") == [(1, "new")]


def test_a_correction_under_an_equal_watermark_is_kept(spark, store):
    spec = spec_for("incremental_upsert", lookback_seconds=86_400)
    load(store, spec, rows_source(spark, [(1, "old", None, at(2), "s")]))
    load(store, spec, rows_source(spark, [(1, "corrected", None, at(2), "s")]))
    assert content(store, spec, "v", "is_current") == [("corrected", 1), ("old", 0)]


def test_a_snapshot_is_conformed_once(spark, store):
    snapshot, feed = feed_specs()
    log = [(10, 1, 2, 1, "a")]
    load(store, snapshot, feed_source(spark, [(1, "a")], log))
    load(store, feed, feed_source(spark, [], [*log, (20, 1, 4, 1, "CHANGED")]))
    assert content(store, snapshot, "id", "v") == [(1, "CHANGED")]
    assert not load_conformed(store, snapshot).changed
    assert content(store, snapshot, "id", "v") == [(1, "CHANGED")]


def test_excluded_columns_of_a_change_feed_stay_in_the_source(spark, store):
    snapshot, feed = feed_specs(exclude_columns=("v",))
    log = [(10, 1, 2, 1, "a")]
    load(store, snapshot, feed_source(spark, [(1, "a")], log))
    load_raw(store, feed, feed_source(spark, [], [*log, (20, 1, 4, 1, "secret")]))
    assert "v" not in store.read(feed.raw_table).columns


def test_watermark_is_read_without_the_table(spark, store, monkeypatch):
    spec = spec_for("incremental_upsert")
    load_raw(store, spec, rows_source(spark, [(1, "a", None, at(1), "s")]))
    monkeypatch.setattr(TableStore, "latest_partition", lambda *_: None)  # as in a v2 catalog
    from tidemark.plans import loads

    assert loads._newest_raw_rows(store, spec.raw_table, whole=False) is None
    assert raw_watermark(store, spec) == store.properties(spec.raw_table)[loads.WATERMARK]


OUT_OF_ORDER = [(12, 1, 4, 1, "old"), (12, 2, 1, 2, "b"), (13, 1, 4, 1, "new"), (13, 2, 2, 2, "back"), (14, 1, 1, 3, "c")]


def raw_changes(store, feed, changes, batch_id, upper):
    """Appends one raw batch of change rows, as an overlapping load would commit it."""
    log = [(lsn(p), lsn(s), op, None, k, v) for p, s, op, k, v in changes]
    rows = store.spark.createDataFrame(log, FEED_SCHEMA)
    stamped = with_audit_columns(rows, feed, cdc_from=text(10), cdc_to=text(upper), batch_id=batch_id)
    store.append(stamped.withColumn(BATCH_DATE, F.current_date()), feed.raw_table, [BATCH_DATE])


def test_a_late_change_batch_does_not_take_back_newer_changes(spark, store):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a"), (2, "b"), (3, "c")], [(10, 1, 2, 1, "a")]))
    raw_changes(store, feed, OUT_OF_ORDER, "whole", 14)
    assert load_conformed(store, feed).changed
    expected = [(1, "new", 0), (2, "back", 0), (3, "c", 1)]
    assert content(store, feed, "id", "v", "is_deleted") == expected
    raw_changes(store, feed, [*OUT_OF_ORDER[:2], (11, 1, 4, 3, "x")], "late", 12)
    assert load_conformed(store, feed).changed
    assert content(store, feed, "id", "v", "is_deleted") == expected
    raw_changes(store, feed, [(15, 1, 4, 1, "newest")], "next", 15)
    load_conformed(store, feed)
    assert content(store, feed, "id", "v", "is_deleted") == [(1, "newest", 0), *expected[1:]]


def test_changes_up_to_the_snapshot_do_not_take_it_back(spark, store):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a")], [(10, 1, 2, 1, "a")]))
    raw_changes(store, feed, [(9, 1, 4, 1, "before"), (9, 2, 4, 5, "e")], "old", 9)
    load_conformed(store, feed)
    assert content(store, feed, "id", "v", "is_deleted") == [(1, "a", 0), (5, "e", 0)]


def test_stream_batches_out_of_log_order(spark, store, tmp_path):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a"), (2, "b"), (3, "c")], [(10, 1, 2, 1, "a")]))

    def run(changes, batch_id):
        raw_changes(store, feed, changes, batch_id, 14)
        apply_change_feed(store, feed, stream_raw_changes(store, feed), str(tmp_path / "checkpoint")).awaitTermination()

    run(OUT_OF_ORDER[2:], "newer")
    run(OUT_OF_ORDER[:2], "older")
    assert content(store, feed, "id", "v", "is_deleted") == [(1, "new", 0), (2, "back", 0), (3, "c", 1)]
