"""Records of raw batches, the ledger of applied ones, parts, and fenced micro-batches: crashes, late batches, reruns."""

from __future__ import annotations

import os
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F
from test_loads import (
    at, content, feed_source, feed_specs, load, lsn, raw_changes, rows_source, spec_for, text,
)

from tidemark.operators.ingest import BATCH_DATE, BATCH_ID, INGESTED_AT
from tidemark.plans import load_conformed, load_raw, loads, newest_batch
from tidemark.plans.batches import SEQUENCE, Ledger, RawBatches
from tidemark.plans.loads import FLOOR, log_coverage, raw_position, raw_watermark
from tidemark.sources import TableStore
from tidemark.sources.parts import folders_of
from tidemark.sources.tables import VERSION
from tidemark.spec import SpecError
from tidemark.streaming import apply_change_feed, stream_raw_changes
from tidemark.streaming.change_feed import STREAM_BATCH, merge_once


class Crash(RuntimeError):
    pass


def crashing(monkeypatch, owner, method):
    def crash(*_args, **_more):
        raise Crash

    monkeypatch.setattr(owner, method, crash)


@pytest.fixture
def store(spark):
    return TableStore(spark)


@pytest.mark.parametrize("point", [(RawBatches, "begin"), (TableStore, "append"), (RawBatches, "commit")])
def test_a_crash_leaves_neither_batch_nor_mark(spark, store, monkeypatch, point):
    spec = spec_for("incremental_upsert")
    load(store, spec, rows_source(spark, [(1, "a", None, at(1), "s")]))
    more = rows_source(spark, [(1, "a", None, at(1), "s"), (2, "b", None, at(2), "s")])
    with monkeypatch.context() as patch:
        crashing(patch, *point)
        with pytest.raises(Crash):
            load_raw(store, spec, more)
    assert raw_watermark(store, spec) == "2024-01-01 12:00:01"
    assert not load_conformed(store, spec).changed
    assert content(store, spec, "id") == [(1,)]
    result = load(store, spec, more)
    assert (result.rows, result.mark) == (1, "2024-01-01 12:00:02")
    assert content(store, spec, "id", "v") == [(1, "a"), (2, "b")]


def test_a_crash_after_the_record_keeps_both(spark, store, monkeypatch):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a")], [(10, 1, 2, 1, "a")]))
    log = [(10, 1, 2, 1, "a"), (12, 1, 4, 1, "b")]
    with monkeypatch.context() as patch:
        crashing(patch, TableStore, "set_property")
        with pytest.raises(Crash):
            load_raw(store, feed, feed_source(spark, [], log))
    assert raw_position(store, feed) == text(12)
    assert not load_raw(store, feed, feed_source(spark, [], log)).changed
    assert load_conformed(store, feed).changed
    assert content(store, feed, "id", "v") == [(1, "b")]


def test_rows_of_a_crashed_change_load_are_not_applied(spark, store, monkeypatch):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a")], [(10, 1, 2, 1, "a")]))
    log = [(10, 1, 2, 1, "a"), (12, 1, 4, 1, "b")]
    with monkeypatch.context() as patch:
        crashing(patch, RawBatches, "commit")
        with pytest.raises(Crash):
            load_raw(store, feed, feed_source(spark, [], log))
    assert store.read(feed.raw_table).count() == 1 and loads.committed_rows(store, feed.raw_table).count() == 0
    assert raw_position(store, feed) == text(10)
    assert not load_conformed(store, feed).changed
    load(store, feed, feed_source(spark, [], log))
    assert store.read(feed.raw_table).count() == 2 and content(store, feed, "id", "v") == [(1, "b")]


def late_batch(store, spec, days, batch_id, **values):
    raw = store.read(spec.raw_table)
    back = F.expr(f"INTERVAL '{days}' DAY")
    late = store.spark.createDataFrame(raw.limit(1).collect(), raw.schema).withColumns({
        BATCH_ID: F.lit(batch_id), INGESTED_AT: F.col(INGESTED_AT) - back,
        BATCH_DATE: F.to_date(F.col(INGESTED_AT) - back), **{k: F.lit(v) for k, v in values.items()}})
    store.append(late, spec.raw_table, [BATCH_DATE])


@pytest.mark.parametrize("days", [8, 30, 400])
def test_a_batch_is_applied_once_however_late(spark, store, days):
    spec = spec_for("incremental_upsert")
    load(store, spec, rows_source(spark, [(1, "a", None, at(1), "s")]))
    load(store, spec, rows_source(spark, [(2, "b", None, at(2), "s")]))
    late_batch(store, spec, days, "late", id=3)
    assert load_conformed(store, spec).changed
    assert [r[0] for r in content(store, spec, "id")] == [1, 2, 3]
    assert store.properties(spec.conformed_table)[SEQUENCE] == "3"
    assert not load_conformed(store, spec).changed


def test_batches_before_the_snapshot_do_not_count(spark, store):
    snapshot, feed = feed_specs()
    source = feed_source(spark, [(1, "a")], [(10, 1, 2, 1, "a")])
    load(store, snapshot, source)
    raw_changes(store, feed, [(12, 1, 4, 1, "b")], "one", 12)
    load_conformed(store, feed)
    # A new snapshot starts afresh: batches applied to the old content count again only from its time on.
    load(store, snapshot, feed_source(spark, [(1, "fresh")], [(13, 1, 4, 1, "fresh")]))
    assert content(store, feed, "id", "v") == [(1, "fresh")]
    assert not load_conformed(store, feed).changed
    raw_changes(store, feed, [(14, 1, 4, 1, "c")], "two", 14)
    assert load_conformed(store, feed).changed and content(store, feed, "id", "v") == [(1, "c")]
    known = store.properties(feed.conformed_table)
    assert known[SEQUENCE] == "2" and FLOOR in known
    assert {r[0] for r in Ledger(store, feed.conformed_table).applied(known).collect()} == {"two"}


def test_a_crash_before_publication_applies_nothing(spark, store, monkeypatch):
    spec = spec_for("incremental_with_soft_delete")
    load(store, spec, rows_source(spark, [(1, "a", None, at(1), "s")]))
    load_raw(store, spec, rows_source(spark, [(1, "b", None, at(2), "s")]))
    with monkeypatch.context() as patch:
        crashing(patch, TableStore, "merge")
        with pytest.raises(Crash):
            load_conformed(store, spec)
    assert content(store, spec, "id", "v") == [(1, "a")]
    load_raw(store, spec, rows_source(spark, [(2, "c", None, at(3), "s")]))
    assert load_conformed(store, spec).changed
    assert content(store, spec, "id", "v") == [(1, "b"), (2, "c")]
    assert not load_conformed(store, spec).changed


def test_a_table_from_before_the_ledger_goes_on(spark, store):
    spec = spec_for("incremental_with_soft_delete")
    load(store, spec, rows_source(spark, [(1, "a", None, at(1), "s")]))
    store.spark.sql(f"ALTER VIEW {spec.conformed_table} UNSET TBLPROPERTIES ('{SEQUENCE}')")
    assert not load_conformed(store, spec).changed
    load(store, spec, rows_source(spark, [(2, "b", None, at(2), "s")]))
    assert content(store, spec, "id", "v") == [(1, "a"), (2, "b")]
    late_batch(store, spec, 0, "late", id=3)
    assert not load_conformed(store, spec).changed  # not later than what its time says was applied


def files(store, spec):
    version = store.spark.table(store.properties(spec.conformed_table)[VERSION])
    return {f: os.stat(urlparse(f).path).st_mtime_ns for f in version.inputFiles()}


def test_a_merge_rewrites_the_parts_it_touches(spark, store):
    spec = spec_for("incremental_with_soft_delete", parts=16)
    load(store, spec, rows_source(spark, [(n, "a", None, at(1), "s") for n in range(2000)]))
    before = files(store, spec)
    parts = folders_of(spark.table(store.properties(spec.conformed_table)[VERSION]))
    assert len(parts) == 16
    load(store, spec, rows_source(spark, [(7, "b", None, at(2), "s"), (8, "b", None, at(2), "s")]))
    after = files(store, spec)
    kept = set(before) & set(after)
    assert all(before[f] == after[f] for f in kept)
    written = [f for f in after if f not in kept]
    touched = {f.rpartition("/")[0].rpartition("=")[2] for f in written}
    assert 1 <= len(touched) <= 2 and len({f.rpartition("/")[0] for f in kept}) == 16 - len(touched)
    size = sum(os.path.getsize(urlparse(f).path) for f in after)
    assert sum(os.path.getsize(urlparse(f).path) for f in written) < size / 4
    table = store.read(spec.conformed_table)
    assert "_part" not in table.columns and table.count() == 2000 and table.filter("v = 'b'").count() == 2
    load(store, spec, rows_source(spark, [(5000, "new", None, at(3), "s"), (7, "c", None, at(3), "s")]))
    assert table.sparkSession.table(spec.conformed_table).count() == 2001
    assert sorted(content(store, spec, "id", "v"))[7] == (7, "c")


def test_parts_of_dropped_versions_go(spark, store):
    spec = spec_for("incremental_with_soft_delete", parts=4)
    for second in range(1, 7):
        load(store, spec, rows_source(spark, [(n, f"v{second}", None, at(second), "s") for n in (second, 100)]))
    assert content(store, spec, "id", "v") == [*((n, f"v{n}") for n in range(1, 7)), (100, "v6")]
    listed = set()
    for version in store._versions(spec.conformed_table):
        listed |= {urlparse(f).path for f in folders_of(spark.table(version)).values()}
    root = Path(urlparse(store._part_root(spec.conformed_table)).path)
    assert {str(p) for p in root.glob("*/_part=*")} == listed
    assert len(store._versions(spec.conformed_table)) == 2


def test_changes_into_parts(spark, store):
    snapshot, feed = feed_specs(parts=8)
    load(store, snapshot, feed_source(spark, [(n, "a") for n in range(100)], [(10, 1, 2, 1, "a")]))
    log = [(10, 1, 2, 1, "a"), *[(20 + n, 1, 4 if n % 2 else 1, n, "b") for n in range(90, 120)]]
    load(store, feed, feed_source(spark, [], log))
    merged = store.read(feed.conformed_table)
    assert merged.count() == 120 and merged.filter("v = 'b' AND is_deleted = 0").count() == 15
    assert merged.filter("is_deleted = 1").count() == 15 and merged.filter("is_deleted = 1 AND v = 'a'").count() == 5
    late = [(15, 1, 4, 91, "late"), (130, 1, 4, 3, "c")]
    raw_changes(store, feed, late, "late", 130)
    load_conformed(store, feed)
    assert dict(content(store, feed, "id", "v"))[91] == "b" and dict(content(store, feed, "id", "v"))[3] == "c"


def test_versions_in_parts(spark, store):
    spec = spec_for("incremental_upsert", parts=8)
    load(store, spec, rows_source(spark, [(n, "a", None, at(1), "s") for n in range(50)] + [(None, "n", None, at(1), "s")]))
    before = files(store, spec)
    load(store, spec, rows_source(spark, [(3, "b", None, at(2), "s"), (None, "m", None, at(2), "s")]))
    assert 1 <= len(set(files(store, spec)) - set(before)) <= 2
    got = store.read(spec.conformed_table).filter("id = 3 OR id IS NULL").select("id", "v", "is_current")
    assert sorted(map(tuple, got.collect()), key=repr) == [(3, "a", 0), (3, "b", 1), (None, "m", 1), (None, "n", 0)]
    assert store.read(spec.conformed_table).count() == 53


def test_parts_and_buckets_exclude_each_other():
    with pytest.raises(SpecError, match="not both"):
        spec_for("incremental_with_soft_delete", parts=4, buckets=4)


def test_holes_between_loads_are_found(spark, store):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a")], [(10, 1, 2, 1, "a")]))
    load_raw(store, feed, feed_source(spark, [], [(10, 1, 2, 1, "a"), (12, 1, 4, 1, "b")]))
    assert log_coverage(store, feed).count() == 0
    batches = RawBatches(store, feed.raw_table)
    batches.commit("skips", 1, None, text(14), text(16))
    batches.commit("again", 1, None, text(15), text(18))
    found = sorted(map(tuple, log_coverage(store, feed).collect()))
    assert found == [("hole", text(12), text(14)), ("overlap", text(15), text(16))]


def test_a_repeated_micro_batch_writes_nothing(spark, store, tmp_path):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a")], [(10, 1, 2, 1, "a")]))
    raw_changes(store, feed, [(12, 1, 4, 1, "b")], "one", 12)
    apply_change_feed(store, feed, stream_raw_changes(store, feed), str(tmp_path / "c")).awaitTermination()
    query, _, number = store.properties(feed.conformed_table)[STREAM_BATCH].partition("@")
    assert query and number == "0"
    versions = store._versions(feed.conformed_table)
    batch = store.read(feed.raw_table)
    assert not merge_once(store, feed, batch, query, 0)
    assert store._versions(feed.conformed_table) == versions
    assert merge_once(store, feed, batch, "another query", 0)
    assert merge_once(store, feed, batch, None, 0)
    assert content(store, feed, "id", "v") == [(1, "b")]


def test_a_backlog_comes_in_bounded_micro_batches(spark, store, tmp_path):
    snapshot, feed = feed_specs()
    load(store, snapshot, feed_source(spark, [(1, "a")], [(10, 1, 2, 1, "a")]))
    for n in (12, 13, 14):
        raw_changes(store, feed, [(n, 1, 4, 1, f"v{n}")], str(n), n)
    raw_files = len(store.read(feed.raw_table).inputFiles())
    query = apply_change_feed(store, feed, stream_raw_changes(store, feed, files_per_batch=1), str(tmp_path / "c"))
    query.awaitTermination()
    assert content(store, feed, "id", "v") == [(1, "v14")]
    assert store.properties(feed.conformed_table)[STREAM_BATCH].endswith(f"@{raw_files - 1}")


def test_a_lookup_reads_one_part(spark, store):
    spec = spec_for("incremental_with_soft_delete", parts=20)
    load(store, spec, rows_source(spark, [(n, f"v{n}", None, at(1), "s") for n in range(1000)]))
    load(store, spec, rows_source(spark, [(7, "new", None, at(2), "s")]))
    table = store.read(spec.conformed_table)
    for values, expected in [({"id": 7}, ["new"]), ({"id": "8"}, ["v8"]), ({"id": 9, "v": "v9"}, ["v9"]), ({"id": -1}, []), ({"id": None}, [])]:
        found = store.lookup(spec.conformed_table, values)
        assert [r.v for r in found.collect()] == expected and found.columns == table.columns
        # What the scan lists after pruning, not all files of the version.
        opened = spark.createDataFrame(found.select("_metadata.file_path").distinct().collect(), "file_path string")
        assert opened.count() <= 1
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(_part" in plan and "xxhash64" not in plan, plan
    # Without the whole key every part is asked.
    assert [r.id for r in store.lookup(spec.conformed_table, {"v": "v12"}).collect()] == [12]
    assert len(store.lookup(spec.conformed_table, {"id": 8}).inputFiles()) < len(table.inputFiles()) / 5


def test_a_lookup_in_a_table_without_parts(spark, store):
    spec = spec_for("incremental_with_soft_delete")
    load(store, spec, rows_source(spark, [(1, "a", None, at(1), "s"), (2, None, None, at(1), "s")]))
    assert [r.v for r in store.lookup(spec.conformed_table, {"id": 1}).collect()] == ["a"]
    assert [r.id for r in store.lookup(spec.conformed_table, {"v": None}).collect()] == [2]


def test_part_files_are_sorted_by_key(spark, store):
    spec = spec_for("incremental_with_soft_delete", parts=3)
    load(store, spec, rows_source(spark, [(n * 7919 % 1000, "a", None, at(1), "s") for n in range(1000)]))
    stored = spark.table(store.properties(spec.conformed_table)[VERSION])
    for file in stored.inputFiles():
        ids = [r.id for r in spark.read.parquet(file).collect()]
        assert ids == sorted(ids)


def test_the_newest_batch_is_told_by_its_record(spark, store, monkeypatch):
    assert newest_batch(store, "raw_none.t") is None
    spec = spec_for("incremental_upsert")
    first = load_raw(store, spec, rows_source(spark, [(1, "a", None, at(1), "s")]))
    second = load_raw(store, spec, rows_source(spark, [(2, "b", None, at(2), "s"), (3, "c", None, at(3), "s")]))
    load_raw(store, spec, rows_source(spark, []))  # a batch without rows
    with monkeypatch.context() as patch:
        crashing(patch, RawBatches, "commit")
        with pytest.raises(Crash):
            load_raw(store, spec, rows_source(spark, [(4, "d", None, at(4), "s")]))
    newest = newest_batch(store, spec.raw_table)
    assert {r[BATCH_ID] for r in newest.collect()} == {second.batch_id} != {first.batch_id}
    assert sorted(r.id for r in newest.collect()) == [2, 3]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and f"PartitionFilters: [isnotnull({BATCH_DATE}" in plan
    # Days outside the batch's are not listed.
    old = spark.table(spec.raw_table).withColumn(BATCH_DATE, F.lit("2001-01-01").cast("date"))
    store.append(old, spec.raw_table, partition_by=[BATCH_DATE])
    spark.catalog.refreshTable(spec.raw_table)
    files = newest_batch(store, spec.raw_table).inputFiles()
    assert files and not any("2001-01-01" in f for f in files)


def test_the_newest_batch_without_records(spark, store):
    raw = "raw_other.t"
    for second in (1, 2):
        rows = spark.createDataFrame([(second, at(second))], f"id int, {INGESTED_AT} timestamp")
        store.append(rows, raw)
    assert [r.id for r in newest_batch(store, raw).collect()] == [2]
