"""Each merge arm on hand-made rows, in both forms of the join."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import (
    align_to_target,
    change_delete_flag,
    default_delete_flag,
    drop_change_columns,
    merge_changes,
    merge_upsert,
    newest_changes,
    relevant_changes,
    soft_delete_flag,
)
from tidemark.operators import merge as merge_module

TARGET = "k int, v int, extra string, is_deleted int"
CHANGE = "k int, v int, `__$start_lsn` int, `__$seqval` int, `__$operation` int"


@pytest.fixture(params=["full_outer", "lookup"])
def form(request, monkeypatch):
    monkeypatch.setattr(merge_module, "_prefers_lookup", lambda *_: request.param == "lookup")
    return request.param


def changed(df, keys, target):
    newest = newest_changes(relevant_changes(df), keys)
    return align_to_target(drop_change_columns(change_delete_flag(newest)), target.columns)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_arms(spark, form):
    target = spark.createDataFrame([(1, 10, "a", 0), (2, 20, "b", 1)], TARGET)
    source = spark.createDataFrame([(2, 21, 0), (3, 30, 1)], "k int, v int, is_deleted int")
    assert result(merge_upsert(target, source, ["k"])) == [(1, 10, "a", 0), (2, 21, "b", 0), (3, 30, None, 1)]


def test_upsert_takes_nulls_from_the_source(spark, form):
    target = spark.createDataFrame([(1, 10, "a", 0)], TARGET)
    source = spark.createDataFrame([(1, None)], "k int, v int")
    assert result(merge_upsert(target, source, ["k"])) == [(1, None, "a", 0)]


def test_upsert_composite_key_and_odd_names(spark, form):
    target = spark.createDataFrame([(1, 1, 5), (1, 2, 6)], "a int, `b.c` int, `Size $` int")
    source = spark.createDataFrame([(1, 2, 7), (2, 1, 8)], "a int, `b.c` int, `Size $` int")
    assert result(merge_upsert(target, source, ["a", "b.c"])) == [(1, 1, 5), (1, 2, 7), (2, 1, 8)]


def test_upsert_keeps_target_types_and_rejects_new_columns(spark, form):
    target = spark.createDataFrame([(1, 10)], "k int, v int")
    assert merge_upsert(target, spark.createDataFrame([(1, 5)], "k long, v long"), ["k"]).schema["v"].dataType == target.schema["v"].dataType
    with pytest.raises(ValueError, match="more"):
        merge_upsert(target, spark.createDataFrame([(1, 5)], "k int, more int"), ["k"])


@pytest.mark.parametrize(
    ("target_rows", "changes", "expected"),
    [
        pytest.param([(1, 5, "x", 1)], [(1, 6, 1, 1, 2)], [(1, 6, "x", 0)], id="revival"),
        pytest.param([(1, 5, "x", 0)], [(1, 9, 1, 1, 1)], [(1, 5, "x", 1)], id="delete keeps values"),
        pytest.param([], [(1, 9, 1, 1, 1)], [(1, 9, None, 1)], id="unseen delete"),
        pytest.param([], [(1, 7, 1, 1, 2), (1, 8, 2, 1, 1)], [(1, 8, None, 1)], id="insert then delete"),
        pytest.param([(1, 5, "x", 0)], [(1, 5, 1, 1, 3), (1, 6, 1, 1, 4)], [(1, 6, "x", 0)], id="before image"),
        pytest.param([(1, 5, "x", 0)], [(1, 8, 3, 1, 3)], [(1, 5, "x", 0)], id="only a before image"),
        pytest.param([(1, 5, "x", 0)], [(1, 6, 1, 2, 4), (1, 7, 1, 1, 4)], [(1, 6, "x", 0)], id="two sequences"),
        pytest.param([(1, 5, "x", 0), (2, 1, "y", 1)], [], [(1, 5, "x", 0), (2, 1, "y", 1)], id="no changes"),
    ],
)
def test_change_arms(spark, form, target_rows, changes, expected):
    target = spark.createDataFrame(target_rows, TARGET)
    feed = changed(spark.createDataFrame(changes, CHANGE), ["k"], target)
    merged = merge_changes(target, feed, ["k"])
    assert result(merged) == expected
    once = spark.createDataFrame(merged.collect(), merged.schema)
    assert result(merge_changes(once, feed, ["k"])) == expected


def test_extra_change_column_is_dropped_and_missing_one_keeps_the_target(spark, form):
    target = spark.createDataFrame([(1, 5, "x", 0)], TARGET)
    feed = spark.createDataFrame([(1, "new", 1, 1, 4)], "k int, unknown string, `__$start_lsn` int, `__$seqval` int, `__$operation` int")
    assert result(merge_changes(target, changed(feed, ["k"], target), ["k"])) == [(1, 5, "x", 0)]


def test_flags(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, None)], "k int, gone string")
    assert result(soft_delete_flag(df, "gone").drop("gone")) == [(1, 1), (2, 0)]
    assert result(soft_delete_flag(df, None).drop("gone")) == [(1, 0), (2, 0)]
    assert default_delete_flag(df).columns == ["k", "gone", "is_deleted"]
    flagged = soft_delete_flag(df, "gone")
    assert result(default_delete_flag(flagged)) == result(flagged)


def test_small_batch_does_not_shuffle_a_large_target(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2_000_000).selectExpr("id AS k", "rand(1) AS v", "0 AS is_deleted").write.parquet(path)
    target = spark.read.parquet(path)
    rows = spark.createDataFrame([(1, 0.5, 0), (-1, 0.5, 1)], "k long, v double, is_deleted int")
    rows.write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    merged = merge_changes(target, source, ["k"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # The two scans of the target join by broadcast; only the keys found in the batch meet it by shuffle.
    assert plan.count("BroadcastHashJoin") == 2
    assert all("LeftAnti" in line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert merged.count() == 2_000_001
    assert {tuple(r) for r in merged.filter("k in (-1, 1)").select("k", "v").collect()} == {(-1, 0.5), (1, 0.5)}


OPS = st.tuples(st.integers(0, 3), st.integers(0, 9), st.sampled_from([1, 2, 3, 4]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(OPS, max_size=10), st.integers(0, 10))
def test_changes_in_two_steps_equal_one_step_on_live_keys(spark, ops, cut):
    """Deletes keep whatever values the key had, so only flags and live values are independent of the cut."""
    rows = [(k, v, n, 1, op) for n, (k, v, op) in enumerate(ops)]
    target = spark.createDataFrame([(0, 100, "x", 0), (1, 101, "y", 1)], TARGET)

    def apply(to, part):
        merged = merge_changes(to, changed(spark.createDataFrame(part, CHANGE), ["k"], to), ["k"])
        return spark.createDataFrame(merged.collect(), merged.schema)

    def visible(df):
        return {(r["k"], r["is_deleted"], r["v"] if r["is_deleted"] == 0 else None) for r in df.collect()}

    assert visible(apply(apply(target, rows[:cut]), rows[cut:])) == visible(apply(target, rows))
