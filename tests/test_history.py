"""Versions and batches on hand-made rows and against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import (
    append_versions,
    current_flag,
    latest_batch,
    latest_per_key,
    unprocessed_batches,
    validity,
)

# Forces the path for hot keys: no frame counts as small, a slice holds a few rows.
HOT = {"rows_per_slice": 20, "small_frame_bytes": 0}


def brute_force(rows):
    by_key = defaultdict(list)
    for row in rows:
        by_key[row[0]].append(row)
    expected = []
    for versions in by_key.values():
        versions.sort(key=lambda r: r[1:])
        for row, following in zip(versions, [*versions[1:], None], strict=True):
            expected.append((*row, row[1], following[1] if following else None, 0 if following else 1))
    return sorted(expected, key=repr)


def skewed_rows(seed):
    rng = random.Random(seed)
    keys = [0] * 200 + [None] * 60 + [rng.randrange(1, 40) for _ in range(340)]
    return [(k, rng.randrange(50), n) for n, k in enumerate(keys)]


@pytest.mark.parametrize("skew", [{}, HOT], ids=["window", "slices"])
@pytest.mark.parametrize("seed", [1, 2])
def test_validity_matches_brute_force(spark, skew, seed):
    rows = skewed_rows(seed)
    df = spark.createDataFrame(rows, "k int, at int, tie int").repartition(7)
    got = validity(df, ["k"], ["at", "tie"], **skew)
    assert got.columns == ["k", "at", "tie", "valid_from", "valid_to", "is_current"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force(rows)


@pytest.mark.parametrize("skew", [{}, HOT], ids=["window", "slices"])
def test_one_current_row_per_key(spark, skew):
    rows = skewed_rows(3)
    df = spark.createDataFrame(rows, "k int, at int, tie int")
    flags = current_flag(df, ["k"], ["at", "tie"], **skew)
    assert flags.count() == len(rows)
    per_key = flags.groupBy("k").agg(F.sum("is_current").alias("n")).collect()
    assert {r["n"] for r in per_key} == {1}


def test_hot_key_is_spread_over_slices(spark):
    rows = [(0, n, n) for n in range(400)] + [(k, 0, 0) for k in range(1, 30)]
    df = spark.createDataFrame(rows, "k int, at int, tie int")
    plan = current_flag(df, ["k"], ["at", "tie"], **HOT)._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan and "BroadcastHashJoin" in plan


def test_equal_rows_still_give_one_current_row(spark):
    rows = [(0, 5, 5)] * 60 + [(1, 1, 1)]
    df = spark.createDataFrame(rows, "k int, at int, tie int")
    flags = current_flag(df, ["k"], ["at", "tie"], **HOT)
    assert sorted(r["s"] for r in flags.groupBy("k").agg(F.sum("is_current").alias("s")).collect()) == [1, 1]


def test_rows_equal_in_order_are_cut_apart_by_their_other_columns(spark):
    df = spark.range(300).selectExpr("0 AS k", "5 AS at", "id", "map('a', id) AS m")
    got = validity(df, ["k"], ["at"], **HOT)
    assert got.columns == ["k", "at", "id", "m", "valid_from", "valid_to", "is_current"]
    assert (got.count(), got.filter("is_current = 1 AND valid_to IS NULL").count()) == (300, 1)
    assert got.filter("is_current = 0 AND valid_to = 5").count() == 299


def test_latest_per_key_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"), (2, 1, 1, "d")], "k int, at int, tie int, v string")
    got = latest_per_key(df, ["k"], ["at", "tie"])
    assert sorted((r["k"], r["v"]) for r in got.collect()) == [(1, "b"), (2, "d")]


def test_latest_per_key_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 5)], "k int, at int")
    plan = latest_per_key(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_batches(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 30)], "v int, batch int")
    assert sorted(r["v"] for r in latest_batch(df, "batch").collect()) == [3, 4]
    assert sorted(r["v"] for r in unprocessed_batches(df, F.lit(10), "batch").collect()) == [2, 3, 4]
    assert unprocessed_batches(df, None, "batch").count() == 4
    assert latest_batch(df.filter("v > 9"), "batch").count() == 0


VERSION = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 6)))


def stored(spark, df, tmp_path, name):
    """The frame as Parquet, so that its size is known."""
    path = str(tmp_path / name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def by_null(value):
    return (value is not None, value)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(VERSION, max_size=8), min_size=1, max_size=3))
def test_append_versions_batch_by_batch_equals_at_once(spark, batches):
    def frame(rows):
        return spark.createDataFrame(rows, "k int, at int")

    history = None
    for batch in batches:
        applied = append_versions(history, frame(batch), ["k"], ["at"])
        history = spark.createDataFrame(applied.collect(), applied.schema)
    everything = {row for batch in batches for row in batch}
    newest = {k: max((at for key, at in everything if key == k), key=by_null) for k, _ in everything}
    expected = sorted(((k, at, int(newest[k] == at)) for k, at in everything), key=repr)
    assert sorted(map(tuple, history.collect()), key=repr) == expected

    again = append_versions(history, frame(batches[-1]), ["k"], ["at"])
    assert sorted(map(tuple, again.collect()), key=repr) == expected


def test_append_versions_null_keys_and_watermarks_in_stored_frames(spark, tmp_path):
    history = spark.createDataFrame([(None, 1, 1), (1, 1, 1), (2, None, 1)], "k int, at int, is_current int")
    batch = spark.createDataFrame([(None, 2), (1, 2), (2, None)], "k int, at int")
    got = append_versions(stored(spark, history, tmp_path, "h"), stored(spark, batch, tmp_path, "b"), ["k"], ["at"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(None, 1, 0), (None, 2, 1), (1, 1, 0), (1, 2, 1), (2, None, 1)], key=repr)


def test_append_versions_identity_is_content_without_audit_columns(spark):
    batch = spark.createDataFrame([(1, 5, "x", 2), (1, 5, "x", 1)], "k int, at int, v string, bronze_seen int")
    first = append_versions(None, batch, ["k"], ["at"], prefer=["bronze_seen"])
    assert [(r["bronze_seen"], r["is_current"]) for r in first.collect()] == [(1, 1)]
    corrected = spark.createDataFrame([(1, 5, "y", 3), (1, 5, "x", 3)], "k int, at int, v string, bronze_seen int")
    got = append_versions(spark.createDataFrame(first.collect(), first.schema), corrected, ["k"], ["at"], prefer=["bronze_seen"])
    assert sorted((r["v"], r["bronze_seen"], r["is_current"]) for r in got.collect()) == [("x", 1, 0), ("y", 3, 1)]


def test_append_versions_keeps_intervals(spark):
    first = append_versions(None, spark.createDataFrame([(1, 5), (2, 1)], "k int, at int"), ["k"], ["at"], intervals=True)
    history = spark.createDataFrame(first.collect(), first.schema)
    batch = spark.createDataFrame([(1, 9), (1, 7), (3, 4)], "k int, at int")
    got = append_versions(history, batch, ["k"], ["at"], intervals=True)
    rows = sorted((r["k"], r["valid_from"], r["valid_to"], r["is_current"]) for r in got.collect())
    assert rows == [(1, 5, 7, 0), (1, 7, 9, 0), (1, 9, None, 1), (2, 1, None, 1), (3, 4, None, 1)]
    bare = current_flag(spark.createDataFrame([(4, 1), (4, 2)], "k int, at int"), ["k"], ["at"])
    got = append_versions(bare, batch, ["k"], ["at"], intervals=True).where("k = 4").orderBy("at").collect()
    assert [(r["valid_from"], r["valid_to"], r["is_current"]) for r in got] == [(1, 2, 0), (2, None, 1)]


def test_append_versions_with_a_missing_tie_breaker(spark):
    batch = spark.createDataFrame([(1, 5, None), (1, 5, 1), (2, 7, None)], "k int, at int, tie int")
    history = append_versions(None, batch, ["k"], ["at", "tie"])
    expected = [(1, 5, 1, 1), (1, 5, None, 0), (2, 7, None, 1)]
    assert sorted(map(tuple, history.collect()), key=repr) == expected
    again = append_versions(spark.createDataFrame(history.collect(), history.schema), batch, ["k"], ["at", "tie"])
    assert sorted(map(tuple, again.collect()), key=repr) == expected


def test_append_versions_of_a_hot_key(spark):
    rows = skewed_rows(4)
    old = spark.createDataFrame(rows[::2], "k int, at int, tie int")
    batch = spark.createDataFrame(rows[::3] + rows[1::2], "k int, at int, tie int")
    history = current_flag(old, ["k"], ["at", "tie"])
    got = append_versions(history, batch, ["k"], ["at", "tie"], **HOT)
    want = sorted(((k, at, tie, c) for k, at, tie, _, _, c in brute_force(rows)), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_nested_maps_do_not_stop_hot_keys(spark):
    df = spark.range(200).selectExpr("0 AS k", "5 AS at", "named_struct('m', map('a', id)) AS s", "array(map(1, id)) AS l")
    got = validity(df, ["k"], ["at"], **HOT)
    assert (got.count(), got.filter("is_current = 1").count()) == (200, 1)


def test_keys_out_of_the_batch_are_not_ranked_again(spark, tmp_path):
    history = stored(spark, spark.range(100).selectExpr("id AS k", "id AS at", "repeat('v', 9) AS v", "1 AS is_current"), tmp_path, "h")
    batch = stored(spark, spark.range(3).selectExpr("id AS k", "id + 7 AS at", "'new' AS v"), tmp_path, "b")
    kept = append_versions(history, batch, ["k"], ["at"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    passing = plan[: plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in passing and "LeftAnti" in passing and "Exchange hashpartitioning" not in passing
    assert kept.filter("is_current = 1").count() == 100 and kept.count() == 103
