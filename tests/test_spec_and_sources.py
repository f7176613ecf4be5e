"""Specs, expressions, selects, JDBC reads (against a recording reader) and checks."""

from __future__ import annotations

import random
from datetime import date, datetime
from unittest.mock import MagicMock

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.catalogue import QUERIES
from tidemark.functions import column, lsn_bytes, lsn_hex, person_name, watermark_text
from tidemark.operators import (
    change_log_gaps,
    duplicate_keys,
    orphans,
    position_bounds,
    range_chain,
    select_changes,
    select_columns,
    select_incremental,
)
from tidemark.operators.skew import join_partner
from tidemark.plans.loads import LoadError, check_log_reaches
from tidemark.retail import retail_specs
from tidemark.sizing import at_most, broadcast_limit, fits_broadcast
from tidemark.sources import JdbcSource, ParquetSource, TableStore, jdbc_url, read_parquet, run_sql
from tidemark.sources import tables
from tidemark.sources.tables import merge_into
from tidemark.spec import ChangeFeed, LoadStrategy, SpecError, TableSpec

SF = "/root/testdata/sf0.01"


def spec(**more):
    values = dict(
        table_id="t", source_schema="dbo", source_table="T", raw_table="raw.t", conformed_table="conformed.t",
        primary_key=("id",), strategy="incremental_upsert", columns=("id", "v", "secret"), watermark_column="at",
    )
    return TableSpec(**{**values, **more})


# --- Specs ---


@pytest.mark.parametrize(
    ("wrong", "message"),
    [
        ({"strategy": "sometimes"}, "unsupported load strategy"),
        ({"watermark_column": None}, "watermark_column"),
        ({"strategy": "incremental_cdc"}, "capture_instance"),
        ({"primary_key": ()}, "primary_key"),
        ({"columns": ()}, "columns"),
        ({"lookback_seconds": -1}, "lookback"),
    ],
)
def test_wrong_specs_are_refused(wrong, message):
    with pytest.raises(SpecError, match=message):
        spec(**wrong)


def test_change_feed_is_checked():
    with pytest.raises(SpecError, match="capture_instance"):
        ChangeFeed("")
    with pytest.raises(SpecError, match="row_filter_option"):
        ChangeFeed("x", "some")


def test_retail_tables():
    specs = retail_specs()
    assert [s.table_id for s in specs] == [
        "saleslt_product", "saleslt_salesorderheader", "saleslt_address", "saleslt_customeraddress",
        "saleslt_salesorderdetail_snapshot", "saleslt_salesorderdetail_cdc", "saleslt_customer",
    ]
    detail = specs["saleslt_salesorderdetail_cdc"]
    assert detail.conformed_table == specs["saleslt_salesorderdetail_snapshot"].conformed_table
    assert detail.change_feed.baseline_table == specs["saleslt_salesorderdetail_snapshot"].raw_table
    assert specs["saleslt_customeraddress"].primary_key == ("CustomerID", "AddressID")
    assert retail_specs("demo")["saleslt_address"].raw_table == "demo.bronze.saleslt_address"
    with pytest.raises(SpecError, match="saleslt_customer"):
        specs["nothing"]


def test_spec_from_a_nested_mapping():
    config = {
        "source": {"schema": "S", "table": "T", "query_columns": ["*"]},
        "target": {"bronze_table": "b.t", "silver_table": "s.t"},
        "primary_key": ["a", "b"],
        "load_strategy": "incremental_cdc",
        "watermark_column": None,
        "soft_delete_column": None,
        "cdc": {"capture_instance": "S_T", "row_filter_option": "all"},
    }
    built = TableSpec.from_mapping("t", config)
    assert built.strategy is LoadStrategy.INCREMENTAL_CDC and built.primary_key == ("a", "b")
    assert built.change_feed.capture_instance == "S_T"
    with pytest.raises(SpecError, match="capture_instance"):
        TableSpec.from_mapping("t", {**config, "cdc": {"row_filter_option": "all"}})


# --- Expressions and selects ---


def test_log_positions_keep_text_and_order(spark):
    texts = ["0x0000004F00003A980003", "0x0000004F00003A980002", "0x000000FF00000000FFFF"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", lsn_bytes(F.col("t")).alias("b"))
    assert [r["back"] for r in df.select(lsn_hex(F.col("b")).alias("back")).collect()] == texts
    assert [r["t"] for r in df.orderBy("b").collect()] == sorted(texts)


def test_watermark_text(spark):
    df = spark.range(1).select(
        watermark_text(F.lit(datetime(2024, 1, 2, 3, 4, 5, 678901)).cast("timestamp_ntz")).alias("micro"),
        watermark_text(F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")).alias("whole"),
        watermark_text(F.lit(date(2024, 1, 2))).alias("day"),
        watermark_text(F.lit(None).cast("timestamp")).alias("nothing"),
    )
    assert tuple(df.first()) == ("2024-01-02 03:04:05.678901", "2024-01-02 03:04:05", "2024-01-02", None)


def test_person_name(spark):
    df = spark.createDataFrame([("A", "B", "C"), ("A", None, "C"), (None, "B", "C"), ("A", "B", None)], "f string, m string, l string")
    names = [r["n"] for r in df.select(person_name(F.col("f"), F.col("m"), F.col("l")).alias("n")).collect()]
    assert names == ["A B C", "A C", None, None]


def test_names_with_special_characters(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`__$operation` int, `a.b` int, `x``y` int")
    assert tuple(df.select(*[column(c) for c in df.columns]).first()) == (1, 2, 3)


def test_incremental_select_reaches_the_scan(spark):
    orders = read_parquet(spark, SF, "orders")
    plan = select_columns(select_incremental(orders, "o_orderdate", "1998-01-01 00:00:00"), ["o_orderkey"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate,1998-01-01T00:00)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    lookback = select_incremental(orders, "o_orderdate", "1998-01-01 00:00:00", lookback_seconds=86_400)
    assert "GreaterThan(o_orderdate,1997-12-31T00:00)" in lookback._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(SpecError):
        select_incremental(orders, "o_orderdate", None)
    with pytest.raises(SpecError):
        select_incremental(orders, "", "1998-01-01")


def test_change_range_is_open_below_and_closed_above(spark):
    df = spark.range(10).withColumnRenamed("id", "__$start_lsn")
    got = select_changes(df, F.lit(3), F.lit(6)).collect()
    assert [r[0] for r in got] == [4, 5, 6]


def test_no_query_runs_python_or_collects(spark):
    for name, build in QUERIES.items():
        text = build(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text, name


# --- Checks ---


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "a")], "k int, g string")
    assert [tuple(r) for r in duplicate_keys(df, ["k", "g"]).collect()] == [(1, "a", 2)]
    parent = spark.createDataFrame([(1,), (1,), (None,)], "p int")
    assert sorted(map(tuple, orphans(df, parent, "k", "p").collect()), key=repr) == [(2, "a"), (None, "a")]
    assert tuple(position_bounds(df, "k").first()) == (1, 2)
    gaps = change_log_gaps(df, "k", ["g"], F.lit(0)).first()
    assert (gaps["g"], gaps["min_lsn"], gaps["has_gap"]) == ("a", 1, 1)
    assert change_log_gaps(df, "k", ["g"], F.lit(1)).first()["has_gap"] == 0


def test_parent_keys_are_distinct_before_the_join(spark):
    orders, lines = read_parquet(spark, SF, "orders"), read_parquet(spark, SF, "lineitem")
    text = orphans(orders, lines, "o_orderkey", "l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") == 2


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti", "inner"])
def test_hot_keys_of_a_join_are_kept_apart(spark, how):
    many = spark.range(600).selectExpr("CASE WHEN id % 3 = 0 THEN 0 WHEN id % 3 = 1 THEN id % 40 WHEN id < 300 THEN NULL ELSE 7 END AS k", "id")
    one = spark.range(0, 40, 2).selectExpr("id AS k", "id * 10 AS w").union(spark.createDataFrame([(None, 1)], "k long, w long"))
    settled = spark.createDataFrame(many.collect(), many.schema)
    plain = join_partner(settled, one, ["k"], how, small_frame_bytes=1 << 62)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        apart = join_partner(settled, one, ["k"], how, rows_per_slice=30, small_frame_bytes=0)
        text = apart._jdf.queryExecution().executedPlan().toString()
        assert "Union" in text and "BroadcastHashJoin" in text and "SortMergeJoin" in text
        assert sorted(map(tuple, apart.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_orphans_of_a_hot_parent_key(spark):
    child = spark.range(400).selectExpr("IF(id % 3 = 0, 0, id % 50) AS k", "id")
    parent = spark.range(10, 100).selectExpr("id AS p")
    expected = child.filter("k < 10").count()
    assert orphans(child, parent, "k", "p", rows_per_slice=20, small_frame_bytes=0).count() == expected


@pytest.mark.parametrize("slices", [None, 1, 7])
def test_range_chains(spark, slices):
    rng = random.Random(4)
    rows = [("hot", a, a + rng.randrange(1, 9)) for a in rng.choices(range(2000), k=400)]
    rows += [("b", None, 3), ("b", 3, 5), ("b", 7, 9), ("b", 8, 12), ("b", 8, 12), ("b", 12, None), ("b", 4, 4), (None, 1, 2), (None, 4, 5)]
    expected = []
    for group in {r[0] for r in rows}:
        found = sorted({(-1 if a is None else a, b) for g, a, b in rows if g == group and b is not None and a != b})
        reached = None
        for low, high in found:
            if reached is not None and reached < low:
                expected.append((group, "hole", reached, low))
            elif reached is not None and reached > low:
                expected.append((group, "overlap", low, min(reached, high)))
            reached = high if reached is None else max(reached, high)
    got = range_chain(spark.createDataFrame(rows, "g string, a int, b int"), "a", "b", ["g"], slices)
    assert got.columns == ["g", "kind", "fault_from", "fault_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    none = spark.createDataFrame([], "a int, b int")
    assert range_chain(none, "a", "b", slices=slices).count() == 0


def test_log_retention():
    check_log_reaches(spec(), "0x0A", None)
    check_log_reaches(spec(), "0x0A", "0x0A")
    check_log_reaches(spec(), "0x0A", "0x0B")
    with pytest.raises(LoadError):
        check_log_reaches(spec(), "0x0A", "0x0C")


# --- Sizes ---


def test_size_checks(spark):
    small = read_parquet(spark, SF, "nation")
    assert fits_broadcast(small) and at_most(small, 1 << 20) and not at_most(small, 10)
    assert not fits_broadcast(spark.createDataFrame([(1,)], "a int").union(spark.sparkContext.parallelize([(1,)]).toDF("a int")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, size in {"-1": -1, "10MB": 10 << 20, "5k": 5 << 10, "7b": 7, "3": 3}.items():
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert broadcast_limit(spark) == size
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- Sources ---


def test_jdbc_url():
    assert jdbc_url("h", "db") == (
        "jdbc:sqlserver://h:1433;databaseName=db;encrypt=false;trustServerCertificate=true;"
    )


class Recorder:
    """Stands in for a session's reader: keeps the options and answers queries from frames."""

    def __init__(self, spark, answers=()):
        self.spark, self.answers, self.calls = spark, dict(answers), []

    @property
    def read(self):
        self.calls.append({})
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def option(self, name, value):
        self.calls[-1][name] = value
        return self

    def options(self, **values):
        self.calls[-1].update(values)
        return self

    def jdbc(self, url, table, predicates, properties):
        self.calls[-1].update(properties, url=url, dbtable=table, predicates=predicates)
        return self.load()

    def load(self):
        query = self.calls[-1]["dbtable"]
        for part, frame in self.answers.items():
            if part in query:
                return frame
        return self.spark.createDataFrame([], "id int, v string, secret string")


def jdbc(spark, answers=(), **more):
    recorder = Recorder(spark, answers)
    return JdbcSource(recorder, {"url": "jdbc:x", "user": "u"}, **more), recorder


def test_jdbc_snapshot_and_increment(spark):
    source, recorder = jdbc(spark)
    source.rows(spec(strategy="full_snapshot", exclude_columns=("secret",)))
    assert recorder.calls[-1]["dbtable"] == "(SELECT id, v FROM dbo.T) AS src"
    assert recorder.calls[-1]["user"] == "u" and "numPartitions" not in recorder.calls[-1]
    source.rows(spec(), "2024-01-01 00:00:00.5")
    assert "WHERE at > CAST('2024-01-01 00:00:00.5' AS DATETIME2)" in recorder.calls[-1]["dbtable"]
    source.rows(spec(lookback_seconds=60), "2024-01-01 00:00:00")
    assert "DATEADD(second, -60, CAST('2024-01-01 00:00:00' AS DATETIME2))" in recorder.calls[-1]["dbtable"]
    with pytest.raises(SpecError, match="watermark"):
        source.rows(spec(), None)


def test_jdbc_splits_over_the_rows_it_will_read(spark):
    newest = datetime(2024, 1, 2, 3, 4, 5, 678901)
    bounds = spark.createDataFrame([(100, 900, newest)], "lo int, hi int, newest timestamp_ntz")
    source, recorder = jdbc(spark, {"MIN(id)": bounds}, num_partitions=8)
    source.rows(spec(partition_column="id"), "2024-01-01 00:00:00")
    assert "MAX(at) AS newest" in recorder.calls[0]["dbtable"] and "WHERE at >" in recorder.calls[0]["dbtable"]
    read = recorder.calls[1]
    assert "AND at <= CAST('2024-01-02 03:04:05.678902' AS DATETIME2)" in read["dbtable"]
    assert (read["partitionColumn"], read["lowerBound"], read["upperBound"], read["numPartitions"]) == ("id", "100", "900", "8")
    nothing = spark.createDataFrame([(None, None, None)], "lo int, hi int, newest timestamp_ntz")
    empty, recorder = jdbc(spark, {"MIN(id)": nothing}, num_partitions=8)
    empty.rows(spec(partition_column="id"), "2024-01-01 00:00:00")
    assert "numPartitions" not in recorder.calls[-1] and "<=" not in recorder.calls[-1]["dbtable"]
    source, recorder = jdbc(spark, {"MIN(id)": bounds}, num_partitions=8)
    source.rows(spec(strategy="full_snapshot", partition_column="id"))
    assert recorder.calls[-1]["dbtable"] == "(SELECT id, v, secret FROM dbo.T) AS src"


def test_jdbc_splits_a_change_range(spark):
    source, recorder = jdbc(spark, {"MIN(id)": spark.createDataFrame([(1, 5)], "lo int, hi int")}, num_partitions=4)
    feed = {"capture_instance": "dbo_T", "partition_column": "id"}
    changed = spec(strategy="incremental_cdc", change_feed=ChangeFeed(**feed))
    source.changes(changed, f"0x{1:020X}", f"0x{2:020X}")
    bounds, read = recorder.calls
    assert bounds["dbtable"].startswith("(SELECT MIN(id) AS lo, MAX(id) AS hi FROM cdc.dbo_T_CT WHERE")
    assert read["dbtable"].startswith("(SELECT __$start_lsn, ") and "secret" in read["dbtable"] and read["numPartitions"] == "4"


@pytest.mark.parametrize("shape", ["crowded", "even", "repeated", "single", "none"])
def test_jdbc_splits_by_quantiles(spark, shape):
    """The statements are run by DuckDB over skewed keys: every row lies in one range, and no range is large."""
    keys = {
        "crowded": [*range(9000), *range(10_000, 1_010_000, 1000)], "even": list(range(5000)),
        "repeated": [5] * 4000 + list(range(1000)), "single": [7] * 10, "none": [],
    }[shape]
    duck = duckdb.connect()
    duck.register("t_rows", pa.table({"id": pa.array(keys + [None] * bool(keys), pa.int64())}))
    source, recorder = jdbc(spark, num_partitions=8, by_quantiles=True)
    tiles = duck.sql(source.quantiles_text("SELECT id FROM t_rows", "id")).fetchall()
    ends = (min(keys, default=None), max(keys, default=None), None)
    recorder.answers = {
        "MIN(id) AS lo, MAX(id)": spark.createDataFrame([ends], "lo long, hi long, newest timestamp_ntz"),
        "NTILE(8)": spark.createDataFrame(tiles, "tile long, lo long, n long"),
    }
    source.rows(spec(strategy="full_snapshot", partition_column="id"))
    read = recorder.calls[-1]
    assert read["dbtable"] == "(SELECT id, v, secret FROM dbo.T) AS src" and read["user"] == "u"
    if shape in ("single", "none"):
        assert "predicates" not in read
        return
    sizes = [duck.sql(f"SELECT count(*) FROM t_rows WHERE {p}").fetchall()[0][0] for p in read["predicates"]]
    assert sum(sizes) == len(keys) + 1
    if shape != "repeated":
        assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / 8
    assert "NTILE(8) OVER (ORDER BY id)" in recorder.calls[-2]["dbtable"]


def test_jdbc_splits_a_change_range_by_quantiles(spark):
    tiles = spark.createDataFrame([(1, "a", 5), (2, "it's", 5), (3, "x", 5)], "tile long, lo string, n long")
    source, recorder = jdbc(spark, {"NTILE": tiles}, num_partitions=3, by_quantiles=True)
    changed = spec(strategy="incremental_cdc", change_feed=ChangeFeed("dbo_T", partition_column="id"))
    source.changes(changed, f"0x{1:020X}", f"0x{2:020X}")
    assert "FROM cdc.dbo_T_CT WHERE" in recorder.calls[0]["dbtable"]
    assert recorder.calls[1]["predicates"] == [
        "id < 'it''s' OR id IS NULL", "id >= 'it''s' AND id < 'x'", "id >= 'x'"]


def test_jdbc_change_feed(spark):
    lsn = spark.createDataFrame([("0x0000004F00003A980003",)], "lsn string")
    source, recorder = jdbc(spark, {"fn_cdc": lsn})
    feed = ChangeFeed("dbo_T")
    assert source.max_position("dbo_T") == "0x0000004F00003A980003" == source.min_position("dbo_T")
    low, high = f"0x{1:020X}", f"0x{2:020X}"
    changed = spec(strategy="incremental_cdc", change_feed=feed, exclude_columns=("secret",))
    source.changes(changed, low, high)
    assert recorder.calls[-1]["dbtable"] == (
        f"(SELECT __$start_lsn, __$seqval, __$operation, __$update_mask, id, v FROM cdc.dbo_T_CT WHERE __$start_lsn <= {high} AND __$start_lsn > {low} AND __$operation <> 3) AS src"
    )
    assert "<> 3" not in source.changes_text(ChangeFeed("dbo_T", "all update old"), None, high)
    with pytest.raises(SpecError, match="log position"):
        source.changes_text(feed, "0x1 OR 1=1", high)
    with pytest.raises(SpecError, match="capture instance"):
        source.changes_text(ChangeFeed("x; DROP"), low, high)


def test_jdbc_probe_and_sample(spark):
    source, recorder = jdbc(spark, {"AS reachable": spark.createDataFrame([(1,)], "reachable int")})
    assert source.probe()
    source.sample("dbo", "T", ["id", "v"], "id")
    assert recorder.calls[-1]["dbtable"] == (
        "(SELECT id, v FROM dbo.T ORDER BY id OFFSET 0 ROWS FETCH NEXT 5 ROWS ONLY) AS src"
    )
    nothing, _ = jdbc(spark)
    assert nothing.scalar("SELECT 1", "id") is None


def test_parquet_source(spark):
    source = ParquetSource(spark=spark, directory=SF)
    nations = source.rows(spec(strategy="full_snapshot", source_table="nation", columns=("*",), exclude_columns=("n_name",)))
    assert nations.columns == ["n_nationkey", "n_regionkey"] and nations.count() == 25


# --- Table store ---


def test_store_basics(spark):
    store = TableStore(spark)
    df = spark.createDataFrame([(1, "it's")], "a int, b string")
    assert store.read_if_exists("basics.t") is None
    store.append(df, "basics.t")
    store.append(df.select("b", "a"), "basics.t")
    assert [tuple(r) for r in store.read("basics.t").collect()] == [(1, "it's")] * 2
    store.set_property("basics.t", "tidemark.x", "it's")
    assert store.properties("basics.t") == {"tidemark.x": "it's"}
    store.replace(df, "basics.r", {"tidemark.y": "1"})
    store.replace(store.read("basics.r").union(df), "basics.r")
    assert store.read("basics.r").count() == 2 and store.properties("basics.r") == {}
    store.merge(spark.createDataFrame([(2, "new")], "a int, b string"), "basics.r", ["a"], properties={"tidemark.z": "2"})
    assert store.read("basics.r").count() == 3 and store.properties("basics.r") == {"tidemark.z": "2"}
    assert run_sql(spark, "SELECT count(*) AS n FROM basics.r;\n").first()["n"] == 3


@pytest.mark.parametrize("changes", [False, True])
def test_merge_into_resolves_against_the_target(spark, changes):
    """Without a row-level catalog MERGE is refused, but only after every column of it has been resolved."""
    store = TableStore(spark)
    df = spark.createDataFrame([(1, "x", 0)], "a int, b string, is_deleted int")
    if not store.exists("merging.t"):
        store.append(df, "merging.t")
    with pytest.raises(Exception, match="(?i)merge") as refused:
        merge_into(df, "merging.t", ["a"], changes)
    assert "UNRESOLVED" not in str(refused.value)


def test_clock_going_back_never_drops_the_current_version(spark, monkeypatch):
    store = TableStore(spark, keep_versions=0)
    df = spark.createDataFrame([(1,)], "a int")
    store.replace(df, "clock.t")

    class Earlier(datetime):
        @classmethod
        def now(cls, tz=None):
            return datetime(2000, 1, 1, tzinfo=tz)

    monkeypatch.setattr(tables, "datetime", Earlier)
    store.replace(df.union(df), "clock.t")
    assert store.read("clock.t").count() == 2
    assert len(spark.sql("SHOW TABLES IN clock").collect()) == 2


def test_v2_catalog_tables_are_written_in_place():
    """Against a recording session: which writer calls a v2 catalog gets."""
    spark, df = MagicMock(), MagicMock()
    spark.conf.get.side_effect = lambda key, default=None: "X" if key == "spark.sql.catalog.demo" else default
    store = TableStore(spark)
    assert store.in_v2_catalog("demo.silver.t") and not store.in_v2_catalog("silver.t")
    assert not store.in_v2_catalog("other.silver.t")
    store.replace(df, "demo.silver.t", {"tidemark.applied": "1"})
    df.writeTo.return_value.tableProperty.assert_called_once_with("tidemark.applied", "1")
    df.writeTo.return_value.tableProperty.return_value.createOrReplace.assert_called_once_with()
    spark.catalog.tableExists.return_value = True
    store.append(df, "demo.silver.t", partition_by=["day"])
    df.writeTo.return_value.append.assert_called_once_with()
    spark.catalog.tableExists.return_value = False
    store.append(df, "demo.silver.t", partition_by=["day"])
    df.writeTo.return_value.partitionedBy.return_value.create.assert_called_once_with()
    assert store.latest_partition("demo.silver.t", "day") is None
    assert "CREATE NAMESPACE IF NOT EXISTS `demo`.`silver`" in str(spark.sql.call_args_list)


def test_merge_into_compares_log_positions(spark):
    """As above, with the position column on both sides."""
    store = TableStore(spark)
    df = spark.createDataFrame(
        [(1, 0, (bytearray(b"a"), bytearray(b"a"), 4), "0x0A")],
        "a int, is_deleted int, cdc_position struct<start_lsn: binary, seqval: binary, operation: int>, bronze_cdc_to_lsn string")
    if not store.exists("merging.positions"):
        store.append(df, "merging.positions")
    with pytest.raises(Exception, match="(?i)merge") as refused:
        merge_into(df, "merging.positions", ["a"], True, (), df.columns)
    assert "UNRESOLVED" not in str(refused.value) and "AMBIGUOUS" not in str(refused.value)
