"""Every operator as a query over the test tables, next to the SQL that must give the same rows.

The tables stand in for the retail schema: orders = order header, lineitem = order detail, part = product,
nation with region = address, events and orders = change feeds. Each query reads its tables whole; where a query
needs an old and a new state, one table is cut at a date or, for parts, by size, and both sides are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import case_of, lsn_bytes, lsn_hex, watermark_text
from .operators import (
    align_to_target,
    append_versions,
    change_delete_flag,
    change_log_gaps,
    current_flag,
    default_delete_flag,
    drop_change_columns,
    duplicate_keys,
    latest_batch,
    latest_per_key,
    merge_changes,
    merge_upsert,
    newest_changes,
    orphans,
    position_bounds,
    range_chain,
    relevant_changes,
    select_changes,
    select_columns,
    select_incremental,
    soft_delete_flag,
    unprocessed_batches,
    validity,
    with_audit_columns,
)
from .operators.merge import CDC_POSITION
from .operators.ingest import INGESTED_AT, OPERATION, SEQVAL, START_LSN, UPDATE_MASK
from .plans.loads import conform
from .plans.marts import MAIN_OFFICE, SHIPPING, dim_customer, dim_product, fact_sales
from .sources.parquet import read_parquet
from .spec import ChangeFeed, LoadStrategy, TableSpec

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query with its oracle; ``name`` where the function's own is taken by an operator."""

    def register(build: Query) -> Query:
        QUERIES[name or build.__name__] = build
        ORACLE[name or build.__name__] = sql
        return build

    return register


def timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# The test tables' columns.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_parquet(spark, sf, name, SCHEMAS[name])


# --- Stand-in inputs -------------------------------------------------------------------------------------------

EVENT_OPERATIONS = {"error": "1", "signup": "2", "view": "3"}
ORDER_OPERATIONS = {"1-URGENT": "1", "2-HIGH": "2", "3-MEDIUM": "3"}
OTHER_OPERATION = "4"


def event_changes(spark: SparkSession, sf: str) -> DataFrame:
    operation = case_of(F.col("event_type"), EVENT_OPERATIONS, OTHER_OPERATION).cast("int")
    return table(spark, sf, "events").select(
        "user_id",
        F.col("ts").alias("start_lsn"),
        F.col("event_id").alias("seqval"),
        operation.alias("operation"),
        "value",
    )


EVENT_CHANGES = """
    SELECT user_id, ts AS start_lsn, event_id AS seqval,
           CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 WHEN 'view' THEN 3 ELSE 4 END AS operation,
           value
    FROM events"""


def event_range(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")

    def first_at(day: str) -> Column:
        return events.filter(F.col("ts") >= timestamp(day)).agg(F.min("ts").alias("first")).scalar()

    return select_changes(event_changes(spark, sf), first_at("2024-01-11"), first_at("2024-01-21"), "start_lsn")


EVENT_RANGE = f"""
    SELECT * FROM ({EVENT_CHANGES}) c
    WHERE start_lsn > (SELECT MIN(ts) FROM events WHERE ts >= CAST('2024-01-11' AS TIMESTAMP))
      AND start_lsn <= (SELECT MIN(ts) FROM events WHERE ts >= CAST('2024-01-21' AS TIMESTAMP))"""


def addresses(spark: SparkSession, sf: str) -> DataFrame:
    """One address per nation."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    named = F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("AddressID"),
        named.alias("AddressLine1"),
        F.col("r_name").alias("AddressLine2"),
        F.col("n_name").alias("City"),
        F.concat(F.col("n_name"), F.lit(" province")).alias("StateProvince"),
        F.col("r_name").alias("CountryRegion"),
        F.col("n_nationkey").cast("string").alias("PostalCode"),
    )


ADDRESSES = """
    SELECT CAST(n_nationkey AS BIGINT) AS AddressID, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS AddressLine1,
           r_name AS AddressLine2, n_name AS City, n_name || ' province' AS StateProvince, r_name AS CountryRegion,
           CAST(n_nationkey AS VARCHAR) AS PostalCode
    FROM nation JOIN region ON n_regionkey = r_regionkey"""


# --- Scans and selects -----------------------------------------------------------------------------------------


@query("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(0 AS INT) AS is_deleted FROM customer""")
def full_snapshot_select(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return default_delete_flag(select_columns(table(spark, sf, "customer"), columns))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders WHERE o_orderdate > CAST('1998-01-01 00:00:00' AS TIMESTAMP)""")
def incremental_watermark_select(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    orders = table(spark, sf, "orders")
    return select_columns(select_incremental(orders, "o_orderdate", "1998-01-01 00:00:00"), columns)


@query("""
SELECT CAST(MAX(o_orderdate) AS VARCHAR) AS max_watermark FROM orders""")
def watermark_max(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.agg(watermark_text(F.max("o_orderdate")).alias("max_watermark"))


@query(EVENT_RANGE)
def cdc_range_select(spark: SparkSession, sf: str) -> DataFrame:
    return event_range(spark, sf)


@query("""
SELECT MIN(ts) AS min_lsn, MAX(ts) AS max_lsn FROM events""")
def cdc_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return position_bounds(table(spark, sf, "events"), "ts")


@query("""
SELECT * FROM part WHERE p_partkey = 680""")
def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").filter(F.col("p_partkey") == 680)


@query("""
SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 5""")
def topn_sample(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", "p_name").orderBy("p_partkey").limit(5)


@query("""
SELECT COUNT(*) AS n FROM lineitem""")
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id, '0x' || lpad(upper(to_hex(event_id)), 20, '0') AS lsn FROM events""")
def lsn_hex_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("0x"), F.lpad(F.hex("event_id"), 20, "0"))
    return table(spark, sf, "events").select("event_id", lsn_hex(lsn_bytes(text)).alias("lsn"))


@query("""
SELECT c_custkey, 'tpch_customer' AS bronze_table_id, 'parquet' AS bronze_source_system,
       'tpch' AS bronze_source_schema, 'customer' AS bronze_source_table,
       'full_snapshot' AS bronze_load_strategy, '' AS bronze_watermark_column, '' AS bronze_watermark_used,
       '' AS bronze_soft_delete_column, '' AS bronze_cdc_from_lsn, '' AS bronze_cdc_to_lsn
FROM customer""")
def bronze_metadata(spark: SparkSession, sf: str) -> DataFrame:
    spec = TableSpec(
        table_id="tpch_customer",
        source_schema="tpch",
        source_table="customer",
        raw_table="bronze.customer",
        conformed_table="silver.customer",
        primary_key=("c_custkey",),
        strategy=LoadStrategy.FULL_SNAPSHOT,
    )
    customers = table(spark, sf, "customer").select("c_custkey")
    # Ingestion time and batch id differ from run to run, so they are left out of the comparison.
    stamped = with_audit_columns(customers, spec, source_system="parquet")
    return stamped.drop("bronze_ingestion_timestamp", "bronze_batch_id")


# --- Batches ---------------------------------------------------------------------------------------------------


def event_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the day as batch; ``date_trunc`` gives a zoned timestamp, hence the cast back."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return table(spark, sf, "events").withColumn("batch_ts", day)


@query("""
SELECT event_id, ts, user_id FROM events
WHERE date_trunc('day', ts) = (SELECT MAX(date_trunc('day', ts)) FROM events)""")
def latest_batch_filter(spark: SparkSession, sf: str) -> DataFrame:
    return latest_batch(event_batches(spark, sf), "batch_ts").select("event_id", "ts", "user_id")


@query("""
SELECT event_id, user_id, date_trunc('day', ts) AS batch_ts FROM events
WHERE date_trunc('day', ts) > CAST('2024-01-27' AS TIMESTAMP)""", name="unprocessed_batches")
def unprocessed_batches_select(spark: SparkSession, sf: str) -> DataFrame:
    applied = timestamp("2024-01-27")
    pending = unprocessed_batches(event_batches(spark, sf), applied, "batch_ts")
    # An event is never earlier than its batch, and this form of the bound reaches the scan.
    return pending.filter(F.col("ts") > applied).select("event_id", "user_id", "batch_ts")


@query("""
WITH o AS (
    SELECT *, o_orderdate > CAST('1998-01-01' AS TIMESTAMP) AS pending,
           ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate > CAST('1998-01-01' AS TIMESTAMP)
                              ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders)
SELECT o_custkey, COALESCE(MAX(CASE WHEN pending THEN o_orderkey END), MAX(o_orderkey)) AS last_order,
       COALESCE(MAX(CASE WHEN pending THEN o_totalprice END), MAX(o_totalprice)) AS last_total,
       COALESCE(MAX(CASE WHEN pending THEN o_orderdate END), MAX(o_orderdate)) AS last_date
FROM o WHERE rn = 1 GROUP BY o_custkey""")
def merge_pending_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The batches after a date, merged into the table made of those before."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("last_order"), F.col("o_totalprice").alias("last_total"),
        F.col("o_orderdate").alias("last_date"),
    )
    keys, order, applied = ["o_custkey"], ["last_date", "last_order"], timestamp("1998-01-01")
    target = latest_per_key(orders.filter(F.col("last_date") <= applied), keys, order)
    pending = unprocessed_batches(orders, applied, "last_date")
    return merge_upsert(target, latest_per_key(pending, keys, order), keys, newer_by=order)


# --- Change feed -----------------------------------------------------------------------------------------------

RELEVANT = f"SELECT * FROM ({EVENT_CHANGES}) r WHERE operation IN (1, 2, 4)"


@query(RELEVANT)
def cdc_relevant_ops(spark: SparkSession, sf: str) -> DataFrame:
    return relevant_changes(event_changes(spark, sf), "operation")


@query(f"""
SELECT user_id, start_lsn, seqval, operation, value, CASE WHEN operation = 1 THEN 1 ELSE 0 END AS is_deleted
FROM (SELECT f.*, ROW_NUMBER() OVER (PARTITION BY user_id
                                     ORDER BY start_lsn DESC, seqval DESC, operation DESC) AS rn
      FROM ({RELEVANT}) f) z
WHERE rn = 1""")
def cdc_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    relevant = relevant_changes(event_changes(spark, sf), "operation")
    newest = newest_changes(relevant, ["user_id"], ("start_lsn", "seqval", "operation"))
    return change_delete_flag(newest, "operation")


BASELINE_DAY = "1996-10-01"


def order_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as the change feed of one row per customer, with the feed's own column names."""
    operation = case_of(F.col("o_orderpriority"), ORDER_OPERATIONS, OTHER_OPERATION).cast("int")
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").alias(START_LSN),
        F.col("o_orderkey").alias(SEQVAL),
        operation.alias(OPERATION),
        F.lit(None).cast("binary").alias(UPDATE_MASK),
        "o_custkey",
        F.col("o_totalprice").alias("value"),
        F.col("o_orderstatus").alias("status"),
    )


@query(f"""
WITH ch AS (
    SELECT o_custkey, o_orderdate AS lsn, o_orderkey AS seq, o_totalprice AS value, o_orderstatus AS status,
           CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END AS op
    FROM orders),
t AS (
    SELECT o_custkey, value, status, 0 AS is_deleted
    FROM (SELECT ch.*, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY lsn DESC, seq DESC) AS rn
          FROM ch WHERE lsn <= CAST('{BASELINE_DAY}' AS TIMESTAMP)) b
    WHERE rn = 1),
s AS (
    SELECT o_custkey, value, status, CASE WHEN op = 1 THEN 1 ELSE 0 END AS is_deleted
    FROM (SELECT ch.*, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY lsn DESC, seq DESC, op DESC) AS rn
          FROM ch WHERE lsn > CAST('{BASELINE_DAY}' AS TIMESTAMP) AND op IN (1, 2, 4)) c
    WHERE rn = 1)
SELECT COALESCE(t.o_custkey, s.o_custkey) AS o_custkey,
       CASE WHEN s.o_custkey IS NULL OR (t.o_custkey IS NOT NULL AND s.is_deleted = 1)
            THEN t.value ELSE s.value END AS value,
       CASE WHEN s.o_custkey IS NULL OR (t.o_custkey IS NOT NULL AND s.is_deleted = 1)
            THEN t.status ELSE s.status END AS status,
       CASE WHEN s.o_custkey IS NULL THEN t.is_deleted ELSE s.is_deleted END AS is_deleted
FROM t FULL OUTER JOIN s ON t.o_custkey = s.o_custkey""")
def cdc_merge(spark: SparkSession, sf: str) -> DataFrame:
    feed, baseline, keys = order_changes(spark, sf), timestamp(BASELINE_DAY), ["o_custkey"]
    position = F.col(f"`{START_LSN}`")
    before = latest_per_key(feed.filter(position <= baseline), keys, [START_LSN, SEQVAL])
    target = default_delete_flag(before.select("o_custkey", "value", "status"))
    newest = newest_changes(relevant_changes(feed.filter(position > baseline)), keys)
    source = align_to_target(drop_change_columns(change_delete_flag(newest)), target.columns)
    return merge_changes(target, source, keys)


@query("""
SELECT event_type AS capture_instance, MIN(ts) AS min_lsn,
       CASE WHEN MIN(ts) > CAST('2024-01-01 00:10:00' AS TIMESTAMP) THEN 1 ELSE 0 END AS has_gap
FROM events GROUP BY event_type""")
def cdc_gap_check(spark: SparkSession, sf: str) -> DataFrame:
    feed = table(spark, sf, "events").withColumnRenamed("event_type", "capture_instance")
    return change_log_gaps(feed, "ts", ["capture_instance"], timestamp("2024-01-01 00:10:00"))


@query("""
WITH r AS (
    SELECT DISTINCT l_suppkey, o_orderdate AS lo, l_shipdate AS hi
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate),
c AS (
    SELECT *, MAX(hi) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
    FROM r)
SELECT l_suppkey, CASE WHEN reached < lo THEN 'hole' ELSE 'overlap' END AS kind,
       CASE WHEN reached < lo THEN reached ELSE lo END AS fault_from,
       CASE WHEN reached < lo THEN lo ELSE LEAST(reached, hi) END AS fault_to
FROM c WHERE reached <> lo""")
def log_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """The spans from order to shipment as applied ranges of a log, one chain per supplier."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    ranges = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return range_chain(ranges, "o_orderdate", "l_shipdate", ["l_suppkey"])


@query("""
SELECT user_id, value FROM events""")
def align_to_target_columns(spark: SparkSession, sf: str) -> DataFrame:
    feed = event_changes(spark, sf).withColumnsRenamed(
        {"start_lsn": START_LSN, "seqval": SEQVAL, "operation": OPERATION}
    )
    return align_to_target(drop_change_columns(feed), ["user_id", "value", "is_deleted"])


# --- Soft deletes and upserts ----------------------------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, discontinued_at,
       CASE WHEN discontinued_at IS NOT NULL THEN 1 ELSE 0 END AS is_deleted
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS discontinued_at
      FROM lineitem) x""", name="soft_delete_flag")
def soft_delete_flag_rows(spark: SparkSession, sf: str) -> DataFrame:
    returned_at = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("discontinued_at")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", returned_at)
    return soft_delete_flag(lines, "discontinued_at")


@query("""
SELECT COALESCE(t.p_partkey, s.p_partkey) AS p_partkey,
       CASE WHEN s.p_partkey IS NOT NULL THEN s.price ELSE t.price END AS price,
       CASE WHEN s.p_partkey IS NOT NULL THEN s.is_deleted ELSE t.is_deleted END AS is_deleted
FROM (SELECT p_partkey, CAST(0 AS DOUBLE) AS price, 0 AS is_deleted FROM part WHERE p_size <= 40) t
FULL OUTER JOIN (SELECT p_partkey, p_retailprice AS price, CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS is_deleted
                 FROM part WHERE p_size > 10) s ON t.p_partkey = s.p_partkey""")
def soft_delete_merge(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    target = default_delete_flag(
        part.filter(F.col("p_size") <= 40).select("p_partkey", F.lit(0.0).alias("price"))
    )
    discontinued = F.when(F.col("p_type") == "ECONOMY", F.col("p_type")).alias("discontinued")
    batch = part.filter(F.col("p_size") > 10).select("p_partkey", F.col("p_retailprice").alias("price"), discontinued)
    return merge_upsert(target, soft_delete_flag(batch, "discontinued").drop("discontinued"), ["p_partkey"])


@query("""
WITH r AS (
    SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate > CAST('1998-01-01' AS TIMESTAMP) AS fresh,
           ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate > CAST('1998-01-01' AS TIMESTAMP)
                              ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders),
t AS (SELECT * FROM r WHERE rn = 1 AND NOT fresh),
s AS (SELECT * FROM r WHERE rn = 1 AND fresh)
SELECT COALESCE(t.o_custkey, s.o_custkey) AS o_custkey,
       CASE WHEN s.o_custkey IS NOT NULL THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
       CASE WHEN s.o_custkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM t FULL OUTER JOIN s ON t.o_custkey = s.o_custkey""", name="merge_upsert")
def merge_upsert_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    keys, order, day = ["o_custkey"], ["o_orderdate", "o_orderkey"], "1998-01-01"
    target = latest_per_key(orders.filter(F.col("o_orderdate") <= timestamp(day)), keys, order).drop("o_orderdate")
    source = latest_per_key(select_incremental(orders, "o_orderdate", day), keys, order).drop("o_orderdate")
    return merge_upsert(target, source, keys)


# --- Versions --------------------------------------------------------------------------------------------------


@query("""
SELECT o_custkey, o_orderkey, o_orderdate,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
            THEN 1 ELSE 0 END AS is_current
FROM orders""")
def scd_current_flag(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return current_flag(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("""
SELECT o_custkey, o_orderkey, o_orderdate AS valid_from,
       LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to,
       CASE WHEN LEAD(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL
            THEN 1 ELSE 0 END AS is_current
FROM orders""")
def scd2_validity(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return validity(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""
WITH h AS (
    SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= CAST('1998-01-01' AS TIMESTAMP)
    UNION
    SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_orderdate > CAST('1997-06-01' AS TIMESTAMP))
SELECT o_custkey, o_orderkey,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
            THEN 1 ELSE 0 END AS is_current
FROM h""")
def append_versions_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    keys, order = ["o_custkey"], ["o_orderdate", "o_orderkey"]
    history = current_flag(orders.filter(F.col("o_orderdate") <= timestamp("1998-01-01")), keys, order)
    batch = select_incremental(orders, "o_orderdate", "1997-06-01")
    return append_versions(history, batch, keys, order).drop("o_orderdate")


# --- Conformed loads -------------------------------------------------------------------------------------------


def order_spec(strategy: LoadStrategy, **more) -> TableSpec:
    return TableSpec(
        table_id="orders_by_customer", source_schema="tpch", source_table="orders", raw_table="bronze.orders",
        conformed_table="silver.orders", primary_key=("o_custkey",), strategy=strategy,
        watermark_column="o_orderdate", initial_watermark="1990-01-01 00:00:00", tie_breakers=("o_orderkey",), **more,
    )


def order_batches(spark: SparkSession, sf: str, *days: str) -> list[DataFrame]:
    """Raw rows of orders, cut into batches at the days."""
    rows = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice",
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias("closed"),
    )
    bounds = [None, *map(timestamp, days), None]
    out = []
    for number, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = rows if low is None else rows.filter(F.col("o_orderdate") > low)
        part = part if high is None else part.filter(F.col("o_orderdate") <= high)
        out.append(part.withColumn(INGESTED_AT, F.timestamp_seconds(F.lit(number))))
    return out


CONFORM_DAYS = ("1995-01-01", "1997-06-01")


@query("""
SELECT o_custkey, o_orderkey, o_orderdate AS valid_from,
       LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to,
       CASE WHEN LEAD(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL
            THEN 1 ELSE 0 END AS is_current
FROM orders""")
def conform_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches of versions, one after the other."""
    spec, conformed = order_spec(LoadStrategy.INCREMENTAL_UPSERT), None
    for batch in order_batches(spark, sf, *CONFORM_DAYS):
        conformed = conform(spec, batch, conformed)
    return conformed.select("o_custkey", "o_orderkey", "valid_from", "valid_to", "is_current")


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_deleted
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) o
WHERE rn = 1""")
def conform_soft_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches merged by key; a closed order counts as deleted."""
    spec, conformed = order_spec(LoadStrategy.INCREMENTAL_SOFT_DELETE, soft_delete_column="closed"), None
    for batch in order_batches(spark, sf, *CONFORM_DAYS):
        conformed = conform(spec, batch, conformed)
    return conformed.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "is_deleted")


ORDERS_CDC = TableSpec(
    table_id="orders_cdc", source_schema="tpch", source_table="orders", raw_table="bronze.orders_cdc",
    conformed_table="silver.orders", primary_key=("o_custkey",), strategy=LoadStrategy.INCREMENTAL_CDC,
    change_feed=ChangeFeed("orders", baseline_table="bronze.orders"),
)


@query(ORACLE["cdc_merge"])
def conform_cdc(spark: SparkSession, sf: str) -> DataFrame:
    """The change merge of ``cdc_merge`` through the conformed load."""
    feed, baseline = order_changes(spark, sf), timestamp(BASELINE_DAY)
    position = F.col(f"`{START_LSN}`")
    before = latest_per_key(feed.filter(position <= baseline), ["o_custkey"], [START_LSN, SEQVAL])
    target = default_delete_flag(before.select("o_custkey", "value", "status"))
    return conform(ORDERS_CDC, feed.filter(position > baseline), target).select(*target.columns)


@query(f"""
WITH ch AS (
    SELECT o_custkey, o_orderdate AS lsn, o_orderkey AS seq, o_totalprice AS value, o_orderstatus AS status,
           CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END AS op
    FROM orders),
b AS (SELECT DISTINCT o_custkey FROM ch WHERE lsn <= CAST('{BASELINE_DAY}' AS TIMESTAMP)),
a AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY lsn DESC, seq DESC, op DESC) AS rn
      FROM ch WHERE lsn > CAST('{BASELINE_DAY}' AS TIMESTAMP) AND op IN (1, 2, 4)),
s AS (SELECT * FROM a WHERE rn = 1)
SELECT COALESCE(b.o_custkey, s.o_custkey) AS o_custkey, CASE WHEN s.op = 1 THEN 1 ELSE 0 END AS is_deleted,
       s.lsn AS position_lsn, s.seq AS position_seq, s.op AS position_operation
FROM b FULL OUTER JOIN s ON b.o_custkey = s.o_custkey""")
def conform_late_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Change batches applied out of order, the oldest last: every key ends at its newest change."""
    feed, baseline = order_changes(spark, sf), timestamp(BASELINE_DAY)
    position = F.col(f"`{START_LSN}`")
    before = latest_per_key(feed.filter(position <= baseline), ["o_custkey"], [START_LSN, SEQVAL])
    conformed = default_delete_flag(before.select("o_custkey", "value", "status"))
    late, on_time = timestamp("1997-06-01"), timestamp("1998-01-01")
    for batch in (
        feed.filter(position > on_time),
        feed.filter((position > late) & (position <= on_time)),
        feed.filter((position > baseline) & (position <= late)),
    ):
        conformed = conform(ORDERS_CDC, batch, conformed)
    held = F.col(CDC_POSITION)
    return conformed.select(
        "o_custkey", "is_deleted", held["start_lsn"].alias("position_lsn"), held["seqval"].alias("position_seq"),
        held["operation"].alias("position_operation"))


# --- Marts -----------------------------------------------------------------------------------------------------


@query("""
SELECT p_partkey AS ProductID, p_name AS Name, p_brand AS ProductNumber, p_type AS Color,
       p_retailprice AS StandardCost, p_retailprice AS ListPrice, p_size AS Size, p_size AS Weight,
       CAST('1995-01-01' AS TIMESTAMP) AS SellStartDate, CAST(NULL AS TIMESTAMP) AS SellEndDate,
       CASE WHEN p_type = 'ECONOMY' THEN CAST('2001-01-01' AS TIMESTAMP) END AS DiscontinuedDate,
       CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS is_deleted
FROM part""", name="dim_product")
def dim_product_mart(spark: SparkSession, sf: str) -> DataFrame:
    product = table(spark, sf, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("Name"),
        F.col("p_brand").alias("ProductNumber"),
        F.col("p_type").alias("Color"),
        F.col("p_retailprice").alias("StandardCost"),
        F.col("p_retailprice").alias("ListPrice"),
        F.col("p_size").alias("Size"),
        F.col("p_size").alias("Weight"),
        timestamp("1995-01-01").alias("SellStartDate"),
        F.lit(None).cast("timestamp_ntz").alias("SellEndDate"),
        F.when(F.col("p_type") == "ECONOMY", timestamp("2001-01-01")).alias("DiscontinuedDate"),
    )
    return dim_product(soft_delete_flag(product, "DiscontinuedDate"))


@query(f"""
WITH adr AS ({ADDRESSES}),
bridge AS (
    SELECT c_custkey AS CustomerID, CAST(c_nationkey AS BIGINT) AS AddressID, 'Main Office' AS AddressType
    FROM customer
    UNION ALL
    SELECT c_custkey, (c_custkey * 3) % 25, 'Main Office' FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL
    SELECT c_custkey, (c_custkey * 7) % 25, 'Shipping' FROM customer WHERE c_acctbal > 0),
placed AS (
    SELECT bridge.CustomerID, bridge.AddressType, adr.*,
           ROW_NUMBER() OVER (PARTITION BY bridge.CustomerID, bridge.AddressType ORDER BY adr.AddressID) AS rn
    FROM bridge JOIN adr ON bridge.AddressID = adr.AddressID),
c AS (
    SELECT c_custkey AS CustomerID, c_mktsegment AS Title,
           CASE WHEN c_nationkey = 7 THEN NULL ELSE c_name END AS FirstName,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS MiddleName,
           CAST(c_nationkey AS VARCHAR) AS LastName, c_name AS CompanyName,
           c_name || '@example.com' AS EmailAddress, CAST(c_custkey AS VARCHAR) AS Phone
    FROM customer)
SELECT c.CustomerID, c.Title, c.FirstName, c.MiddleName, c.LastName,
       CASE WHEN c.MiddleName IS NULL THEN c.FirstName || ' ' || c.LastName
            ELSE c.FirstName || ' ' || c.MiddleName || ' ' || c.LastName END AS FullName,
       c.CompanyName, c.EmailAddress, c.Phone,
       ma.AddressLine1 AS OfficeAddress, ma.City AS OfficeCity, ma.StateProvince AS OfficeState,
       ma.CountryRegion AS OfficeCountry, ma.PostalCode AS OfficePostalCode,
       sh.AddressLine1 AS ShippingAddress, sh.City AS ShippingCity, sh.StateProvince AS ShippingState,
       sh.CountryRegion AS ShippingCountry, sh.PostalCode AS ShippingPostalCode
FROM c
LEFT JOIN (SELECT * FROM placed WHERE rn = 1 AND AddressType = 'Main Office') ma ON c.CustomerID = ma.CustomerID
LEFT JOIN (SELECT * FROM placed WHERE rn = 1 AND AddressType = 'Shipping') sh ON c.CustomerID = sh.CustomerID
""", name="dim_customer")
def dim_customer_mart(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "customer")
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    versions = source.select(
        key.alias("CustomerID"),
        segment.alias("Title"),
        F.when(F.col("c_nationkey") != 7, F.col("c_name")).alias("FirstName"),
        F.when(segment != "MACHINERY", segment).alias("MiddleName"),
        F.col("c_nationkey").cast("string").alias("LastName"),
        F.col("c_name").alias("CompanyName"),
        F.concat("c_name", F.lit("@example.com")).alias("EmailAddress"),
        key.cast("string").alias("Phone"),
        # Each customer has a closed version as well.
        F.explode(F.array(F.lit(0), F.lit(1))).alias("is_current"),
    )

    def role(number: Column, name: str, there: Column = F.lit(True)) -> Column:
        placed = F.struct(number.cast("bigint").alias("AddressID"), F.lit(name).alias("AddressType"))
        return F.when(there, placed)

    roles = F.array(
        role(F.col("c_nationkey"), MAIN_OFFICE),
        role((key * 3) % 25, MAIN_OFFICE, segment == "BUILDING"),
        role((key * 7) % 25, SHIPPING, F.col("c_acctbal") > 0),
    )
    bridge = source.select(key.alias("CustomerID"), F.explode(F.array_compact(roles)).alias("role")).select(
        "CustomerID", "role.*")
    return dim_customer(versions, bridge, addresses(spark, sf))


@query(f"""
WITH adr AS ({ADDRESSES}),
hv AS (
    SELECT o_orderkey, o_custkey, o_orderdate, o_orderdate AS modified, o_orderstatus, o_orderpriority FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderdate, o_orderdate - INTERVAL '1' DAY, 'O', o_orderpriority FROM orders),
h AS (SELECT hv.*, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY modified DESC) AS rn FROM hv)
SELECT h.o_orderkey AS SalesOrderID, h.o_orderdate AS OrderDate,
       h.o_orderdate + INTERVAL '12' DAY AS DueDate,
       CASE WHEN h.o_orderstatus = 'F' THEN h.o_orderdate + INTERVAL '7' DAY END AS ShipDate,
       CASE h.o_orderstatus WHEN 'O' THEN 'In Process' WHEN 'F' THEN 'Shipped' ELSE 'Unknown' END AS status_description,
       l.l_linenumber AS SalesOrderDetailID, l.l_quantity AS OrderQty, l.l_partkey AS ProductID,
       l.l_extendedprice AS UnitPrice, l.l_discount AS UnitPriceDiscount,
       l.l_extendedprice * (1 - l.l_discount) AS LineTotal,
       CASE WHEN h.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS OnlineOrderFlag,
       'SO' || CAST(h.o_orderkey AS VARCHAR) AS SalesOrderNumber, h.o_custkey AS CustomerID,
       h.o_custkey % 30 AS ShipToAddressID,
       COALESCE(a.AddressLine1, a.AddressLine2) AS ShipAddress, a.City AS ShipCity, a.StateProvince AS ShipState,
       a.CountryRegion AS ShipCountry, a.PostalCode AS ShipPostalCode,
       COALESCE(b.AddressLine1, b.AddressLine2) AS BillToAddress, b.City AS BillCity, b.StateProvince AS BillState,
       b.CountryRegion AS BillCountry, b.PostalCode AS BillPostal, h.o_orderpriority AS ShipMethod
FROM h
LEFT JOIN adr a ON h.o_custkey % 30 = a.AddressID
LEFT JOIN adr b ON h.o_orderkey % 25 = b.AddressID
JOIN lineitem l ON h.o_orderkey = l.l_orderkey
WHERE h.rn = 1 AND l.l_returnflag <> 'R'""", name="fact_sales")
def fact_sales_mart(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    older = orders.withColumns(
        {"modified": F.expr("o_orderdate - INTERVAL '1' DAY"), "o_orderstatus": F.lit("O")}
    )
    versions = orders.withColumn("modified", F.col("o_orderdate")).unionByName(older)
    status = case_of(F.col("o_orderstatus"), {"O": "1", "F": "5"}, "9").cast("int")
    header = current_flag(versions, ["o_orderkey"], ["modified"]).select(
        F.col("o_orderkey").alias("SalesOrderID"),
        F.col("o_orderdate").alias("OrderDate"),
        F.expr("o_orderdate + INTERVAL '12' DAY").alias("DueDate"),
        F.when(F.col("o_orderstatus") == "F", F.expr("o_orderdate + INTERVAL '7' DAY")).alias("ShipDate"),
        status.alias("Status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("OnlineOrderFlag"),
        F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")).alias("SalesOrderNumber"),
        F.col("o_custkey").alias("CustomerID"),
        (F.col("o_custkey") % 30).alias("ShipToAddressID"),
        (F.col("o_orderkey") % 25).alias("BillToAddressID"),
        F.col("o_orderpriority").alias("ShipMethod"),
        "is_current",
    )
    detail = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("SalesOrderID"),
        F.col("l_linenumber").alias("SalesOrderDetailID"),
        F.col("l_quantity").alias("OrderQty"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_extendedprice").alias("UnitPrice"),
        F.col("l_discount").alias("UnitPriceDiscount"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("LineTotal"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_deleted"),
    )
    return fact_sales(header, detail, addresses(spark, sf))


# --- Checks ----------------------------------------------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def unique_key_check(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def orphan_check(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey")
    return orphans(orders, table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")
