"""The jobs end to end over Parquet files of the retail schema."""

from __future__ import annotations

from datetime import datetime

import pytest

from jobs import apply_change_feed, build_mart, init_change_feed, load_conformed, load_raw, probe_source, run_sql, show_table
from jobs.common import jdbc_source
from tidemark.retail import CUSTOMER_COLUMNS, ORDER_HEADER_COLUMNS, PRODUCT_COLUMNS, retail_specs
from tidemark.sources import TableStore
from tidemark.spec import SpecError

CAPTURE = "SalesLT_SalesOrderDetail"
DETAIL = "SalesOrderID int, SalesOrderDetailID int, OrderQty int, ProductID int, UnitPrice int, UnitPriceDiscount int, LineTotal int"
FEED = f"`__$start_lsn` binary, `__$seqval` binary, `__$operation` int, `__$update_mask` binary, {DETAIL}"


def frame(spark, columns, types, rows):
    """Rows given as dictionaries; columns not named in ``types`` are strings."""
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in columns)
    return spark.createDataFrame([tuple(row.get(c) for c in columns) for row in rows], schema)


@pytest.fixture
def extract(spark, tmp_path):
    modified = {"ModifiedDate": "timestamp_ntz"}
    day = datetime(2024, 1, 1, 8)

    def write(name, df):
        df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))

    def changes(*rows):
        log = [(n.to_bytes(10, "big"), (1).to_bytes(10, "big"), op, None, o, d, q, 680, 5, 0, 5 * q) for n, op, o, d, q in rows]
        write(CAPTURE, spark.createDataFrame(log, FEED))

    write("Product", frame(spark, PRODUCT_COLUMNS, {"ProductID": "int", "DiscontinuedDate": "timestamp_ntz", **modified},
                           [{"ProductID": 680, "Name": "Bike", "ModifiedDate": day},
                            {"ProductID": 681, "Name": "Old", "ModifiedDate": day, "DiscontinuedDate": day}]))
    write("SalesOrderHeader", frame(
        spark, ORDER_HEADER_COLUMNS,
        {c: "int" for c in ("SalesOrderID", "CustomerID", "ShipToAddressID", "BillToAddressID", "Status")} | modified,
        [{"SalesOrderID": 1, "CustomerID": 7, "ShipToAddressID": 1, "BillToAddressID": 2, "Status": 5, "ModifiedDate": day}]))
    write("Address", spark.createDataFrame(
        [(1, "a", None, "c", "s", "n", "p"), (2, None, "b", "c2", "s", "n", "p")],
        "AddressID int, AddressLine1 string, AddressLine2 string, City string, StateProvince string, CountryRegion string, PostalCode string"))
    write("CustomerAddress", spark.createDataFrame([(7, 1, "Main Office")], "CustomerID int, AddressID int, AddressType string"))
    write("Customer", frame(spark, CUSTOMER_COLUMNS, {"CustomerID": "int", **modified},
                            [{"CustomerID": 7, "FirstName": "Ann", "LastName": "Cole", "PasswordHash": "h", "ModifiedDate": day}]))
    write("SalesOrderDetail", spark.createDataFrame([(1, 10, 1, 680, 5, 0, 5), (1, 11, 1, 680, 5, 0, 5)], DETAIL))
    changes((5, 2, 1, 10, 1))
    return str(tmp_path), changes


def test_layers_from_files_to_marts(spark, extract, tmp_path, capsys):
    folder, changes = extract
    for database in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    store, specs = TableStore(spark), retail_specs()
    feed = "saleslt_salesorderdetail_cdc"
    init_change_feed.main([feed, "--parquet", folder], spark)
    assert f"0x{5:020X}" in capsys.readouterr().out
    plain = [s.table_id for s in specs if "salesorderdetail" not in s.table_id]
    for table_id in plain:
        load_raw.main([table_id, "--parquet", folder, "--preview"], spark)
        load_conformed.main([table_id], spark)
    assert "Ann" in capsys.readouterr().out
    changes((5, 2, 1, 10, 1), (6, 4, 1, 10, 3), (7, 1, 1, 11, 1), (8, 2, 1, 12, 4))
    load_raw.main([feed, "--parquet", folder], spark)
    apply_change_feed.main([feed, "--checkpoint", str(tmp_path / "checkpoint")], spark)
    for mart in ("dim_customer", "dim_product", "fact_sales"):
        build_mart.main([mart], spark)

    fact = store.read("gold.fact_sales").orderBy("SalesOrderDetailID").collect()
    assert [(r["SalesOrderDetailID"], r["OrderQty"], r["BillToAddress"]) for r in fact] == [(10, 3, "b"), (12, 4, "b")]
    assert store.read("gold.dim_customer").first()["FullName"] == "Ann Cole"
    assert sorted(tuple(r) for r in store.read("gold.dim_product").select("ProductID", "is_deleted").collect()) == [(680, 0), (681, 1)]
    assert "PasswordHash" not in store.read("bronze.saleslt_customer").columns

    load_raw.main(["saleslt_salesorderdetail_snapshot", "--parquet", folder], spark)
    load_conformed.main(["saleslt_salesorderdetail_snapshot"], spark)
    load_conformed.main([feed], spark)
    assert "nothing to apply" in capsys.readouterr().out

    show_table.main(["bronze.saleslt_product", "--where", "ProductID = 680"], spark)
    assert "rows: 1" in capsys.readouterr().out
    (tmp_path / "q.sql").write_text("SELECT count(*) AS customers FROM gold.dim_customer;\n")
    run_sql.main([str(tmp_path / "q.sql")], spark)
    assert "customers" in capsys.readouterr().out


def test_change_feed_jobs_refuse_other_tables(spark, extract):
    with pytest.raises(SpecError, match="loads no change feed"):
        init_change_feed.main(["saleslt_customer", "--parquet", extract[0]], spark)
    with pytest.raises(SpecError, match="saleslt_nothing"):
        load_raw.main(["saleslt_nothing", "--parquet", extract[0]], spark)
    with pytest.raises(SystemExit):
        load_conformed.main([], spark)


def test_jdbc_jobs_need_a_url(spark):
    with pytest.raises(ValueError, match="spark.tidemark.jdbc.url"):
        jdbc_source(spark)


def test_probe(spark, monkeypatch, capsys):
    class Reachable:
        def probe(self):
            return True

        def sample(self, schema, table, columns, key):
            return spark.createDataFrame([tuple(columns)], ", ".join(f"{c} string" for c in columns))

    monkeypatch.setattr(probe_source, "jdbc_source", lambda _spark: Reachable())
    probe_source.main(["--sample"], spark)
    assert "source reachable" in capsys.readouterr().out
