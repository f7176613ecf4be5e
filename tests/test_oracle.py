"""Every registered query against its SQL in DuckDB, over the whole test tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.catalogue import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield connection
    connection.close()


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return None if math.isnan(value) else float(f"{value:.12g}")
        return value

    return sorted(columns), Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    got = queries()[name](spark, SF_DIR)
    want = duck.sql(oracle_sql()[name])
    got_columns, got_rows = bag(got.collect(), got.columns)
    want_columns, want_rows = bag(want.fetchall(), want.columns)
    assert got_columns == want_columns
    assert got_rows == want_rows
    assert got_rows


def test_entry_gives_rows(spark):
    assert entry(spark).limit(1).count() == 1
