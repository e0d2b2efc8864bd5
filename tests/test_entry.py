"""Every registered query against its SQL in DuckDB, on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con(data_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{data_dir}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(contract.library_queries()) == set(contract.library_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.library_queries()))
def test_query_equals_sql(spark, con, data_dir, name):
    got = contract.library_queries()[name](spark, data_dir)
    columns = sorted(got.columns)
    cursor = con.execute(contract.library_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    key = lambda row: tuple((v is None, v) for v in row)
    want = sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=key)
    rows = sorted(map(tuple, got.select(*columns).collect()), key=key)
    assert rows == want


def test_entry(spark):
    assert contract.entry(spark).columns == ["img_id", "x", "y", "i", "s"]
