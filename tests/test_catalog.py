"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import compare
from dayfold.plans.catalog import QUERIES, SQL
from dayfold.plans.catalog.reports import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    c = duckdb.connect()
    for table in TABLES:
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.schema == entry.entry(spark).schema


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    result, _ = compare(spark, connection, name, SF)
    assert result.startswith("ok"), result
