"""Every registered query with SQL gives the same rows as that SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import rows_of


@pytest.fixture(scope="module")
def connection(sf):
    con = duckdb.connect()
    for f in sorted(os.listdir(sf)):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, sf, connection, name):
    got = entry.queries()[name](spark, sf).toPandas()
    want = connection.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
