"""Every registered query against its SQL counterpart on the smallest driver tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "supplier", "part", "lineitem", "events"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not there")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    expected = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(df.collect(), df.columns) == _sorted(expected.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
