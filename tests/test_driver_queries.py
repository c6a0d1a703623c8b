"""Every driver query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from termloom.plans.driver_queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["documents", "conversations", "pages", "part", "benchmark"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(row)) for row in df.select(*names).collect()) == want
    assert want


def test_entry(spark):
    assert entry.entry(spark).columns == ["query_id", "docid", "score", "rank"]
