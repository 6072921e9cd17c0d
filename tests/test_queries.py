"""Every registered query against its SQL in DuckDB, on the smallest data."""

import os

import pytest

import __spark_entry__ as entry
from suite.base import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def database():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return connection


def ordered(names, rows):
    places = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in places], sorted(repr(tuple(row[i] for i in places)) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    found = ordered(df.columns, [tuple(r) for r in df.collect()])
    sql = SQL.get(name)
    assert sql is not None, "every query has its check"
    result = database.execute(sql)
    names = [d[0] for d in result.description]
    assert found == ordered(names, result.fetchall())


def test_entry(spark):
    assert entry.queries().keys() >= QUERIES.keys() and entry.oracle_sql().keys() >= SQL.keys()
    assert entry.entry(spark).count() == 5
