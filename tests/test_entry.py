"""The registered queries against their SQL on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from tailfold.plans.comparison_sql import SQL
from tailfold.plans.queries import QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are absent")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def comparable(rows):
    def value(v):
        return round(v, 6) + 0.0 if isinstance(v, float) else v

    return sorted([tuple(map(value, r)) for r in rows], key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.items() <= entry.queries().items()
    assert SQL.items() <= entry.oracle_sql().items() and entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, engine, name):
    frame = entry.queries()[name](spark, DATA)
    columns = sorted(frame.columns)
    result = engine.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = [[row[names.index(c)] for c in columns] for row in result.fetchall()]
    got = [[row[c] for c in columns] for row in frame.collect()]
    assert comparable(got) == comparable(expected)


def test_entry_returns_the_whole_grid(spark):
    assert entry.entry(spark).count() == 27
