"""Numbered queries against their SQL on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tailfold.llm.sql import SQL

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are absent")


@pytest.mark.parametrize("name", list(SQL))
def test_query_agrees_with_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    frame = entry.queries()[name](spark, DATA)
    result = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    got = [tuple(row[c] for c in names) for row in frame.collect()]
    assert sorted(got, key=repr) == sorted(result.fetchall(), key=repr)
