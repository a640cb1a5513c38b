"""Every query with a SQL counterpart, value by value against DuckDB."""

from __future__ import annotations

import duckdb
import pytest
from conftest import TABLES

import __spark_entry__ as contract

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(small_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small_dir}/{table}.parquet'")
    return connection


def _sorted(rows):
    return sorted(rows, key=str)


def test_oracle_names_are_queries():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_twenty_rows(spark):
    assert contract.entry(spark).count() == 20


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, small_dir, name):
    frame = QUERIES[name](spark, small_dir)
    columns = sorted(frame.columns)
    ours = [tuple(row[c] for c in columns) for row in frame.collect()]
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    theirs = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert sorted(names) == columns
    assert _sorted(ours) == _sorted(theirs)
    assert not ours or [type(v) for v in _sorted(ours)[0]] == [type(v) for v in _sorted(theirs)[0]]
