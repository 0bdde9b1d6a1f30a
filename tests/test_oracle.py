"""Every registered query against its SQL in DuckDB on the given tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("events", "documents", "embeddings", "labels")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def canonical(value):
    return repr(round(value, 6) + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) & set(entry_point.oracle_sql())))
def test_query_equals_its_oracle(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    result = duck.execute(entry_point.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted(tuple(canonical(row[c]) for c in order) for row in df.collect())
    rows = [dict(zip(names, row)) for row in result.fetchall()]
    assert got == sorted(tuple(canonical(row[c]) for c in order) for row in rows)


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0
