"""Every query with an oracle against DuckDB on the smallest driver tables."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not mounted")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES.split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_oracle(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    result = duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(result.columns)
    at = [result.columns.index(c) for c in columns]
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(
        tuple(r[i] for i in at) for r in result.fetchall()
    )


def test_entry_and_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0
