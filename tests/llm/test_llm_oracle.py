"""Text queries against their SQL, whole tables, rows compared as they are."""

import os

import duckdb
import pytest

from llm.oracle import oracle_sql
from llm.queries import queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def plain(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_same_rows_as_sql(name, spark):
    connection = duckdb.connect()
    for view in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{SF_DIR}/{view}.parquet')")
    cursor = connection.execute(oracle_sql()[name])
    columns = sorted(c[0] for c in cursor.description)
    place = [[c[0] for c in cursor.description].index(c) for c in columns]
    expected = sorted(tuple(plain(row[i]) for i in place) for row in cursor.fetchall())
    df = queries()[name](spark, SF_DIR)
    assert sorted(df.columns) == columns
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    assert got == expected
