"""Every query against its SQL equivalent in DuckDB."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from lakeops.catalog import oracle
from lakeops.catalog.queries import queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    yield connection
    connection.close()


def plain(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema and first.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_result_as_sql(name, spark, duck):
    df = QUERIES[name](spark, SF_DIR)
    rows = df.collect()
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert len(set(df.columns)) == len(df.columns)
    assert len(rows) == len(expected)
    assert rows, "the test data should give some rows"
    assert canonical(df.columns, rows) == canonical(columns, expected)
