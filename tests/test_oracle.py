"""Every registered query against the same result in plain SQL on another engine."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from carelayers.catalog.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Spark type -> DuckDB type.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return ""
    return pd.Timestamp(value).isoformat() if hasattr(value, "isoformat") else repr(value)


def table_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, plan, name):
    df = entry.queries()[name](spark, sf_dir)
    text = plan(df)
    for slow in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert slow not in text
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]).upper() for c in cursor.description}
    assert types == {c: TYPES[kind] for c, kind in df.dtypes}
    assert table_of(df.collect(), df.columns) == table_of(cursor.fetchall(), columns)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
