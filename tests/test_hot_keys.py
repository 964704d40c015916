"""All queries on tables where one key holds a third of the rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from carelayers.catalog.registry import QUERIES
from test_oracle import TABLES, table_of

# The third of the rows that gets one key, as the columns to overwrite.
HOT = {
    "lineitem": """* replace (
        case when hot then 7 else l_orderkey end as l_orderkey,
        case when hot then 5 else l_partkey end as l_partkey,
        case when hot then 3 else l_suppkey end as l_suppkey)""",
    "orders": "* replace (case when hot then 11 else o_custkey end as o_custkey)",
    "events": """* replace (
        case when hot then 2 else user_id end as user_id,
        case when hot then 'click' else event_type end as event_type,
        case when hot then 41.5 else value end as value,
        case when hot then timestamp '2024-01-05 10:00:00' + to_minutes(cast(event_id % 90 as int))
          else ts end as ts)""",
}
# Counts of layers; the contents are checked by the other queries that run plans.
SKIPPED = {"run_tables", "run_pipelines", "layer_counts"}


@pytest.fixture(scope="module")
def hot_dir(sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    connection = duckdb.connect()
    for table in TABLES:
        source, target = f"{sf_dir}/{table}.parquet", folder / f"{table}.parquet"
        if table not in HOT:
            os.symlink(source, target)
            continue
        connection.execute(
            f"""copy (select {HOT[table].replace("* replace", "* exclude (hot) replace")} from (
                  select *, row_number() over () % 3 = 0 as hot from '{source}'))
                to '{target}' (format parquet)"""
        )
    return str(folder)


@pytest.fixture(scope="module")
def hot_duck(hot_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{hot_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIPPED))
def test_query_equals_sql_on_hot_keys(spark, hot_duck, hot_dir, name):
    df = entry.queries()[name](spark, hot_dir)
    cursor = hot_duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert table_of(df.collect(), df.columns) == table_of(cursor.fetchall(), columns)


def test_the_large_scale_ways_were_taken(spark, hot_dir, plan):
    assert "__salt" in plan(entry.queries()["join_chart_dictionary_shuffled"](spark, hot_dir))
