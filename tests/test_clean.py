import math

import pytest
from pyspark.sql import functions as F

from carelayers.operators.clean import (
    drop_columns,
    drop_sparse_columns,
    exclude_code,
    lookup,
    require_keys,
    require_not_null,
    sparse_columns,
    tag,
    typed_nulls,
)
from carelayers.operators.fuse import fuse


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1, 1.0, "a", None), (2, math.nan, None, None), (None, 3.0, "x", None), (4, None, "b", "z")],
        "k long, v double, c string, s string",
    )


def test_nan_is_no_key_but_is_not_null(table):
    assert [r.k for r in require_keys(table, ["k", "v"]).collect()] == [1]
    assert [r.k for r in require_not_null(table, ["k", "v"]).collect()] == [1, 2]


def test_sparse_columns_are_strictly_above_the_threshold(spark, table):
    assert sparse_columns(table) == ["s"]
    half = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert sparse_columns(half) == []
    assert sparse_columns(half, 0.4) == ["b"]
    assert sparse_columns(half.where("a > 9")) == []
    assert drop_sparse_columns(table, keep=["s"]).columns == table.columns
    assert drop_sparse_columns(table).columns == ["k", "v", "c"]


def test_unknown_columns_are_ignored(table):
    assert drop_columns(table, ["v", "nope"]).columns == ["k", "c", "s"]


def test_excluding_a_code_drops_null_codes(table):
    assert sorted(r.c for r in exclude_code(table, "c", "x").collect()) == ["a", "b"]


def test_lookup_and_constants(table):
    assert lookup(table, k=4, c="b").count() == 1
    out = typed_nulls(tag(table, source="cv"), until="timestamp")
    assert dict(out.dtypes)["until"] == "timestamp"
    assert out.where(F.col("until").isNull() & (F.col("source") == "cv")).count() == 4


def test_fuse(spark):
    a = spark.createDataFrame([(1, "x")], "id int, left string")
    b = spark.createDataFrame([("y", 2)], "right string, id int")
    both = fuse([a, b], allow_missing=True)
    assert both.columns == ["id", "left", "right"]
    assert sorted(map(tuple, both.collect())) == [(1, "x", None), (2, None, "y")]
    with pytest.raises(Exception, match="left|right|columns"):
        fuse([a, b]).collect()


def test_key_filters_reach_the_scan(spark, plan, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(require_keys(events, ["user_id", "ts"]).select("user_id"))
    assert "IsNotNull(user_id)" in text and "IsNotNull(ts)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
