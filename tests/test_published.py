"""Layers stay readable while they are written, and when a write fails."""

import pytest
from pyspark.sql import functions as F

from carelayers.sources.layers import shared_folder
from carelayers.sources.published import publish_layer, read_published


@pytest.fixture
def root(spark):
    return shared_folder(spark, "published")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_readers_keep_the_rows_they_opened(spark, root):
    publish_layer(spark.range(5), root, "gold", "t")
    old = read_published(spark, root, "gold", "t")
    publish_layer(spark.range(100, 103), root, "gold", "t")
    assert ids(old) == [0, 1, 2, 3, 4]
    assert ids(read_published(spark, root, "gold", "t")) == [100, 101, 102]
    for n in range(1, 4):
        publish_layer(spark.range(n), root, "gold", "t")
        assert ids(read_published(spark, root, "gold", "t")) == list(range(n))


def test_a_failed_write_leaves_the_layer(spark, root):
    publish_layer(spark.range(5), root, "gold", "t")
    broken = spark.range(1000, numPartitions=4).withColumn("x", F.when(F.col("id") > 900, F.raise_error(F.lit("no"))))
    for _ in range(2):
        with pytest.raises(Exception, match="no"):
            publish_layer(broken, root, "gold", "t")
        assert ids(read_published(spark, root, "gold", "t")) == [0, 1, 2, 3, 4]
    publish_layer(spark.range(2), root, "gold", "t")
    assert ids(read_published(spark, root, "gold", "t")) == [0, 1]


def test_a_layer_made_from_itself(spark, root):
    publish_layer(spark.range(3), root, None, "t")
    for n in range(2):
        now = read_published(spark, root, None, "t")
        publish_layer(now.unionByName(spark.range(10 + n, 11 + n)), root, None, "t")
    assert ids(read_published(spark, root, None, "t")) == [0, 1, 2, 10, 11]


def test_a_first_write_that_fails_is_no_layer(spark, root):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_published(spark, root, "gold", "none")
    with pytest.raises(Exception, match="no"):
        publish_layer(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), root, "gold", "none")
    with pytest.raises(Exception):
        read_published(spark, root, "gold", "none")
    publish_layer(spark.range(0), root, "gold", "none")
    assert ids(read_published(spark, root, "gold", "none")) == []
