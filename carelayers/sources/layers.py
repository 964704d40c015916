"""Parquet layers: one dataset per (layer, table) below one root."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Codec of layers where the session names none. Hashed ids and numbers shrink little without entropy coding.
CODEC = "zstd"
_CODEC = "spark.sql.parquet.compression.codec"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Meanwhile the session drops what a query has shuffled when that query ends, also when it fails.

    Otherwise the files stay until the driver happens to collect its garbage. A session that has made the
    choice itself keeps it.
    """
    if spark.conf.get(_CLEANUP, None) is not None:
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster shares (``spark.checkpoint.dir``).

    Only a local session without that setting gets a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="carelayers-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def layer_path(root: str, layer: str | None, table: str) -> str:
    """``root/layer_table``, or ``root/table`` for results that belong to no layer."""
    return f"{root.rstrip('/')}/{layer}_{table}" if layer else f"{root.rstrip('/')}/{table}"


def read_layer(spark: SparkSession, root: str, layer: str | None, table: str) -> DataFrame:
    return spark.read.parquet(layer_path(root, layer, table))


def write_counted(
    df: DataFrame,
    root: str,
    layer: str | None,
    table: str,
    partitions: int | None = None,
    columns: Sequence[str] = (),
) -> tuple[int, dict[str, int]]:
    """Overwrite a layer; return its rows and the non-NULL values of ``columns``.

    Both are counted by the write itself. Files are compressed by ``CODEC`` unless the session names
    another codec. Without ``partitions`` the rows are written where they are and adaptive execution
    sizes the files of shuffled results; with it, one more shuffle makes at most that many files.
    """
    written = Observation()
    out = df.repartition(partitions) if partitions else df
    filled = [F.count(F.col(c)).alias(f"filled{i}") for i, c in enumerate(columns)]
    out = out.observe(written, F.count(F.lit(1)).alias("rows"), *filled)
    codec = df.sparkSession.conf.get(_CODEC, CODEC)
    out.write.mode("overwrite").parquet(layer_path(root, layer, table), compression=codec)
    counts = written.get
    return counts["rows"], {c: counts[f"filled{i}"] for i, c in enumerate(columns)}


def write_layer(
    df: DataFrame, root: str, layer: str | None, table: str, partitions: int | None = None
) -> int:
    """Overwrite a layer and return its row count."""
    return write_counted(df, root, layer, table, partitions)[0]


def materialize(
    df: DataFrame, root: str, layer: str | None, table: str, partitions: int | None = None
) -> DataFrame:
    """Write a layer and go on from the written copy.

    This cuts the lineage: a lost executor costs a re-read, and later filters and column choices
    reach the Parquet scan.
    """
    write_layer(df, root, layer, table, partitions)
    return read_layer(df.sparkSession, root, layer, table)


def layer_counts(
    spark: SparkSession, root: str, layers: Iterable[tuple[str | None, str]]
) -> DataFrame:
    """``(layer, table, rows)`` of written layers; Parquet answers from the file footers."""
    counts = [
        read_layer(spark, root, layer, table).agg(
            F.lit(layer or "result").alias("layer"),
            F.lit(table).alias("table"),
            F.count(F.lit(1)).alias("rows"),
        )
        for layer, table in layers
    ]
    return reduce(DataFrame.unionByName, counts)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Give ``df`` a name for SQL text, replacing an older view of that name."""
    df.createOrReplaceTempView(name)
    return df
