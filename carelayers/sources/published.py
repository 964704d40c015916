"""Layers that can be overwritten while they are read: each write has a folder, a pointer names the last.

A layer has two slots. A write fills the one that is not in use and then appends a pointer, a file of one
line; a write that fails leaves the layer as it was. Readers follow the newest pointer, and keep their
slot until the write after the next begins. Pointers are never changed or removed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelayers.sources.layers import layer_path

# Hidden from plain readers of the layer's folder, which would take both slots for one table.
_SLOTS, _POINTERS = ("_a", "_b"), "_pointers"


def _last(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """Number and slot of the newest write, or None."""
    try:
        lines = spark.read.text(f"{path}/{_POINTERS}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    number = F.split("value", " ")[0].cast("bigint").alias("n")
    row = lines.select(number, F.split("value", " ")[1].alias("slot")).orderBy(F.desc("n")).first()
    return (row["n"], row["slot"]) if row else None


def publish_layer(df: DataFrame, root: str, layer: str | None, table: str) -> None:
    """Replace a published layer; ``df`` may read the layer itself. One writer at a time."""
    spark, path = df.sparkSession, layer_path(root, layer, table)
    number, used = _last(spark, path) or (0, _SLOTS[1])
    slot = _SLOTS[1 - _SLOTS.index(used)]
    df.write.mode("overwrite").parquet(f"{path}/{slot}")
    line = spark.createDataFrame([(f"{number + 1} {slot}",)], "value string")
    line.coalesce(1).write.mode("append").text(f"{path}/{_POINTERS}")


def read_published(spark: SparkSession, root: str, layer: str | None, table: str) -> DataFrame:
    """The rows of the newest whole write; one that was never written is an error (``PATH_NOT_FOUND``)."""
    path = layer_path(root, layer, table)
    last = _last(spark, path)
    return spark.read.parquet(f"{path}/{last[1] if last else _SLOTS[0]}")
