"""What a first pass over key hashes tells about groups: which are large, which repeat.

A hash is eight bytes whatever the row is, so such a pass shuffles a small part of what the rows would.
Results stay exact: rows that only share a hash are told apart by the step that follows. The rows are read
again by that step and must be the same each time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelayers.sources.layers import shared_folder

#: Groups are counted together in so many buckets; that many counts reach the driver, at any size.
BUCKETS = 1 << 16
#: Up to so many hashes of repeated groups go to all tasks; beyond that all rows are shuffled.
FEW_REPEATED = 500_000

_HASH = "__hash"


def bucket_of(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def bucket_counts(df: DataFrame, keys: Sequence[str]) -> dict[int, int]:
    """Rows of each bucket of groups; a group has at most the rows of its bucket."""
    table = df.groupBy(bucket_of(keys).alias("b")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    return dict(zip(table["b"].to_pylist(), table["n"].to_pylist()))


def for_repeated(
    df: DataFrame,
    keys: Sequence[str],
    step: Callable[[DataFrame], DataFrame],
    same: Sequence[Column] | None = None,
) -> DataFrame:
    """``step`` over the rows of groups with more than one row; all others stay as and where they are.

    For steps that leave a row alone in its group unchanged and keep the columns. The hashes of repeated
    groups are written to the shared folder and counted: few go to all tasks, with more of them than
    ``FEW_REPEATED`` all rows take the step. ``same`` is hashed instead of costly ``keys``; it must be equal
    in all rows of a group.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, "repeated")
    hashed = df.withColumn(_HASH, F.xxhash64(*(same or keys)))
    sizes = hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias("__n"))
    sizes.where("__n > 1").select(_HASH).write.parquet(folder)
    repeated = spark.read.parquet(folder)
    many = repeated.count()
    if not many:
        return df
    if many > FEW_REPEATED:
        return step(df)
    alone = hashed.join(F.broadcast(repeated), _HASH, "left_anti").select(*df.columns)
    others = hashed.join(F.broadcast(repeated), _HASH, "left_semi").select(*df.columns)
    return alone.unionByName(step(others))
