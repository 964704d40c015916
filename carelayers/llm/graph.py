"""Connected components of links that Spark holds.

Each task first joins what its own links connect, which leaves one link a node and task. If few are
left, as counted, one task joins these; else alternating stars do: each round links every node's
neighbours to the smallest node near it, first those larger than the node, then those smaller. Rounds go
with the logarithm of the largest component. A round is written to the shared folder and read back, so
plans stay short and lost executors cost one round.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelayers.sources.layers import shared_folder

#: Links that one task joins (some 200 bytes each).
ONE_TASK = 500_000


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(a, b)``: every linked node ``b`` but the smallest of its component, which is ``a``."""
    root: dict = {}
    schema = None

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
            if a is None or b is None or a == b:
                continue
            root.setdefault(a, a)
            root.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    if root:
        pairs = [(find(x), x) for x in root]
        columns = zip(*[p for p in pairs if p[0] != p[1]])
        yield pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for c, n in zip(columns, "ab")], names=["a", "b"])


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node, linked to the smallest of the node and its neighbours."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return near.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours, linked to the smallest of these neighbours."""
    down = links.select(F.greatest("a", "b").alias("n"), F.least("a", "b").alias("s"))
    least = down.groupBy("n").agg(F.min("s").alias("m"))
    moved = down.join(least, "n").where("s <> m").select(F.col("m").alias("a"), F.col("s").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), F.col("n").alias("b"))).distinct()


def components(links: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """``(node, component)`` of every linked node; the component is its smallest node.

    ``links`` has columns ``a, b``; links of a node with itself, with NULL, and repeated ones do not
    matter. No links give no rows. More than ``one_task`` links that are left by the tasks go through
    rounds; the result is the same.
    """
    spark, folder = links.sparkSession, shared_folder(links.sparkSession, "components")
    schema = links.select("a", "b").schema
    n = 0

    def written(df: DataFrame) -> DataFrame:
        nonlocal n
        n += 1
        df.write.parquet(f"{folder}/round{n}")
        return spark.read.parquet(f"{folder}/round{n}")

    def state(df: DataFrame) -> tuple:
        both = F.bit_xor(F.xxhash64("a", "b")).alias("x")
        return tuple(df.agg(F.count(F.lit(1)), both).first())

    now = written(links.select("a", "b").mapInArrow(_forest, schema))
    before = state(now)
    if 0 < before[0] <= one_task:
        now = written(now.coalesce(1).mapInArrow(_forest, schema))
    else:
        while before[0]:
            now = written(_small_star(_large_star(now)))
            after = state(now)
            if after == before:
                break
            before = after
    members = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
