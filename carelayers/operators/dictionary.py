"""Joins of event tables with their code dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelayers.operators.groups import bucket_counts, bucket_of
from carelayers.operators.ranking import first_within

# A dictionary up to this many bytes (as text, before deduplication) may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
# Counted on top of the text of each row.
_ROW_OVERHEAD = 64

# A key that more than one in so many facts have is spread over several tasks.
HOT_SHARE = 1000

_SALT = "__salt"


def text_bytes(dim: DataFrame) -> int:
    """Size of a table as text, measured in one pass."""
    width = reduce(
        add,
        [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in dim.columns],
        F.lit(_ROW_OVERHEAD),
    )
    return dim.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def one_per_key(dim: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One dictionary row per key: the first by ``order``, then by the remaining columns.

    NULL comes last, so a row with a label is preferred to one without.
    """
    return first_within(dim, [key], list(order))


def _shuffled_left_join(facts: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Left join that shuffles both sides, with the big keys of ``facts`` spread over many tasks.

    Every key that more than one in ``HOT_SHARE`` facts have, as counted, gets one salt for each such
    share; the dictionary rows of that key are repeated for its salts. There are fewer than
    ``HOT_SHARE`` such keys at any size. Facts are counted by buckets of keys first, and only keys of
    buckets with such a share one by one; without any, nothing is salted. Facts without a key meet nothing
    and are not shuffled. The salt depends on the input task and the row, so a task that runs again gives
    the same one.
    """
    keyed = facts.where(F.col(key).isNotNull())
    unkeyed = facts.where(F.col(key).isNull())
    buckets = bucket_counts(keyed, [key])
    total = sum(buckets.values())
    large = [b for b, n in buckets.items() if n * HOT_SHARE > total]
    if not large:
        return keyed.join(side, key, "left").unionByName(unkeyed, allowMissingColumns=True)
    some = keyed.where(bucket_of([key]).isin(large))
    counts = some.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    salts = F.ceil(F.col("__n") * HOT_SHARE / F.lit(max(1, total))).cast("int").alias("__salts")
    hot = F.broadcast(counts.where(F.col("__n") * HOT_SHARE > total).select(key, salts))
    n = F.coalesce(F.col("__salts"), F.lit(1))
    own = F.pmod(F.xxhash64(F.spark_partition_id(), *facts.columns), n).cast("int")
    every = F.explode(F.sequence(F.lit(0), n - 1))
    salted = keyed.join(hot, key, "left").withColumn(_SALT, own).drop("__salts")
    repeated = side.where(F.col(key).isNotNull()).join(hot, key, "left")
    repeated = repeated.withColumn(_SALT, every).drop("__salts")
    met = salted.join(repeated, [key, _SALT], "left").drop(_SALT)
    return met.unionByName(unkeyed, allowMissingColumns=True)


def enrich(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    dim_columns: Sequence[str] | None = None,
    *,
    dedup: bool = True,
    order: Sequence[str] = (),
    max_bytes: int = BROADCAST_BYTES,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Left join of ``facts`` with ``dim`` on the shared column ``key``, which comes first.

    The dictionary is sent to every executor only if its measured size allows; beyond that both
    sides are shuffled. Facts without a match keep NULLs. With ``dedup=False`` a repeated key gives
    one row per dictionary entry. ``derived`` columns are added to the rows that are left of the
    dictionary, so they are not computed to measure it.
    """
    columns = [c for c in (dim_columns or dim.columns) if c != key]
    side = dim.select(key, *columns)
    small = text_bytes(side) <= max_bytes
    if dedup:
        side = one_per_key(side, key, order)
    if derived:
        side = side.withColumns(dict(derived))
    if small:
        return facts.join(F.broadcast(side), key, "left")
    return _shuffled_left_join(facts, side, key)
