"""Groups with frequencies, representatives and statistics.

All aggregates combine before the shuffle, so a hot group arrives as one row per input task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edge_counts(
    df: DataFrame, keys: Sequence[str], name: str, **extra: Column
) -> DataFrame:
    """Rows per key combination as ``name``, plus further aggregates. NULL keys form groups."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(name), *[agg.alias(out) for out, agg in extra.items()]
    )


def representative(column: str, order: Sequence[str]) -> Column:
    """The first non-NULL value by ``order``, then by the value itself; NULL if there is none.

    NULL in ``order`` comes last: a row without a time is not the earliest.
    """
    place = [x for c in dict.fromkeys(order) for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    place += [] if column in order else [F.col(column)]
    return F.min(F.when(F.col(column).isNotNull(), F.struct(*place))).getField(column)


def rollup(
    df: DataFrame,
    keys: Sequence[str],
    representatives: Mapping[str, str],
    order: Sequence[str],
    count_as: str,
    statistics: Mapping[str, Column],
) -> DataFrame:
    """One row per key: ``{output: column}`` representatives, the row count, the statistics."""
    return df.groupBy(*keys).agg(
        *[representative(column, order).alias(out) for out, column in representatives.items()],
        F.count(F.lit(1)).alias(count_as),
        *[stat.alias(out) for out, stat in statistics.items()],
    )
