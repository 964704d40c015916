"""Pairs of records that agree on their keys and nearly agree on their times."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import product
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _half_neighbourhood(dimensions: int) -> list[tuple[int, ...]]:
    """The own cell and one of each pair of opposite neighbour cells."""
    own = (0,) * dimensions
    return [step for step in product((-1, 0, 1), repeat=dimensions) if step >= own]


def near_duplicates(
    df: DataFrame,
    equal: Sequence[str],
    order: str,
    times: Sequence[str],
    tolerance_s: int = 3600,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Pairs with equal ``equal`` columns and every time less than ``tolerance_s`` seconds apart.

    The result has ``equal`` and two structs ``a`` and ``b`` with ``order``, ``times`` and
    ``carry``; ``a`` has the smaller ``order`` value. NULL in a key or time takes a row out.

    Times are cut into cells as wide as the tolerance, and the cell is part of the join key. So a
    big group is spread over its cells, and rows that meet lie in touching cells: what is compared
    stays near what is returned. Two rows in different cells meet once, because only one of two
    opposite neighbours is visited.
    """
    cells = [f"__cell{i}" for i in range(len(times))]
    fields = list(dict.fromkeys([order, *times, *carry]))
    needed = [F.col(c).isNotNull() for c in [*equal, *times]]
    rows = df.where(reduce(and_, needed)).select(
        *equal,
        F.struct(*fields).alias("__row"),
        *[F.floor(F.unix_timestamp(t) / tolerance_s).alias(c) for t, c in zip(times, cells)],
    )
    steps = F.array(
        *[
            F.struct(*[F.lit(s).cast("bigint").alias(c) for s, c in zip(step, cells)])
            for step in _half_neighbourhood(len(times))
        ]
    )
    visiting = rows.withColumn("__step", F.explode(steps)).select(
        *equal,
        F.col("__row").alias("__other"),
        reduce(and_, [F.col(f"__step.{c}") == 0 for c in cells]).alias("__home"),
        *[(F.col(c) + F.col(f"__step.{c}")).alias(c) for c in cells],
    )
    mine, other = F.col(f"__row.{order}"), F.col(f"__other.{order}")
    close = [
        F.abs(F.unix_timestamp(f"__row.{t}") - F.unix_timestamp(f"__other.{t}")) < tolerance_s
        for t in times
    ]
    # In its own cell a pair is met from both sides, elsewhere from one.
    once = F.when(F.col("__home"), mine < other).otherwise(mine != other)
    pairs = rows.join(visiting, [*equal, *cells]).where(reduce(and_, close) & once)
    return pairs.select(
        *equal,
        F.when(mine < other, F.col("__row")).otherwise(F.col("__other")).alias("a"),
        F.when(mine < other, F.col("__other")).otherwise(F.col("__row")).alias("b"),
    )


def first_pairs(
    df: DataFrame,
    pairs_of: Callable[[DataFrame], DataFrame],
    group: str,
    order: Sequence[str],
    n: int,
    groups: int = 8,
) -> DataFrame:
    """The first ``n`` pairs by ``group`` and then ``order``, without pairing what comes after them.

    ``pairs_of`` makes pairs within equal values of ``group``. It is given the rows of the first ``groups``
    values, of eight times as many if that makes too few pairs, and so on; NULL has no pairs.
    """
    values = df.where(F.col(group).isNotNull()).select(group).distinct()
    while True:
        first = values.orderBy(group).limit(groups).agg(F.max(group).alias("last"), F.count(F.lit(1)).alias("n")).first()
        some = pairs_of(df.where(F.col(group) <= F.lit(first["last"])))
        found = some.orderBy(group, *order).limit(n)
        if first["n"] < groups or found.count() == n:
            return found
        groups *= 8
