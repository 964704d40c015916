"""Vertical fusion of several sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def fuse(sources: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name.

    With ``allow_missing`` a column that one source lacks is NULL there; the order is the first
    source's columns, then those only later sources have. Without it the columns must agree.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), sources)
