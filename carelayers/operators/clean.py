"""Column choices, key filters and constant columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select and rename: ``{new name: old name}``."""
    return df.select(*[F.col(old).alias(new) for new, old in mapping.items()])


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns; names the table does not have are ignored."""
    return df.drop(*columns)


def mostly_null(total: int, filled: Mapping[str, int], threshold: float = 0.5) -> list[str]:
    """Columns whose NULL share is strictly above ``threshold``; none on an empty table."""
    return [c for c, n in filled.items() if total and (total - n) / total > threshold]


def sparse_columns(df: DataFrame, threshold: float = 0.5) -> list[str]:
    """The mostly NULL columns, from one pass; one row of counts reaches the driver."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.col(c)).alias(f"filled{i}") for i, c in enumerate(df.columns)],
    ).first()
    filled = {c: counts[f"filled{i}"] for i, c in enumerate(df.columns)}
    return mostly_null(counts["total"], filled, threshold)


def drop_sparse_columns(
    df: DataFrame, threshold: float = 0.5, keep: Iterable[str] = ()
) -> DataFrame:
    """Drop the columns that are mostly NULL, except those in ``keep`` (such as key columns).

    The column list of the result depends on the data, so this runs one aggregate when called.
    """
    kept = set(keep)
    return df.drop(*[c for c in sparse_columns(df, threshold) if c not in kept])


def _all_not_null(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def require_not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows where every key is not NULL; NaN counts as a value. Reaches the Parquet scan."""
    return df.where(_all_not_null(keys))


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows where no key is NULL or NaN.

    Written as ``isNotNull`` rather than ``dropna``, which Spark does not push to the scan.
    """
    floats = {name for name, kind in df.dtypes if kind in ("double", "float")}
    rows = require_not_null(df, keys)
    return reduce(lambda out, k: out.where(~F.isnan(k)), [k for k in keys if k in floats], rows)


def tag(df: DataFrame, **constants: str) -> DataFrame:
    """Add constant columns that say where rows come from."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def typed_nulls(df: DataFrame, **types: str) -> DataFrame:
    """Add all-NULL columns of the given types, so two schemas line up."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in types.items()})


def exclude_code(df: DataFrame, column: str, code: str) -> DataFrame:
    """Drop rows with this code; rows with a NULL code go too."""
    return df.where(F.col(column).cast("string") != F.lit(code))


def lookup(df: DataFrame, **equals) -> DataFrame:
    """Rows where every named column equals its value."""
    return reduce(lambda out, kv: out.where(F.col(kv[0]) == F.lit(kv[1])), equals.items(), df)
