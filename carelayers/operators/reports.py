"""Data-quality reports. Each is a DataFrame, computed in Spark, never printed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelayers.operators.fuse import fuse


def _rows() -> Column:
    return F.count(F.lit(1))


def _percent(part: Column, whole: Column) -> Column:
    """0 on an empty table."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part * F.lit(100.0) / whole)


def _profile(counts: DataFrame) -> DataFrame:
    return counts.select(
        "column",
        "null_count",
        "total",
        _percent(F.col("null_count"), F.col("total")).alias("null_pct"),
        (F.col("null_count") > 0).alias("flagged"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: NULL count, row count, percent and whether any is NULL; one pass."""
    wide = df.agg(
        _rows().alias("total"),
        *[F.count(F.col(c)).alias(f"filled{i}") for i, c in enumerate(df.columns)],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"), (F.col("total") - F.col(f"filled{i}")).alias("null_count")
        )
        for i, c in enumerate(df.columns)
    ]
    return _profile(wide.select("total", F.inline(F.array(*cells))))


def null_profile_of(spark: SparkSession, total: int, filled: Mapping[str, int]) -> DataFrame:
    """The same report from counts taken while the table was written."""
    rows = [(c, total - n, total) for c, n in filled.items()]
    return _profile(spark.createDataFrame(rows, "column string, null_count bigint, total bigint"))


def bucket_stats(df: DataFrame, key: str) -> DataFrame:
    """Mean, largest, smallest and sample deviation of rows per key, and how many keys repeat."""
    sizes = df.groupBy(key).agg(_rows().alias("n"))
    return sizes.agg(
        F.avg("n").alias("avg_rows"),
        F.max("n").alias("max_rows"),
        F.min("n").alias("min_rows"),
        F.stddev_samp("n").alias("stddev_rows"),
        F.count_if(F.col("n") > 1).alias("repeated_buckets"),
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*keys).agg(_rows().alias("count")).where(F.col("count") > 1)


def top_groups(df: DataFrame, keys: Sequence[str], n: int, min_count: int = 1) -> DataFrame:
    """The ``n`` biggest groups with at least ``min_count`` rows; ties by key."""
    sizes = df.groupBy(*keys).agg(_rows().alias("count")).where(F.col("count") >= min_count)
    return sizes.orderBy(F.desc("count"), *[F.col(k).asc_nulls_first() for k in keys]).limit(n)


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, rows that are first in their group, rows that repeat one, and their percent.

    Counting groups needs no ranking, and combines before the shuffle.
    """
    sizes = df.groupBy(*keys).agg(_rows().alias("n"))
    totals = sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), _rows().alias("unique_rows")
    )
    repeated = F.col("total_rows") - F.col("unique_rows")
    return totals.select(
        "total_rows",
        "unique_rows",
        repeated.alias("duplicate_rows"),
        _percent(repeated, F.col("total_rows")).alias("duplicate_pct"),
    )


def exact_duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct full rows, and the difference."""
    return duplicate_summary(df, df.columns).select(
        "total_rows", F.col("unique_rows").alias("distinct_rows"), "duplicate_rows"
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Exact number of values, with NULL as a value and without it."""
    values = distinct_values(df, column)
    return values.agg(
        _rows().alias("distinct_with_null"), F.count(F.col(column)).alias("distinct_not_null")
    )


def _side_by_side(*totals: DataFrame) -> DataFrame:
    """One row from one-row tables of one number each."""
    names = [name for total in totals for name in total.columns]
    padded = fuse(totals, allow_missing=True)
    return padded.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def reconcile(silver: DataFrame, gold: DataFrame, count_column: str) -> DataFrame:
    """Rows of one layer against the summed counts of the next; the difference must be 0."""
    counted = gold.agg(F.sum(F.col(count_column).cast("bigint")).alias("gold_total"))
    return _side_by_side(silver.agg(_rows().alias("silver_rows")), counted).withColumn(
        "difference", F.col("silver_rows") - F.col("gold_total")
    )


def compare_counts(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows per key in two layers and how many went; one shuffle of combined counts."""
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    both = before.select(key, one.alias("b"), none.alias("a")).unionByName(
        after.select(key, none.alias("b"), one.alias("a"))
    )
    counts = both.groupBy(key).agg(F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after"))
    return counts.withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def compare_rows(
    before: DataFrame, after: DataFrame, key: str, value, columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The rows of one key in two layers, in order, marked ``before`` and ``after``."""
    sides = [
        df.where(F.col(key) == F.lit(value)).select(F.lit(name).alias("layer"), *columns)
        for name, df in (("before", before), ("after", after))
    ]
    return sides[0].unionByName(sides[1]).orderBy(F.desc("layer"), *order)


def head_by(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``, NULLs first."""
    return df.select(*columns).orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)
