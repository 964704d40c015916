"""Removal of exact duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame


def distinct_rows(df: DataFrame) -> DataFrame:
    """Remove exact duplicate rows.

    Copies leave a task as one row, so a row that is repeated very often is no hot key.
    """
    return df.dropDuplicates()
