"""Lenient conversions: a text that does not parse gives NULL, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the first decimal number in a dose text.
DOSE_PATTERN = r"(\d+\.?\d*)"
# Fixed value: a whole number written with a decimal part, such as 12.0.
WHOLE_PART = r"^\s*([+-]?\d+)\.\d*\s*$"


def safe_double(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def safe_long(value: Column) -> Column:
    """As a long; the decimal part of a number or text is dropped (``12.0`` gives 12)."""
    whole = F.regexp_extract(value.cast("string"), WHOLE_PART, 1).try_cast("bigint")
    return F.coalesce(value.try_cast("bigint"), whole)


def parse_timestamp(text: Column, pattern: str | None = None) -> Column:
    """Parse with Spark's default rules, or strictly with ``pattern`` when one is given."""
    if pattern is None:
        return F.try_to_timestamp(text)
    return F.try_to_timestamp(text, F.lit(pattern))


def dose_numeric(dose: Column) -> Column:
    """First number in a dose text: ``1-2`` gives 1, ``12.5 mg`` gives 12.5, no number gives NULL."""
    return F.regexp_extract(dose, DOSE_PATTERN, 1).try_cast("double")


def duration_hours(start: Column, end: Column) -> Column:
    """Whole seconds between the two times, in hours. Negative if ``end`` comes first."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(3600)
