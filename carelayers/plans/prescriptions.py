"""Prescriptions per patient, admission and medication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelayers.functions import dose_numeric, duration_hours, upper_trim
from carelayers.operators.clean import require_not_null
from carelayers.operators.fuse import fuse
from carelayers.operators.groups import bucket_counts, bucket_of, for_repeated
from carelayers.operators.repeats import distinct_rows
from carelayers.operators.rollup import rollup

# Keys, and where names and codes come from, best first.
PRESCRIPTION_KEYS = ["SUBJECT_ID", "HADM_ID", "DRUG"]
MEDICATION_EDGE = ["SUBJECT_ID", "HADM_ID", "MEDICATION_NAME"]
NAME_SOURCES = ["DRUG_NAME_GENERIC", "DRUG_NAME_POE", "DRUG"]
CODE_SOURCES = ["NDC", "GSN", "FORMULARY_DRUG_CD"]
REPRESENTATIVES = [
    "MEDICATION_CODE", "DRUG_TYPE", "ADMIN_ROUTE", "DOSE_UNIT_RX", "FORM_UNIT_DISP",
    "PROD_STRENGTH",
]
# What the statistics and the order of representatives use.
ROLLED_UP = ["ROW_ID", "ICUSTAY_ID", "DOSE_NUMERIC", "DURATION_HOURS", "STARTDATE", "ENDDATE"]
#: Tables of up to so many rows combine before the shuffle, whatever their groups are.
SMALL_TABLE = 1_000_000
#: Buckets of groups with up to so many rows, or one in ``LARGE_SHARE`` of all, are not large.
SMALL_BUCKET, LARGE_SHARE = 10_000, 1000


def medication_name() -> Column:
    """The first name that is not NULL; an empty text counts as a name."""
    return upper_trim(F.coalesce(*NAME_SOURCES))


def medication_code() -> Column:
    return F.coalesce(*[F.col(c).cast("string") for c in CODE_SOURCES])


def silver_prescriptions(bronze: DataFrame) -> DataFrame:
    """Prescriptions with every key, once each; rows that no other equals are not shuffled."""
    rows = for_repeated(require_not_null(bronze, PRESCRIPTION_KEYS), bronze.columns, distinct_rows)
    return rows.withColumns(
        {
            "MEDICATION_NAME": medication_name(),
            "MEDICATION_CODE": medication_code(),
            "ADMIN_ROUTE": upper_trim(F.col("ROUTE")),
            "DOSE_NUMERIC": dose_numeric(F.col("DOSE_VAL_RX")),
            "DURATION_HOURS": duration_hours(F.col("STARTDATE"), F.col("ENDDATE")),
        }
    )


def _rolled_up(silver: DataFrame, stays: Column | None = None) -> DataFrame:
    statistics = {
        "ICU_STAY_COUNT": F.count_distinct("ICUSTAY_ID") if stays is None else stays,
        "AVG_DOSE": F.avg("DOSE_NUMERIC"),
        "MAX_DOSE": F.max("DOSE_NUMERIC"),
        "MIN_DOSE": F.min("DOSE_NUMERIC"),
        "AVG_DURATION": F.avg("DURATION_HOURS"),
        "MAX_DURATION": F.max("DURATION_HOURS"),
        "FIRST_PRESCRIPTION_TIME": F.min("STARTDATE"),
        "LAST_PRESCRIPTION_TIME": F.max("ENDDATE"),
    }
    return rollup(
        silver,
        MEDICATION_EDGE,
        {c: c for c in REPRESENTATIVES},
        ["STARTDATE", "ROW_ID"],
        "PRESCRIPTION_COUNT",
        statistics,
    )


def gold_prescriptions(silver: DataFrame) -> DataFrame:
    """One row per patient, admission and medication; representatives from the earliest one.

    Rows are counted by buckets of groups first. In a large table, those of buckets with at most
    ``SMALL_BUCKET`` rows, or one in ``LARGE_SHARE``, are shuffled once as they are, by group, rather than twice as the state of all
    aggregates; others combine before the shuffle, and stays are counted by stay, as a group may be large.
    """
    buckets = bucket_counts(silver, MEDICATION_EDGE)
    if sum(buckets.values()) <= SMALL_TABLE:
        return _rolled_up(silver)
    columns = list(dict.fromkeys([*MEDICATION_EDGE, *REPRESENTATIVES, *ROLLED_UP]))
    limit = max(SMALL_BUCKET, sum(buckets.values()) // LARGE_SHARE)
    large = [b for b, n in buckets.items() if n > limit]
    here = bucket_of(MEDICATION_EDGE)
    rest = silver.where(~here.isin(large)) if large else silver
    # Of the rows of one stay only the first is counted: rows are sorted for that once, and combined once,
    # where a distinct count combines them by stay first.
    stay = Window.partitionBy(*MEDICATION_EDGE, "ICUSTAY_ID").orderBy("ICUSTAY_ID")
    new = (F.row_number().over(stay) == 1) & F.col("ICUSTAY_ID").isNotNull()
    rest = rest.select(*columns).repartition(*MEDICATION_EDGE).withColumn("__new", new)
    done = _rolled_up(rest, F.count_if("__new"))
    return fuse([done, _rolled_up(silver.where(here.isin(large)))]) if large else done
