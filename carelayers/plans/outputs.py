"""Patient outputs and coded diagnoses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelayers.functions import normalize_title, parse_timestamp, remap, safe_long
from carelayers.operators.clean import exclude_code, require_keys
from carelayers.operators.dictionary import enrich

# Keys, unit spellings, the time format and the code that was entered twice.
OUTPUT_KEYS = ["SUBJECT_ID", "HADM_ID", "ITEMID", "CHARTTIME"]
UNIT_ALIASES = {"mL": "ml"}
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
REPLACED_CODE, KEPT_CODE = "75539", "75529"


def silver_outputevents(bronze: DataFrame) -> DataFrame:
    return require_keys(bronze, OUTPUT_KEYS).withColumn(
        "VALUEUOM", remap(F.col("VALUEUOM"), UNIT_ALIASES)
    )


def gold_outputevents(silver: DataFrame) -> DataFrame:
    """Times as timestamps, nullable ids as long. Times that are no text any more stay as they are."""
    kinds = dict(silver.dtypes)
    times = {
        c: parse_timestamp(F.col(c), TIME_FORMAT if kinds[c] == "string" else None)
        for c in ("CHARTTIME", "STORETIME")
    }
    ids = {c: safe_long(F.col(c)) for c in ("HADM_ID", "ICUSTAY_ID")}
    return silver.withColumns({**times, **ids})


def silver_diagnoses_icd(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("ICD9_CODE", remap(F.col("ICD9_CODE"), {REPLACED_CODE: KEPT_CODE}))


def silver_d_icd_diagnoses(bronze: DataFrame) -> DataFrame:
    cleaned = {f"{c.lower()}_clean": normalize_title(F.col(c)) for c in ("LONG_TITLE", "SHORT_TITLE")}
    return exclude_code(bronze, "ICD9_CODE", REPLACED_CODE).withColumns(cleaned)


def gold_diagnoses_icd(silver: DataFrame, silver_dictionary: DataFrame) -> DataFrame:
    """Diagnoses with their titles; a code the dictionary repeats gives one row per entry."""
    return enrich(silver, silver_dictionary.drop("ROW_ID"), "ICD9_CODE", dedup=False)
