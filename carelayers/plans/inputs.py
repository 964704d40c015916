"""Fluid and drug inputs of two bedside systems, and their union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelayers.functions import upper_trim
from carelayers.operators.clean import require_not_null, tag, typed_nulls
from carelayers.operators.fuse import fuse
from carelayers.operators.repeats import distinct_rows
from carelayers.operators.rollup import rollup

# Keys, renamed columns, normalized columns and source names.
INPUT_KEYS = ["SUBJECT_ID", "HADM_ID", "ITEMID"]
CV_TIMES = {"CHARTTIME": "EVENT_TIME"}
MV_TIMES = {"STARTTIME": "EVENT_TIME", "ENDTIME": "END_TIME"}
UNITS = {"AMOUNT_UNIT": "AMOUNTUOM", "RATE_UNIT": "RATEUOM"}
CV_ROUTE = {"ROUTE_NORMALIZED": "ORIGINALROUTE"}
CV_SOURCE, MV_SOURCE = "CareVue", "MetaVision"


def _normalized(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({new: upper_trim(F.col(old)) for new, old in columns.items()})


def silver_inputevents_cv(bronze: DataFrame) -> DataFrame:
    events = distinct_rows(require_not_null(bronze, INPUT_KEYS))
    events = events.withColumnsRenamed(CV_TIMES)
    events = typed_nulls(events, END_TIME="timestamp")
    return tag(_normalized(events, {**UNITS, **CV_ROUTE}), SOURCE_SYSTEM=CV_SOURCE)


def silver_inputevents_mv(bronze: DataFrame) -> DataFrame:
    events = distinct_rows(require_not_null(bronze, INPUT_KEYS))
    events = events.withColumnsRenamed(MV_TIMES)
    return tag(_normalized(events, UNITS), SOURCE_SYSTEM=MV_SOURCE)


def _input_statistics(last_time: str) -> dict[str, Column]:
    return {
        "AVG_AMOUNT": F.avg("AMOUNT"),
        "MAX_AMOUNT": F.max("AMOUNT"),
        "MIN_AMOUNT": F.min("AMOUNT"),
        "AVG_RATE": F.avg("RATE"),
        "MAX_RATE": F.max("RATE"),
        "FIRST_EVENT_TIME": F.min("EVENT_TIME"),
        "LAST_EVENT_TIME": F.max(last_time),
    }


def gold_inputevents_cv(silver: DataFrame) -> DataFrame:
    """One row per patient, admission and item; representatives come from the earliest event."""
    names = {
        "SOURCE_SYSTEM": "SOURCE_SYSTEM",
        "AMOUNT_UNIT": "AMOUNT_UNIT",
        "RATE_UNIT": "RATE_UNIT",
        "ROUTE_NORMALIZED": "ROUTE_NORMALIZED",
    }
    order = ["EVENT_TIME", "ROW_ID"]
    return rollup(silver, INPUT_KEYS, names, order, "EVENT_COUNT", _input_statistics("EVENT_TIME"))


def gold_inputevents_mv(silver: DataFrame) -> DataFrame:
    """As for the other system, with the order category, and the last end as last time."""
    names = {
        "SOURCE_SYSTEM": "SOURCE_SYSTEM",
        "AMOUNT_UNIT": "AMOUNT_UNIT",
        "RATE_UNIT": "RATE_UNIT",
        "ORDER_CATEGORY": "ORDERCATEGORYNAME",
    }
    order = ["EVENT_TIME", "ROW_ID"]
    return rollup(silver, INPUT_KEYS, names, order, "EVENT_COUNT", _input_statistics("END_TIME"))


def gold_unified_inputevents(gold_cv: DataFrame, gold_mv: DataFrame) -> DataFrame:
    return fuse([gold_cv, gold_mv], allow_missing=True)
