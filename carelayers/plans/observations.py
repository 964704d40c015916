"""Charted, laboratory and microbiology events, and the unified observation table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelayers.functions import (
    clean_text,
    event_flag,
    observation_id,
    observation_parts,
    parse_timestamp,
    safe_double,
)
from carelayers.operators.clean import project, tag, typed_nulls
from carelayers.operators.dictionary import BROADCAST_BYTES, enrich
from carelayers.operators.fuse import fuse
from carelayers.operators.groups import for_repeated
from carelayers.operators.ranking import first_within

# Output name -> input column.
CHART_ITEM = {
    "item_id": "ITEMID",
    "chart_label": "LABEL",
    "chart_abbreviation": "ABBREVIATION",
    "dbsource": "DBSOURCE",
    "linksto": "LINKSTO",
    "chart_category": "CATEGORY",
    "dictionary_unit": "UNITNAME",
    "param_type": "PARAM_TYPE",
    "concept_id": "CONCEPTID",
}
CHART_EVENT = {
    "chart_row_id": "ROW_ID",
    "subject_id": "SUBJECT_ID",
    "hadm_id": "HADM_ID",
    "icustay_id": "ICUSTAY_ID",
    "item_id": "ITEMID",
    "chart_time": "CHARTTIME",
    "store_time": "STORETIME",
    "caregiver_id": "CGID",
    "value_text": "VALUE",
    "value_num": "VALUENUM",
    "value_unit": "VALUEUOM",
    "warning": "WARNING",
    "error": "ERROR",
    "result_status": "RESULTSTATUS",
    "stopped": "STOPPED",
}
CHART_NAMED_COLUMNS = [
    "chart_row_id", "subject_id", "hadm_id", "icustay_id", "item_id", "chart_label",
    "chart_abbreviation", "dbsource", "linksto", "chart_category", "dictionary_unit",
    "param_type", "concept_id", "chart_time", "store_time", "caregiver_id", "value_text",
    "value_num", "value_unit", "warning", "error", "result_status", "stopped",
    "normalized_label", "normalized_unit",
]
LAB_ITEM = {
    "item_id": "ITEMID",
    "lab_label": "LABEL",
    "fluid": "FLUID",
    "lab_category": "CATEGORY",
    "loinc_code": "LOINC_CODE",
}
LAB_EVENT = {
    "lab_row_id": "ROW_ID",
    "subject_id": "SUBJECT_ID",
    "hadm_id": "HADM_ID",
    "item_id": "ITEMID",
    "chart_time": "CHARTTIME",
    "value_text": "VALUE",
    "value_num": "VALUENUM",
    "value_unit": "VALUEUOM",
    "flag": "FLAG",
}
LAB_NAMED_COLUMNS = [
    "lab_row_id", "subject_id", "hadm_id", "item_id", "lab_label", "fluid", "lab_category",
    "loinc_code", "chart_time", "value_text", "value_num", "value_unit", "flag",
    "normalized_label", "normalized_unit",
]
MICROBIOLOGY = {
    "micro_row_id": "ROW_ID",
    "subject_id": "SUBJECT_ID",
    "hadm_id": "HADM_ID",
    "chart_date": "CHARTDATE",
    "chart_time": "CHARTTIME",
    "specimen_item_id": "SPEC_ITEMID",
    "specimen_type": "SPEC_TYPE_DESC",
    "organism_item_id": "ORG_ITEMID",
    "organism_name": "ORG_NAME",
    "isolate_num": "ISOLATE_NUM",
    "antibiotic_item_id": "AB_ITEMID",
    "antibiotic_name": "AB_NAME",
    "dilution_text": "DILUTION_TEXT",
    "dilution_comparison": "DILUTION_COMPARISON",
    "dilution_value": "DILUTION_VALUE",
    "interpretation": "INTERPRETATION",
}
OBSERVATION_COLUMNS = [
    "source_table", "source_row_id", "subject_id", "hadm_id", "icustay_id", "event_time",
    "store_time", "item_id", "item_type", "item_label", "normalized_label", "category",
    "value_text", "value_num", "value_unit", "normalized_unit", "event_flag",
]

# What identifies an observation.
IDENTITY = ["source_table", "source_row_id", "subject_id", "hadm_id", "item_id", "event_time"]


def chart_events_named(
    chartevents: DataFrame, d_items: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Charted events with the names of their items; the unit falls back to the dictionary's.

    Labels and dictionary units are cleaned once per dictionary row, not once per event.
    """
    events = project(chartevents, CHART_EVENT).withColumns(
        {
            "chart_time": parse_timestamp(F.col("chart_time")),
            "store_time": parse_timestamp(F.col("store_time")),
            "value_num": safe_double(F.col("value_num")),
        }
    )
    cleaned = {
        "normalized_label": clean_text(F.col("chart_label")),
        "__clean_unit": clean_text(F.col("dictionary_unit")),
    }
    items = project(d_items, CHART_ITEM)
    named = enrich(events, items, "item_id", max_bytes=max_bytes, derived=cleaned).withColumns(
        {
            "value_unit": F.coalesce("value_unit", "dictionary_unit"),
            "normalized_unit": F.coalesce(clean_text(F.col("value_unit")), "__clean_unit"),
        }
    )
    return named.select(*CHART_NAMED_COLUMNS)


def lab_events_named(
    labevents: DataFrame, d_labitems: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Laboratory events with the names of their items."""
    events = project(labevents, LAB_EVENT).withColumns(
        {
            "chart_time": parse_timestamp(F.col("chart_time")),
            "value_num": safe_double(F.col("value_num")),
        }
    )
    cleaned = {"normalized_label": clean_text(F.col("lab_label"))}
    items = project(d_labitems, LAB_ITEM)
    named = enrich(events, items, "item_id", max_bytes=max_bytes, derived=cleaned)
    named = named.withColumn("normalized_unit", clean_text(F.col("value_unit")))
    return named.select(*LAB_NAMED_COLUMNS)


def microbiology_clean(microbiology: DataFrame) -> DataFrame:
    """Typed microbiology events; the event time is the charted time or else the date."""
    events = project(microbiology, MICROBIOLOGY).withColumns(
        {
            "chart_date": parse_timestamp(F.col("chart_date")),
            "chart_time": parse_timestamp(F.col("chart_time")),
            "dilution_value": safe_double(F.col("dilution_value")),
        }
    )
    names = ("specimen_type", "organism_name", "antibiotic_name")
    return events.withColumns(
        {
            "event_time": F.coalesce("chart_time", "chart_date"),
            **{f"normalized_{name}": clean_text(F.col(name)) for name in names},
        }
    )


def observations(charts: DataFrame, labs: DataFrame) -> DataFrame:
    """Charted and laboratory events in one schema, each with its hashed id."""
    chart = charts.withColumns(
        {
            "source_row_id": F.col("chart_row_id"),
            "event_time": F.col("chart_time"),
            "item_label": F.col("chart_label"),
            "category": F.col("chart_category"),
            "event_flag": event_flag(
                warning=F.col("warning"),
                error=F.col("error"),
                result_status=F.col("result_status"),
                stopped=F.col("stopped"),
            ),
        }
    )
    lab = typed_nulls(labs, icustay_id="string", store_time="timestamp").withColumns(
        {
            "source_row_id": F.col("lab_row_id"),
            "event_time": F.col("chart_time"),
            "item_label": F.col("lab_label"),
            "category": F.col("lab_category"),
            "event_flag": F.col("flag"),
        }
    )
    chart = tag(chart, source_table="chartevents", item_type="chart")
    lab = tag(lab, source_table="labevents", item_type="lab")
    both = fuse([side.select(*OBSERVATION_COLUMNS) for side in (chart, lab)])
    return both.withColumn("observation_id", observation_id(*[F.col(c) for c in IDENTITY]))


def clinical_observation(charts: DataFrame, labs: DataFrame) -> DataFrame:
    """One row per observation id; of rows that share one, the first by all other columns.

    Ids are looked through first, by what they are made of, so rows whose id is no other row's are not shuffled.
    """
    keys = ["observation_id"]
    parts = observation_parts(*[F.col(c) for c in IDENTITY])
    return for_repeated(observations(charts, labs), keys, lambda rows: first_within(rows, keys, []), parts)


def observation_sources(charts: DataFrame, labs: DataFrame) -> DataFrame:
    """Source table and id of the rows of ``clinical_observation``, without carrying the other columns.

    The first row by all columns has the first source table, which leads them.
    """
    rows = observations(charts, labs).select("source_table", "observation_id")
    return first_within(rows, ["observation_id"], ["source_table"])
