"""Data-quality reports over written layers, as lazy DataFrames by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from carelayers.operators.clean import lookup
from carelayers.operators.ranking import duplicate_rows
from carelayers.operators.reports import (
    bucket_stats,
    compare_counts,
    compare_rows,
    distinct_values,
    duplicate_groups,
    duplicate_summary,
    exact_duplicate_count,
    reconcile,
    top_groups,
)
from carelayers.plans import procedures
from carelayers.plans.runner import PLANS
from carelayers.sources.layers import read_layer, write_layer

Reader = Callable[[str, str], DataFrame]


def _cptevents(read: Reader) -> dict[str, DataFrame]:
    silver = read("silver", "cptevents")
    keys = procedures.CPT_DUPLICATE_KEYS
    return {
        "duplicate_summary": duplicate_summary(silver, keys),
        "duplicate_rows": duplicate_rows(silver, keys, ["ROW_ID"]),
        "reconcile": reconcile(silver, read("gold", "cptevents"), "TICKET_COUNT"),
    }


def _procedures_icd(read: Reader) -> dict[str, DataFrame]:
    silver = read("silver", "procedures_icd")
    keys = procedures.ICD_DUPLICATE_KEYS
    return {
        "duplicate_groups": duplicate_groups(silver, keys),
        "top_duplicate_groups": top_groups(silver, keys, 5, min_count=2),
        "reconcile": reconcile(silver, read("gold", "procedures_icd"), "PROC_COUNT"),
    }


def _procedureevents_mv(read: Reader) -> dict[str, DataFrame]:
    bronze, silver = read("bronze", "procedureevents_mv"), read("silver", "procedureevents_mv")
    pairs = procedures.near_duplicate_events(silver)
    return {
        "bucket_stats": bucket_stats(bronze, "HADM_ID"),
        "top_buckets": top_groups(bronze, ["HADM_ID"], 10),
        "near_duplicates": pairs,
        "pair_preview": procedures.near_duplicate_preview(silver),
        "removed": compare_counts(silver, read("gold", "procedureevents_mv"), "HADM_ID"),
    }


def _prescriptions(read: Reader) -> dict[str, DataFrame]:
    silver = read("silver", "prescriptions")
    return {
        "medications": distinct_values(silver, "MEDICATION_NAME"),
        "reconcile": reconcile(silver, read("gold", "prescriptions"), "PRESCRIPTION_COUNT"),
    }


_EXTRA: dict[str, Callable[[Reader], dict[str, DataFrame]]] = {
    "cptevents": _cptevents,
    "procedures_icd": _procedures_icd,
    "procedureevents_mv": _procedureevents_mv,
    "d_cpt": lambda read: {"hierarchy": procedures.cpt_hierarchy(read("gold", "d_cpt"))},
    "outputevents": lambda read: {
        "exact_duplicates": exact_duplicate_count(read("bronze", "outputevents"))
    },
    "inputevents_cv": lambda read: {
        "reconcile": reconcile(
            read("silver", "inputevents_cv"), read("gold", "inputevents_cv"), "EVENT_COUNT"
        )
    },
    "inputevents_mv": lambda read: {
        "reconcile": reconcile(
            read("silver", "inputevents_mv"), read("gold", "inputevents_mv"), "EVENT_COUNT"
        )
    },
    "prescriptions": _prescriptions,
}


def table_reports(spark: SparkSession, root: str, name: str) -> dict[str, DataFrame]:
    """NULL profiles of the raw layers of a written result, and the reports that belong to it."""

    def read(layer: str, table: str) -> DataFrame:
        return read_layer(spark, root, layer, table)

    plan = PLANS[name]
    profiles = {
        f"null_profile_{table}": read("profile", table)
        for table in plan.raw
        if not plan.plain
    }
    return {**profiles, **_EXTRA.get(name, lambda _: {})(read)}


def write_reports(spark: SparkSession, root: str, tables: Iterable[str]) -> dict[str, int]:
    """Write the reports of written results as layers ``report_<table>_<report>``; their rows."""
    return {
        f"{table}_{name}": write_layer(report, root, "report", f"{table}_{name}")
        for table in tables
        for name, report in table_reports(spark, root, table).items()
    }


def admission_reports(spark: SparkSession, root: str, admission: int) -> dict[str, DataFrame]:
    """One admission in written layers: its procedure rows before and after, and its billing codes."""
    silver, gold = (read_layer(spark, root, layer, "procedureevents_mv") for layer in ("silver", "gold"))
    shown = ["ROW_ID", "ITEMID", "STARTTIME", "ENDTIME", "VALUE", "STATUSDESCRIPTION"]
    return {
        "procedure_rows": compare_rows(silver, gold, "HADM_ID", admission, shown, ["STARTTIME", "ROW_ID"]),
        "billing_codes": lookup(read_layer(spark, root, "silver", "cptevents"), HADM_ID=admission),
    }
