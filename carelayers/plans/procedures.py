"""Billing codes, coded procedures, bedside procedures and their two dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelayers.operators.clean import drop_columns, drop_sparse_columns, require_keys
from carelayers.operators.near_duplicates import first_pairs, near_duplicates
from carelayers.operators.ranking import dedup_by_priority
from carelayers.operators.reports import head_by
from carelayers.operators.rollup import edge_counts

# Keys, dropped columns and the status that wins.
CPT_UNUSED = ["CPT_SUFFIX", "DESCRIPTION"]
CPT_KEYS = ["SUBJECT_ID", "HADM_ID", "CPT_CD"]
CPT_EDGE = [*CPT_KEYS, "SECTIONHEADER", "SUBSECTIONHEADER"]
CPT_DUPLICATE_KEYS = ["HADM_ID", "CPT_CD"]
ICD_EDGE = ["SUBJECT_ID", "HADM_ID", "ICD9_CODE"]
ICD_DUPLICATE_KEYS = ["HADM_ID", "ICD9_CODE"]
MV_KEYS = ["HADM_ID", "STARTTIME", "ITEMID"]
MV_DUPLICATE_KEYS = ["HADM_ID", "ITEMID", "VALUE", "CGID", "STARTTIME", "ENDTIME"]
MV_PAIR_KEYS = ["HADM_ID", "SUBJECT_ID", "ITEMID", "VALUE", "CGID"]
FINISHED = "FinishedRunning"
D_CPT_KEYS = ["CATEGORY", "MINCODEINSUBSECTION", "MAXCODEINSUBSECTION"]
D_CPT_HIERARCHY = [
    "CATEGORY", "SECTIONHEADER", "SUBSECTIONHEADER", "MINCODEINSUBSECTION", "MAXCODEINSUBSECTION",
]


def silver_cptevents(bronze: DataFrame) -> DataFrame:
    return drop_columns(bronze, CPT_UNUSED).transform(require_keys, CPT_KEYS)


def gold_cptevents(silver: DataFrame) -> DataFrame:
    """One edge per patient, admission, code and headers, with its frequency."""
    return edge_counts(silver, CPT_EDGE, "TICKET_COUNT")


def silver_procedures_icd(bronze: DataFrame) -> DataFrame:
    return require_keys(bronze, ICD_EDGE)


def gold_procedures_icd(silver: DataFrame) -> DataFrame:
    """One edge per patient, admission and code, with its frequency and first position."""
    return edge_counts(silver, ICD_EDGE, "PROC_COUNT", PRIMARY_SEQ_NUM=F.min("SEQ_NUM"))


def silver_procedureevents_mv(
    bronze: DataFrame, sparse: Sequence[str] | None = None
) -> DataFrame:
    """Without mostly empty columns (never one that later steps need) and rows that lack a key.

    ``sparse`` names the mostly empty columns if they are known; else one pass finds them.
    """
    needed = {*MV_KEYS, *MV_DUPLICATE_KEYS, *MV_PAIR_KEYS, "ROW_ID", "STATUSDESCRIPTION"}
    if sparse is None:
        kept = drop_sparse_columns(bronze, keep=needed)
    else:
        kept = drop_columns(bronze, [c for c in sparse if c not in needed])
    return require_keys(kept, MV_KEYS)


def gold_procedureevents_mv(silver: DataFrame) -> DataFrame:
    """One row per event: a finished one if there is one, else the lowest row id."""
    finished = F.col("STATUSDESCRIPTION") == FINISHED
    return dedup_by_priority(silver, MV_DUPLICATE_KEYS, finished, ["ROW_ID"])


def near_duplicate_events(
    silver: DataFrame, start: str = "STARTTIME", end: str = "ENDTIME"
) -> DataFrame:
    """Pairs of events that agree on their keys and start and end within the same hour."""
    pairs = near_duplicates(
        silver, MV_PAIR_KEYS, "ROW_ID", [start, end], carry=["STATUSDESCRIPTION"]
    )
    names = {"ID": "ROW_ID", "START": start, "END": end}
    sides = [
        column
        for number, side in ((1, "a"), (2, "b"))
        for column in (
            *[F.col(f"{side}.{old}").alias(f"{new}_{number}") for new, old in names.items()],
            F.col("VALUE").alias(f"VAL_{number}"),
        )
    ]
    status = F.col("a.STATUSDESCRIPTION").alias("STATUS")
    return pairs.select("HADM_ID", "ITEMID", "CGID", status, *sides)


def near_duplicate_preview(silver: DataFrame, start: str = "STARTTIME", end: str = "ENDTIME", n: int = 20) -> DataFrame:
    """The first near-duplicate pairs by admission; admissions after them are not paired."""
    order = ["START_1", "ID_1", "ID_2"]
    return first_pairs(silver, lambda rows: near_duplicate_events(rows, start, end), "HADM_ID", order, n)


def gold_d_cpt(bronze: DataFrame) -> DataFrame:
    return require_keys(bronze, D_CPT_KEYS)


def cpt_hierarchy(d_cpt: DataFrame, n: int = 10) -> DataFrame:
    """The first code ranges with their section and subsection."""
    return head_by(d_cpt, D_CPT_HIERARCHY, ["MINCODEINSUBSECTION"], n)


def gold_d_icd_procedures(bronze: DataFrame) -> DataFrame:
    return require_keys(bronze, ["ICD9_CODE"])
