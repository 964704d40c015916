"""Declared column types of the sixteen input tables.

Codes are strings: inference would read the code ``0331`` as the number 331 and merge it with
``331``. A column that a table has but this list has not stays as it was read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelayers.functions.convert import safe_long

# Column types by table.
SCHEMAS: dict[str, dict[str, str]] = {
    "cptevents": {
        "ROW_ID": "bigint", "SUBJECT_ID": "bigint", "HADM_ID": "bigint", "CPT_CD": "string",
        "SECTIONHEADER": "string", "SUBSECTIONHEADER": "string", "CPT_SUFFIX": "string",
        "DESCRIPTION": "string",
    },
    "procedures_icd": {
        "ROW_ID": "bigint", "SUBJECT_ID": "bigint", "HADM_ID": "bigint", "SEQ_NUM": "bigint",
        "ICD9_CODE": "string",
    },
    "procedureevents_mv": {
        "ROW_ID": "bigint", "SUBJECT_ID": "bigint", "HADM_ID": "bigint", "ITEMID": "string",
        "VALUE": "double", "CGID": "bigint", "STARTTIME": "timestamp", "ENDTIME": "timestamp",
        "STATUSDESCRIPTION": "string",
    },
    "d_cpt": {
        "CATEGORY": "int", "SECTIONHEADER": "string", "SUBSECTIONHEADER": "string",
        "MINCODEINSUBSECTION": "bigint", "MAXCODEINSUBSECTION": "bigint",
    },
    "d_icd_procedures": {
        "ROW_ID": "bigint", "ICD9_CODE": "string", "SHORT_TITLE": "string", "LONG_TITLE": "string",
    },
    "outputevents": {
        "ROW_ID": "bigint", "SUBJECT_ID": "bigint", "HADM_ID": "bigint", "ICUSTAY_ID": "bigint",
        "ITEMID": "string", "CHARTTIME": "string", "STORETIME": "string", "VALUE": "double",
        "VALUEUOM": "string",
    },
    "diagnoses_icd": {
        "ROW_ID": "bigint", "SUBJECT_ID": "bigint", "HADM_ID": "bigint", "SEQ_NUM": "bigint",
        "ICD9_CODE": "string",
    },
    "d_icd_diagnoses": {
        "ROW_ID": "bigint", "ICD9_CODE": "string", "SHORT_TITLE": "string", "LONG_TITLE": "string",
    },
    # The five tables of the observation fusion stay text on read and are converted on use.
    "chartevents": {},
    "d_items": {},
    "labevents": {},
    "d_labitems": {},
    "microbiologyevents": {},
    "inputevents_cv": {
        "ROW_ID": "bigint", "SUBJECT_ID": "bigint", "HADM_ID": "bigint", "ITEMID": "string",
        "CHARTTIME": "timestamp", "AMOUNT": "double", "AMOUNTUOM": "string", "RATE": "double",
        "RATEUOM": "string", "ORIGINALROUTE": "string",
    },
    "inputevents_mv": {
        "ROW_ID": "bigint", "SUBJECT_ID": "bigint", "HADM_ID": "bigint", "ITEMID": "string",
        "STARTTIME": "timestamp", "ENDTIME": "timestamp", "AMOUNT": "double",
        "AMOUNTUOM": "string", "RATE": "double", "RATEUOM": "string",
        "ORDERCATEGORYNAME": "string",
    },
    "prescriptions": {
        "ROW_ID": "bigint", "SUBJECT_ID": "bigint", "HADM_ID": "bigint", "ICUSTAY_ID": "bigint",
        "STARTDATE": "timestamp", "ENDDATE": "timestamp", "DRUG_TYPE": "string", "DRUG": "string",
        "DRUG_NAME_POE": "string", "DRUG_NAME_GENERIC": "string", "FORMULARY_DRUG_CD": "string",
        "GSN": "string", "NDC": "string", "PROD_STRENGTH": "string", "DOSE_VAL_RX": "string",
        "DOSE_UNIT_RX": "string", "FORM_UNIT_DISP": "string", "ROUTE": "string",
    },
}


def _converted(column: str, kind: str) -> Column:
    value = F.col(column)
    whole = kind in ("int", "bigint")
    return (safe_long(value) if whole else value).try_cast(kind).alias(column)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Convert the declared columns that ``df`` has, by name; text that does not parse gives NULL."""
    types = SCHEMAS[table]
    return df.select(*[_converted(c, types[c]) if c in types else F.col(c) for c in df.columns])
