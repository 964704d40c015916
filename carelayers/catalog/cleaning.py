"""Queries for column choices, filters, unions and duplicates removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelayers.catalog.registry import STEPS, register
from carelayers.functions import remap, upper_trim
from carelayers.operators.clean import (
    drop_columns,
    drop_sparse_columns,
    exclude_code,
    lookup,
    project,
    require_keys,
    require_not_null,
    tag,
    typed_nulls,
)
from carelayers.operators.dictionary import one_per_key
from carelayers.operators.fuse import fuse
from carelayers.operators.ranking import dedup_by_priority, first_within, rank_within
from carelayers.operators.repeats import distinct_rows
from carelayers.operators.reports import distinct_values
from carelayers.plans import inputs as input_plans
from carelayers.plans import observations, outputs, procedures
from carelayers.plans.prescriptions import silver_prescriptions

STEPS["step_cpt_clean"] = """
    select ROW_ID, SUBJECT_ID, HADM_ID, CPT_CD, SECTIONHEADER, SUBSECTIONHEADER from in_cptevents
    where SUBJECT_ID is not null and HADM_ID is not null and CPT_CD is not null"""


@register(
    "project_rename",
    """select ROW_ID as chart_row_id, SUBJECT_ID as subject_id, HADM_ID as hadm_id,
       ICUSTAY_ID as icustay_id, ITEMID as item_id, CHARTTIME as chart_time,
       STORETIME as store_time, CGID as caregiver_id, VALUE as value_text, VALUENUM as value_num,
       VALUEUOM as value_unit, WARNING as warning, ERROR as error, RESULTSTATUS as result_status,
       STOPPED as stopped from in_chartevents""",
)
def project_rename(t):
    return project(t.chartevents, observations.CHART_EVENT)


@register(
    "drop_columns",
    """select ROW_ID, SUBJECT_ID, HADM_ID, CPT_CD, SECTIONHEADER, SUBSECTIONHEADER
       from in_cptevents""",
)
def _drop_columns(t):
    return drop_columns(t.cptevents, [*procedures.CPT_UNUSED, "NOT_A_COLUMN"])


@register(
    "drop_sparse_columns",
    """select ROW_ID, SUBJECT_ID, HADM_ID, ITEMID, VALUE, CGID, STARTTIME, ENDTIME, RAW_START,
       RAW_END, STATUSDESCRIPTION, LOCATION from in_procedureevents_mv""",
)
def _drop_sparse_columns(t):
    return drop_sparse_columns(t.procedureevents_mv)


@register(
    "require_keys",
    """select * from in_procedureevents_mv
       where HADM_ID is not null and STARTTIME is not null and ITEMID is not null""",
)
def _require_keys(t):
    return require_keys(t.procedureevents_mv, procedures.MV_KEYS)


@register(
    "require_not_null",
    """select * from in_inputevents_cv
       where SUBJECT_ID is not null and HADM_ID is not null and ITEMID is not null""",
)
def _require_not_null(t):
    return require_not_null(t.inputevents_cv, input_plans.INPUT_KEYS)


@register(
    "rename_harmonize",
    """select 'cv' as system, ROW_ID, CHARTTIME as EVENT_TIME, cast(null as timestamp) as END_TIME
       from in_inputevents_cv
       union all select 'mv', ROW_ID, STARTTIME, ENDTIME from in_inputevents_mv""",
)
def rename_harmonize(t):
    cv = t.inputevents_cv.withColumnsRenamed(input_plans.CV_TIMES)
    mv = t.inputevents_mv.withColumnsRenamed(input_plans.MV_TIMES)
    sides = [
        tag(cv, system="cv").select("system", "ROW_ID", "EVENT_TIME"),
        tag(mv, system="mv").select("system", "ROW_ID", "EVENT_TIME", "END_TIME"),
    ]
    return fuse(sides, allow_missing=True)


@register("tag_source", "select *, 'CareVue' as SOURCE_SYSTEM from in_inputevents_cv")
def tag_source(t):
    return tag(t.inputevents_cv, SOURCE_SYSTEM=input_plans.CV_SOURCE)


@register(
    "typed_null_column", "select *, cast(null as timestamp) as END_TIME from in_inputevents_cv"
)
def typed_null_column(t):
    return typed_nulls(t.inputevents_cv, END_TIME="timestamp")


@register("exclude_code", "select * from in_d_icd_diagnoses where ICD9_CODE <> '75539'")
def _exclude_code(t):
    return exclude_code(t.d_icd_diagnoses, "ICD9_CODE", outputs.REPLACED_CODE)


@register(
    "remap_code",
    """select ROW_ID, SUBJECT_ID, HADM_ID, SEQ_NUM,
       case when ICD9_CODE = '75539' then '75529' else ICD9_CODE end as ICD9_CODE
       from in_diagnoses_icd""",
)
def remap_code(t):
    return outputs.silver_diagnoses_icd(t.diagnoses_icd)


@register(
    "unit_alias",
    """select ROW_ID, case when VALUEUOM = 'mL' then 'ml' else VALUEUOM end as VALUEUOM
       from in_outputevents""",
)
def unit_alias(t):
    unit = remap(F.col("VALUEUOM"), outputs.UNIT_ALIASES)
    return t.outputevents.select("ROW_ID", unit.alias("VALUEUOM"))


@register(
    "point_lookup",
    """select SUBJECT_ID, HADM_ID, CPT_CD, SECTIONHEADER, SUBSECTIONHEADER,
       count(*) as TICKET_COUNT from step_cpt_clean group by all
       having HADM_ID = 39 and CPT_CD = '9'""",
)
def point_lookup(t):
    edges = procedures.gold_cptevents(procedures.silver_cptevents(t.cptevents))
    return lookup(edges, HADM_ID=39, CPT_CD="9")


STEPS["step_cpt_ranked"] = """
    select *, row_number() over (partition by HADM_ID, CPT_CD order by ROW_ID nulls last,
      SUBJECT_ID nulls last, SECTIONHEADER nulls last, SUBSECTIONHEADER nulls last) as rank
    from step_cpt_clean"""


@register("rank_filter", "select * exclude (rank) from step_cpt_ranked where rank = 1")
def rank_filter(t):
    silver = procedures.silver_cptevents(t.cptevents)
    return first_within(silver, procedures.CPT_DUPLICATE_KEYS, ["ROW_ID"])


@register("rank_duplicates", "select * from step_cpt_ranked")
def rank_duplicates(t):
    silver = procedures.silver_cptevents(t.cptevents)
    return rank_within(silver, procedures.CPT_DUPLICATE_KEYS, ["ROW_ID"])


@register(
    "priority_dedup",
    """select * exclude (n) from (
         select *, row_number() over (
           partition by HADM_ID, ITEMID, VALUE, CGID, STARTTIME, ENDTIME
           order by case when STATUSDESCRIPTION = 'FinishedRunning' then 0 else 1 end, ROW_ID) as n
         from in_procedureevents_mv) where n = 1""",
)
def priority_dedup(t):
    finished = F.col("STATUSDESCRIPTION") == procedures.FINISHED
    return dedup_by_priority(
        t.procedureevents_mv, procedures.MV_DUPLICATE_KEYS, finished, ["ROW_ID"]
    )


STEPS["step_chart_part"] = """
    select 'chartevents' as source_table, ROW_ID, SUBJECT_ID, HADM_ID, ICUSTAY_ID, ITEMID,
      cast(CHARTTIME as timestamp) as CHARTTIME, VALUE from in_chartevents"""
STEPS["step_lab_part"] = """
    select 'labevents' as source_table, ROW_ID, SUBJECT_ID, HADM_ID,
      cast(null as varchar) as ICUSTAY_ID, ITEMID, cast(CHARTTIME as timestamp) as CHARTTIME,
      VALUE from in_labevents"""


@register(
    "union_strict", "select * from step_chart_part union all by name select * from step_lab_part"
)
def union_strict(t):
    common = ["ROW_ID", "SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "ITEMID", "CHARTTIME", "VALUE"]
    chart = tag(t.chartevents, source_table="chartevents").select("source_table", *common)
    lab = tag(typed_nulls(t.labevents, ICUSTAY_ID="string"), source_table="labevents")
    return fuse([chart, lab.select(*reversed(common), "source_table")])


@register(
    "union_missing",
    """select *, cast(null as timestamp) as STARTTIME, cast(null as timestamp) as ENDTIME,
         cast(null as varchar) as ORDERCATEGORYNAME from in_inputevents_cv
       union all by name
       select *, cast(null as timestamp) as CHARTTIME, cast(null as varchar) as ORIGINALROUTE
       from in_inputevents_mv""",
)
def union_missing(t):
    return fuse([t.inputevents_cv, t.inputevents_mv], allow_missing=True)


@register("dedup_full_row", "select distinct * from in_inputevents_cv")
def dedup_full_row(t):
    twice = fuse([t.inputevents_cv, t.inputevents_cv])
    return distinct_rows(twice)


@register(
    "dedup_dictionary",
    """select * exclude (n) from (
         select ITEMID, LABEL, UNITNAME, row_number() over (partition by ITEMID
           order by LABEL nulls last, UNITNAME nulls last) as n from in_d_items) where n = 1""",
)
def dedup_dictionary(t):
    return one_per_key(t.d_items.select("ITEMID", "LABEL", "UNITNAME"), "ITEMID")


@register("distinct_values", "select distinct MEDICATION_NAME from silver_prescriptions")
def _distinct_values(t):
    return distinct_values(silver_prescriptions(t.prescriptions), "MEDICATION_NAME")


@register(
    "unit_upper",
    """select ROW_ID, upper(trim(AMOUNTUOM, ' ')) as AMOUNT_UNIT,
       upper(trim(RATEUOM, ' ')) as RATE_UNIT, upper(trim(ORIGINALROUTE, ' ')) as ROUTE_NORMALIZED
       from in_inputevents_cv""",
)
def unit_upper(t):
    columns = {**input_plans.UNITS, **input_plans.CV_ROUTE}
    return t.inputevents_cv.select(
        "ROW_ID", *[upper_trim(F.col(old)).alias(new) for new, old in columns.items()]
    )
