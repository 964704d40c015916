"""Queries for profiles, frequencies, duplicate reports and top lists."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from carelayers.catalog.registry import STEPS, register, rounded
from carelayers.operators.fuse import fuse
from carelayers.operators.ranking import duplicate_rows, rank_within
from carelayers.operators.reports import (
    bucket_stats,
    compare_counts,
    compare_rows,
    distinct_count,
    duplicate_groups,
    duplicate_summary,
    exact_duplicate_count,
    null_profile,
    reconcile,
    top_groups,
)
from carelayers.operators.rollup import edge_counts, representative
from carelayers.plans import inputs as input_plans
from carelayers.plans import prescriptions as rx
from carelayers.plans import procedures
from carelayers.sources.layers import as_view

_MV_COLUMNS = [
    "ROW_ID", "SUBJECT_ID", "HADM_ID", "ITEMID", "VALUE", "CGID", "STARTTIME", "ENDTIME",
    "RAW_START", "RAW_END", "STATUSDESCRIPTION", "COMMENTS_DATE", "LOCATION",
]


@register(
    "null_profile",
    """select "column", null_count, total, null_count * 100.0::double / total as null_pct,
         null_count > 0 as flagged from ("""
    + " union all ".join(
        f"""select '{c}' as "column", count(*) - count({c}) as null_count, count(*) as total
            from in_procedureevents_mv"""
        for c in _MV_COLUMNS
    )
    + ")",
)
def _null_profile(t):
    return null_profile(t.procedureevents_mv)


@register(
    "edge_frequency",
    """select SUBJECT_ID, HADM_ID, CPT_CD, SECTIONHEADER, SUBSECTIONHEADER,
       count(*) as TICKET_COUNT from in_cptevents group by all""",
)
def edge_frequency(t):
    return edge_counts(t.cptevents, procedures.CPT_EDGE, "TICKET_COUNT")


@register(
    "edge_frequency_min",
    """select SUBJECT_ID, HADM_ID, ICD9_CODE, count(*) as PROC_COUNT,
       min(SEQ_NUM) as PRIMARY_SEQ_NUM from in_procedures_icd group by all""",
)
def edge_frequency_min(t):
    return edge_counts(
        t.procedures_icd, procedures.ICD_EDGE, "PROC_COUNT", PRIMARY_SEQ_NUM=F.min("SEQ_NUM")
    )


@register(
    "bucket_stats",
    """select round(avg(n), 8) as avg_rows, max(n) as max_rows, min(n) as min_rows,
         round(stddev_samp(n), 8) as stddev_rows, count(*) filter (n > 1) as repeated_buckets
       from (select HADM_ID, count(*) as n from in_procedureevents_mv group by HADM_ID)""",
)
def _bucket_stats(t):
    return rounded(bucket_stats(t.procedureevents_mv, "HADM_ID"), "avg_rows", "stddev_rows")


STEPS["step_icd_repeated"] = """
    select HADM_ID, ICD9_CODE, count(*) as count from silver_procedures_icd
    group by all having count(*) > 1"""


@register("duplicate_groups", "select * from step_icd_repeated")
def _duplicate_groups(t):
    silver = procedures.silver_procedures_icd(t.procedures_icd)
    return duplicate_groups(silver, procedures.ICD_DUPLICATE_KEYS)


@register(
    "top_duplicate_groups",
    """select * from step_icd_repeated order by count desc, HADM_ID nulls first,
       ICD9_CODE nulls first limit 5""",
)
def top_duplicate_groups(t):
    silver = procedures.silver_procedures_icd(t.procedures_icd)
    return top_groups(silver, procedures.ICD_DUPLICATE_KEYS, 5, min_count=2)


@register(
    "top_buckets",
    """select HADM_ID, count(*) as count from in_procedureevents_mv group by HADM_ID
       order by count desc, HADM_ID nulls first limit 10""",
)
def top_buckets(t):
    return top_groups(t.procedureevents_mv, ["HADM_ID"], 10)


@register(
    "duplicate_summary",
    """select count(*) as total_rows, count(*) filter (rank = 1) as unique_rows,
         count(*) filter (rank > 1) as duplicate_rows,
         count(*) filter (rank > 1) * 100.0::double / count(*) as duplicate_pct
       from step_cpt_ranked""",
)
def _duplicate_summary(t):
    silver = procedures.silver_cptevents(t.cptevents)
    return duplicate_summary(silver, procedures.CPT_DUPLICATE_KEYS)


SQL_SHOWCASE = """select * from step_cpt_ranked
       qualify count(*) over (partition by HADM_ID, CPT_CD) > 1"""


@register("duplicate_showcase", SQL_SHOWCASE)
def duplicate_showcase(t):
    silver = procedures.silver_cptevents(t.cptevents)
    return duplicate_rows(silver, procedures.CPT_DUPLICATE_KEYS, ["ROW_ID"])


def _ranked_cpt(t):
    silver = procedures.silver_cptevents(t.cptevents)
    return rank_within(silver, procedures.CPT_DUPLICATE_KEYS, ["ROW_ID"])


@register("sql_view", "select HADM_ID, count(*) as n from step_cpt_ranked group by HADM_ID")
def sql_view(t):
    name = f"ranked_cpt_{uuid.uuid4().hex}"
    as_view(_ranked_cpt(t), name)
    return t.spark.sql(f"select HADM_ID, count(*) as n from {name} group by HADM_ID")


@register(
    "sql_rank_sample",
    """select HADM_ID, CPT_CD from step_cpt_ranked where rank = 2
       order by HADM_ID, CPT_CD limit 1""",
)
def sql_rank_sample(t):
    return t.spark.sql(
        "select HADM_ID, CPT_CD from {ranked} where rank = 2 order by HADM_ID, CPT_CD limit 1",
        ranked=_ranked_cpt(t),
    )


@register(
    "sql_group_rows",
    """select rank, HADM_ID, CPT_CD, SECTIONHEADER, SUBSECTIONHEADER, ROW_ID
       from step_cpt_ranked where HADM_ID = 39 and CPT_CD = '9' order by rank""",
)
def sql_group_rows(t):
    return t.spark.sql(
        """select rank, HADM_ID, CPT_CD, SECTIONHEADER, SUBSECTIONHEADER, ROW_ID
           from {ranked} where HADM_ID = :admission and CPT_CD = :code order by rank""",
        args={"admission": 39, "code": "9"},
        ranked=_ranked_cpt(t),
    )


@register(
    "first_non_null",
    """select SUBJECT_ID, HADM_ID, ITEMID,
         first(AMOUNTUOM order by CHARTTIME, ROW_ID) filter (AMOUNTUOM is not null) as AMOUNTUOM,
         first(ORIGINALROUTE order by CHARTTIME, ROW_ID) filter (ORIGINALROUTE is not null)
           as ORIGINALROUTE
       from in_inputevents_cv group by all""",
)
def first_non_null(t):
    order = ["CHARTTIME", "ROW_ID"]
    names = ("AMOUNTUOM", "ORIGINALROUTE")
    return t.inputevents_cv.groupBy(*input_plans.INPUT_KEYS).agg(
        *[representative(c, order).alias(c) for c in names]
    )


SQL_RECONCILE = """select s.n as silver_rows, g.n as gold_total, s.n - g.n as difference
       from (select count(*) as n from silver_prescriptions) s,
         (select cast(sum(PRESCRIPTION_COUNT) as bigint) as n from gold_prescriptions) g"""


@register("reconcile_counts", SQL_RECONCILE)
def reconcile_counts(t):
    silver = rx.silver_prescriptions(t.prescriptions)
    return reconcile(silver, rx.gold_prescriptions(silver), "PRESCRIPTION_COUNT")


@register(
    "distinct_count",
    """select count(*) as distinct_with_null, count(MEDICATION_CODE) as distinct_not_null
       from (select distinct MEDICATION_CODE from silver_prescriptions)""",
)
def _distinct_count(t):
    return distinct_count(rx.silver_prescriptions(t.prescriptions), "MEDICATION_CODE")


@register(
    "exact_duplicate_count",
    """select a.n as total_rows, b.n as distinct_rows, a.n - b.n as duplicate_rows
       from (select count(*) as n from (
           select * from in_outputevents union all select * from in_outputevents)) a,
         (select count(*) as n from (select distinct * from in_outputevents)) b""",
)
def _exact_duplicate_count(t):
    return exact_duplicate_count(fuse([t.outputevents, t.outputevents]))


@register(
    "hierarchy_sample",
    """select CATEGORY, SECTIONHEADER, SUBSECTIONHEADER, MINCODEINSUBSECTION, MAXCODEINSUBSECTION
       from in_d_cpt order by MINCODEINSUBSECTION nulls first limit 10""",
)
def hierarchy_sample(t):
    return procedures.cpt_hierarchy(t.d_cpt)


STEPS["step_near_pairs"] = """
    select a.HADM_ID, a.ITEMID, a.CGID, a.STATUSDESCRIPTION as STATUS, a.ROW_ID as ID_1,
      a.RAW_START as START_1, a.RAW_END as END_1, a.VALUE as VAL_1, b.ROW_ID as ID_2,
      b.RAW_START as START_2, b.RAW_END as END_2, b.VALUE as VAL_2
    from in_procedureevents_mv a join in_procedureevents_mv b
      on a.HADM_ID = b.HADM_ID and a.SUBJECT_ID = b.SUBJECT_ID and a.ITEMID = b.ITEMID
      and a.VALUE = b.VALUE and a.CGID = b.CGID and a.ROW_ID < b.ROW_ID
    where abs(epoch(date_trunc('second', a.RAW_START))
        - epoch(date_trunc('second', b.RAW_START))) < 3600
      and abs(epoch(date_trunc('second', a.RAW_END))
        - epoch(date_trunc('second', b.RAW_END))) < 3600"""


@register("near_duplicate_pairs", "select * from step_near_pairs")
def near_duplicate_pairs(t):
    return procedures.near_duplicate_events(t.procedureevents_mv, "RAW_START", "RAW_END")


@register(
    "pair_preview",
    "select * from step_near_pairs order by HADM_ID, START_1, ID_1, ID_2 limit 20",
)
def pair_preview(t):
    return procedures.near_duplicate_preview(t.procedureevents_mv, "RAW_START", "RAW_END")


SQL_COMPARE = """select s.HADM_ID, s.n as rows_before, coalesce(g.n, 0) as rows_after,
         s.n - coalesce(g.n, 0) as removed
       from (select HADM_ID, count(*) as n from silver_procedureevents_mv group by HADM_ID) s
       left join (select HADM_ID, count(*) as n from gold_procedureevents_mv group by HADM_ID) g
         on s.HADM_ID = g.HADM_ID"""


@register("ordered_compare", SQL_COMPARE)
def ordered_compare(t):
    silver = procedures.silver_procedureevents_mv(t.procedureevents_mv)
    return compare_counts(silver, procedures.gold_procedureevents_mv(silver), "HADM_ID")


@register(
    "ordered_compare_rows",
    """select 'before' as layer, ROW_ID, ITEMID, STARTTIME, ENDTIME, VALUE, STATUSDESCRIPTION
       from silver_procedureevents_mv where HADM_ID = 8
       union all
       select 'after', ROW_ID, ITEMID, STARTTIME, ENDTIME, VALUE, STATUSDESCRIPTION
       from gold_procedureevents_mv where HADM_ID = 8""",
)
def ordered_compare_rows(t):
    silver = procedures.silver_procedureevents_mv(t.procedureevents_mv)
    gold = procedures.gold_procedureevents_mv(silver)
    shown = ["ROW_ID", "ITEMID", "STARTTIME", "ENDTIME", "VALUE", "STATUSDESCRIPTION"]
    return compare_rows(silver, gold, "HADM_ID", 8, shown, ["STARTTIME", "ROW_ID"])
