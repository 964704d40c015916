"""Queries for single column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelayers.catalog.registry import STEPS, register
from carelayers.functions import (
    clean_text,
    dose_numeric,
    duration_hours,
    event_flag,
    normalize_title,
    observation_id,
    parse_timestamp,
    safe_double,
    safe_long,
)
from carelayers.operators.fuse import fuse
from carelayers.operators.clean import tag
from carelayers.operators.dictionary import enrich
from carelayers.plans.outputs import TIME_FORMAT
from carelayers.plans.prescriptions import medication_code as code_of
from carelayers.plans.prescriptions import medication_name as name_of


def sql_clean(column: str) -> str:
    return (
        "lower(trim(regexp_replace(regexp_replace(regexp_replace("
        rf"{column}, '\[[^\]]*\]', '', 'g'), '\([^)]*\)', '', 'g'), '\s+', ' ', 'g'), ' '))"
    )


def sql_title(column: str) -> str:
    return (
        "regexp_replace(regexp_replace("
        rf"trim(lower({column}), ' '), '[^\w\s<>+]', '', 'g'), '\s+', ' ', 'g')"
    )


@register(
    "clean_text",
    f"""select 'document' as kind, cast(ROW_ID as varchar) as id,
          {sql_clean("SPEC_TYPE_DESC")} as cleaned from in_microbiologyevents
        union all select 'item', ITEMID, {sql_clean("LABEL")} from in_d_items
        union all select 'unit', ROW_ID, {sql_clean("VALUEUOM")} from in_chartevents""",
)
def _clean_text(t):
    def cleaned(df, kind, key, column):
        text = clean_text(F.col(column)).alias("cleaned")
        return df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), text)

    return fuse(
        [
            cleaned(t.spread("microbiologyevents"), "document", "ROW_ID", "SPEC_TYPE_DESC"),
            cleaned(t.d_items, "item", "ITEMID", "LABEL"),
            cleaned(t.chartevents, "unit", "ROW_ID", "VALUEUOM"),
        ]
    )


@register(
    "normalize_title",
    f"""select 'title' as kind, ROW_ID, {sql_title("LONG_TITLE")} as title from in_d_icd_diagnoses
        union all
        select 'document', ROW_ID, {sql_title("SPEC_TYPE_DESC")} from in_microbiologyevents""",
)
def _normalize_title(t):
    def titles(df, kind, column):
        return df.select(
            F.lit(kind).alias("kind"), "ROW_ID", normalize_title(F.col(column)).alias("title")
        )

    return fuse(
        [
            titles(t.d_icd_diagnoses, "title", "LONG_TITLE"),
            titles(t.spread("microbiologyevents"), "document", "SPEC_TYPE_DESC"),
        ]
    )


@register(
    "safe_double",
    """select ROW_ID, VALUENUM, try_cast(trim(VALUENUM, ' ') as double) as value_num
       from in_chartevents""",
)
def _safe_double(t):
    return t.chartevents.select(
        "ROW_ID", "VALUENUM", safe_double(F.col("VALUENUM")).alias("value_num")
    )


@register(
    "medication_name",
    """select ROW_ID, upper(trim(coalesce(DRUG_NAME_GENERIC, DRUG_NAME_POE, DRUG), ' '))
       as MEDICATION_NAME from in_prescriptions""",
)
def medication_name(t):
    return t.prescriptions.select("ROW_ID", name_of().alias("MEDICATION_NAME"))


@register(
    "medication_code",
    """select ROW_ID, coalesce(cast(NDC as varchar), GSN, FORMULARY_DRUG_CD) as MEDICATION_CODE
       from in_prescriptions""",
)
def medication_code(t):
    return t.prescriptions.select("ROW_ID", code_of().alias("MEDICATION_CODE"))


@register(
    "dose_numeric",
    r"""select ROW_ID, DOSE_VAL_RX,
        try_cast(regexp_extract(DOSE_VAL_RX, '(\d+\.?\d*)', 1) as double) as DOSE_NUMERIC
        from in_prescriptions""",
)
def _dose_numeric(t):
    dose = dose_numeric(F.col("DOSE_VAL_RX")).alias("DOSE_NUMERIC")
    return t.prescriptions.select("ROW_ID", "DOSE_VAL_RX", dose)


STEPS["step_duration"] = """
    select ROW_ID, (epoch(date_trunc('second', ENDDATE)) - epoch(date_trunc('second', STARTDATE)))
      / 3600.0::double as DURATION_HOURS from in_prescriptions"""


@register("duration_hours", "select ROW_ID, DURATION_HOURS from step_duration")
def _duration_hours(t):
    hours = duration_hours(F.col("STARTDATE"), F.col("ENDDATE"))
    return t.prescriptions.select("ROW_ID", hours.alias("DURATION_HOURS"))


STEPS["step_identity"] = """
    select *, sha256(concat_ws('||', source_table, ROW_ID, SUBJECT_ID,
      coalesce(HADM_ID, 'NO_HADM'), coalesce(ITEMID, 'NO_ITEM'),
      coalesce(cast(CHARTTIME as varchar), 'NO_TIME'))) as observation_id
    from (select * from step_chart_part union all by name select * from step_lab_part)"""


@register("observation_id", "select source_table, ROW_ID, observation_id from step_identity")
def _observation_id(t):
    sides = [
        tag(events.select("ROW_ID", "SUBJECT_ID", "HADM_ID", "ITEMID", "CHARTTIME"), source_table=s)
        for s, events in (("chartevents", t.chartevents), ("labevents", t.labevents))
    ]
    parts = ["source_table", "ROW_ID", "SUBJECT_ID", "HADM_ID", "ITEMID"]
    time = parse_timestamp(F.col("CHARTTIME"))
    identity = observation_id(*[F.col(c) for c in parts], time)
    return fuse(sides).select("source_table", "ROW_ID", identity.alias("observation_id"))


@register(
    "event_flag",
    """select ROW_ID, 'warning=' || coalesce(WARNING, '') || '|error=' || coalesce(ERROR, '')
       || '|result_status=' || coalesce(RESULTSTATUS, '') || '|stopped=' || coalesce(STOPPED, '')
       as event_flag from in_chartevents""",
)
def _event_flag(t):
    flag = event_flag(
        warning=F.col("WARNING"),
        error=F.col("ERROR"),
        result_status=F.col("RESULTSTATUS"),
        stopped=F.col("STOPPED"),
    )
    return t.chartevents.select("ROW_ID", flag.alias("event_flag"))


@register(
    "event_time",
    "select ROW_ID, coalesce(CHARTTIME, CHARTDATE) as event_time from in_microbiologyevents",
)
def event_time(t):
    return t.microbiologyevents.select(
        "ROW_ID", F.coalesce("CHARTTIME", "CHARTDATE").alias("event_time")
    )


STEPS["step_item"] = """
    select * exclude (n) from (
      select *, row_number() over (partition by ITEMID order by LABEL nulls last,
        ABBREVIATION nulls last, DBSOURCE nulls last, LINKSTO nulls last,
        CATEGORY nulls last, UNITNAME nulls last, PARAM_TYPE nulls last,
        CONCEPTID nulls last) as n from in_d_items) where n = 1"""


@register(
    "value_unit",
    """select c.ROW_ID, coalesce(c.VALUEUOM, d.UNITNAME) as value_unit
       from in_chartevents c left join (
         select ITEMID, min(UNITNAME) as UNITNAME from in_d_items group by ITEMID) d
       on c.ITEMID = d.ITEMID""",
)
def value_unit(t):
    units = t.d_items.groupBy("ITEMID").agg(F.min("UNITNAME").alias("UNITNAME"))
    named = enrich(t.chartevents, units, "ITEMID", dedup=False)
    return named.select("ROW_ID", F.coalesce("VALUEUOM", "UNITNAME").alias("value_unit"))


@register(
    "parse_timestamp",
    """select ROW_ID, STORETIME as text, try_cast(STORETIME as timestamp) as parsed,
       try_cast(STORETIME as timestamp) as parsed_with_format from in_outputevents""",
)
def _parse_timestamp(t):
    text = F.col("STORETIME")
    return t.outputevents.select(
        "ROW_ID",
        text.alias("text"),
        parse_timestamp(text).alias("parsed"),
        parse_timestamp(text, TIME_FORMAT).alias("parsed_with_format"),
    )


@register(
    "cast_ids",
    """select ROW_ID, try_cast(SUBJECT_ID as bigint) as SUBJECT_ID,
       try_cast(HADM_ID as bigint) as HADM_ID, try_cast(ITEMID as bigint) as ITEMID
       from in_labevents""",
)
def cast_ids(t):
    ids = ("SUBJECT_ID", "HADM_ID", "ITEMID")
    return t.labevents.select("ROW_ID", *[safe_long(F.col(c)).alias(c) for c in ids])
