"""Hospital-shaped inputs derived from whole test tables.

Each is one SELECT that Spark and DuckDB both run. Every row of a source table is used. NULLs,
untidy text, hot codes and codes without a match come from arithmetic on the ids, in the columns,
never in a filter; repeated rows come from taking a whole table twice.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from carelayers.sources.raw import spread

_LINE_ID = "((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey"

INPUTS: dict[str, str] = {
    "cptevents": f"""
        select {_LINE_ID} as ROW_ID, l_suppkey as SUBJECT_ID,
          case when l_orderkey % 13 = 0 then null else l_orderkey % 50 end as HADM_ID,
          cast(l_partkey % 20 as varchar(10)) as CPT_CD, l_returnflag as SECTIONHEADER,
          case when l_linenumber = 3 then null else l_linestatus end as SUBSECTIONHEADER,
          cast(null as varchar(5)) as CPT_SUFFIX,
          case when l_linenumber = 1 then 'd' else null end as DESCRIPTION
        from {{lineitem}}""",
    "procedures_icd": """
        select o_orderkey as ROW_ID, o_custkey % 100 as SUBJECT_ID,
          (o_custkey % 100) * 3 + o_orderkey % 3 as HADM_ID, o_orderkey % 9 + 1 as SEQ_NUM,
          case when o_custkey % 60 = 59 then null
            else lpad(cast(o_custkey % 12 as varchar(10)), 4, '0') end as ICD9_CODE
        from {orders}""",
    "procedureevents_mv": """
        select event_id as ROW_ID, user_id as SUBJECT_ID,
          case when event_id % 29 = 0 then null else user_id end as HADM_ID,
          event_type as ITEMID, cast(floor(value / 20) as int) as VALUE, event_id % 2 as CGID,
          cast(cast(ts as date) as timestamp) as STARTTIME,
          case when event_id % 8 = 0 then null
            else cast(cast(ts as date) as timestamp) + interval 30 minutes end as ENDTIME,
          ts as RAW_START, ts + interval 30 minutes as RAW_END,
          case event_id % 3 when 0 then 'FinishedRunning' when 1 then 'Stopped'
            else 'Paused' end as STATUSDESCRIPTION,
          case when event_id % 10 < 7 then null else 'x' end as COMMENTS_DATE,
          case when event_id % 10 < 5 then null else 'loc' end as LOCATION
        from {events}""",
    "d_cpt": """
        select case when p_partkey % 11 = 0 then null else p_size end as CATEGORY,
          p_type as SECTIONHEADER, p_name as SUBSECTIONHEADER,
          p_partkey * 10 as MINCODEINSUBSECTION,
          case when p_partkey % 13 = 0 then null else p_partkey * 10 + 9 end
            as MAXCODEINSUBSECTION
        from {part}""",
    "d_icd_procedures": """
        select p_partkey as ROW_ID,
          case when p_partkey % 9 = 0 then null
            else lpad(cast(p_partkey as varchar(10)), 6, '0') end as ICD9_CODE,
          p_name as SHORT_TITLE, concat(p_name, ' ', p_type) as LONG_TITLE
        from {part}""",
    "outputevents": """
        select event_id as ROW_ID, user_id as SUBJECT_ID,
          case when event_id % 23 = 0 then null else user_id % 7 end as HADM_ID,
          case when event_id % 3 = 0 then null else event_id % 11 end as ICUSTAY_ID,
          event_type as ITEMID, cast(date_trunc('second', ts) as varchar(30)) as CHARTTIME,
          case event_id % 7 when 0 then null when 1 then 'pending'
            else cast(date_trunc('second', ts + interval 30 minutes) as varchar(30)) end
            as STORETIME,
          value as VALUE,
          case event_id % 3 when 0 then 'mL' when 1 then 'ml' else null end as VALUEUOM
        from {events}""",
    # One code holds a third of the rows; 75539 is a second spelling of 75529.
    "diagnoses_icd": """
        select o_orderkey as ROW_ID, o_custkey as SUBJECT_ID, o_orderkey as HADM_ID,
          o_orderkey % 9 as SEQ_NUM,
          case when o_custkey % 60 = 59 then null
            when o_custkey % 60 = 58 then concat('V', cast(o_custkey as varchar(10)))
            when o_custkey % 3 = 1 then '75507'
            else cast(75500 + o_custkey % 60 as varchar(10)) end as ICD9_CODE
        from {orders}""",
    "d_icd_diagnoses": """
        select p_partkey as ROW_ID, cast(75500 + p_partkey as varchar(10)) as ICD9_CODE,
          p_name as SHORT_TITLE,
          concat(' - ', p_name, ', <', p_type, '>  (', p_brand, ') 50% + é') as LONG_TITLE
        from {part}""",
    "chartevents": f"""
        select cast({_LINE_ID} as varchar(30)) as ROW_ID,
          cast(l_suppkey as varchar(20)) as SUBJECT_ID,
          case when l_linenumber = 7 then null else cast(l_orderkey as varchar(20)) end as HADM_ID,
          cast(l_orderkey % 100 as varchar(20)) as ICUSTAY_ID,
          cast(l_partkey as varchar(20)) as ITEMID, l_shipdate as CHARTTIME,
          case when l_linenumber = 2 then null else l_shipdate + interval 90 minutes end
            as STORETIME,
          cast(l_linenumber as varchar(20)) as CGID, l_returnflag as VALUE,
          case when l_returnflag = 'N' and l_linenumber = 1 then 'n/a'
            else concat(' ', cast(cast(l_quantity as int) as varchar(20)), ' ') end as VALUENUM,
          case when l_linestatus = 'F' then null else ' mg [per] (serum)  dL' end as VALUEUOM,
          case when l_tax > 0.05 then '1' else null end as WARNING,
          cast(null as varchar(5)) as ERROR, l_returnflag as RESULTSTATUS,
          l_linestatus as STOPPED
        from {{lineitem}}""",
    # Every item three times, once without a label; items whose number ends in 0 are listed under another code.
    "d_items": """
        select case when p_partkey % 10 = 0 then concat('X', cast(p_partkey as varchar(20)))
            else cast(p_partkey as varchar(20)) end as ITEMID,
          concat(p_name, ' [', p_brand, ']  (', p_type, ')') as LABEL, p_brand as ABBREVIATION,
          'carevue' as DBSOURCE, 'chartevents' as LINKSTO, p_type as CATEGORY,
          case p_size % 3 when 0 then 'mL (fluid)' when 1 then null else 'mg' end as UNITNAME,
          case when p_size % 2 = 0 then 'Numeric' else 'Text' end as PARAM_TYPE,
          cast(null as varchar(5)) as CONCEPTID
        from {part}
        union all
        select case when p_partkey % 10 = 0 then concat('X', cast(p_partkey as varchar(20)))
            else cast(p_partkey as varchar(20)) end,
          upper(p_name), p_brand, 'metavision', 'chartevents', p_type, 'dup', 'Text',
          cast(null as varchar(5))
        from {part}
        union all
        select case when p_partkey % 10 = 0 then concat('X', cast(p_partkey as varchar(20)))
            else cast(p_partkey as varchar(20)) end,
          cast(null as varchar(5)), cast(null as varchar(5)), 'carevue', 'chartevents', p_type,
          cast(null as varchar(5)), 'Text', cast(null as varchar(5))
        from {part}""",
    "labevents": """
        select cast(event_id as varchar(20)) as ROW_ID, cast(user_id as varchar(20)) as SUBJECT_ID,
          case when event_id % 4 = 0 then null else cast(user_id % 7 as varchar(20)) end as HADM_ID,
          case when event_id % 10 = 9 then concat('U', cast(event_id % 50 as varchar(20)))
            else cast(event_id % 50 as varchar(20)) end as ITEMID,
          ts as CHARTTIME, props as VALUE,
          case when event_id % 10 = 0 then 'NEG' else cast(event_id % 300 as varchar(20)) end
            as VALUENUM,
          case when event_id % 5 = 0 then null else ' K/uL (auto) ' end as VALUEUOM,
          case when event_id % 6 = 0 then 'abnormal' else null end as FLAG
        from {events}""",
    "d_labitems": """
        select cast(p_partkey as varchar(20)) as ITEMID,
          concat(p_name, ' (', p_type, ')') as LABEL, p_brand as FLUID, p_type as CATEGORY,
          concat('L', cast(p_size as varchar(5))) as LOINC_CODE
        from {part}""",
    "microbiologyevents": """
        select doc_id as ROW_ID, doc_id % 20 as SUBJECT_ID,
          case when doc_id % 7 = 0 then null else doc_id % 90 end as HADM_ID,
          case when doc_id % 3 = 0 then null else timestamp '2024-01-01 10:00:00' end as CHARTTIME,
          timestamp '2024-01-01 00:00:00' as CHARTDATE,
          cast(doc_id % 60 as varchar(10)) as SPEC_ITEMID, text as SPEC_TYPE_DESC,
          cast(doc_id % 40 as varchar(10)) as ORG_ITEMID, concat(source, ' [x]') as ORG_NAME,
          cast(doc_id % 4 as varchar(10)) as ISOLATE_NUM,
          cast(doc_id % 30 as varchar(10)) as AB_ITEMID, upper(lang) as AB_NAME,
          case when doc_id % 4 = 0 then '<=16' else cast(n_chars as varchar(20)) end
            as DILUTION_TEXT,
          case when doc_id % 4 = 0 then '<=' else '=' end as DILUTION_COMPARISON,
          case when doc_id % 4 = 0 then '<=16' else cast(n_chars as varchar(20)) end
            as DILUTION_VALUE,
          case when doc_id % 5 = 0 then null else 'S' end as INTERPRETATION
        from {documents}""",
    "inputevents_cv": """
        select event_id as ROW_ID, user_id as SUBJECT_ID,
          case when event_id % 31 = 0 then null else user_id % 7 end as HADM_ID,
          event_type as ITEMID, case when event_id % 41 = 0 then null else ts end as CHARTTIME,
          value as AMOUNT,
          case when event_id % 3 = 0 then ' ml' when event_id % 3 = 1 then null
            else 'ML ' end as AMOUNTUOM,
          case when event_id % 5 = 0 then null else value / 10 end as RATE,
          case when event_id % 4 = 0 then null else 'ml/hr' end as RATEUOM,
          case when event_id % 6 = 0 then null else concat(' ', event_type, ' drip') end
            as ORIGINALROUTE
        from {events}""",
    "inputevents_mv": """
        select event_id as ROW_ID, user_id as SUBJECT_ID,
          case when event_id % 37 = 0 then null else user_id % 7 end as HADM_ID,
          event_type as ITEMID, case when event_id % 43 = 0 then null else ts end as STARTTIME,
          case when event_id % 9 = 0 then null else ts + interval 45 minutes end as ENDTIME,
          value as AMOUNT, 'mg' as AMOUNTUOM, value / 10 as RATE, 'mg/min' as RATEUOM,
          case when event_id % 5 = 1 then null else upper(event_type) end as ORDERCATEGORYNAME
        from {events}""",
    "prescriptions": f"""
        select {_LINE_ID} as ROW_ID, o_custkey as SUBJECT_ID,
          case when o_orderkey % 17 = 0 then null else o_orderkey % 10 end as HADM_ID,
          l_orderkey % 7 as ICUSTAY_ID, p_type as DRUG_TYPE, p_name as DRUG,
          case when l_linenumber % 2 = 0 then concat(' ', p_name, ' poe ') else null end
            as DRUG_NAME_POE,
          case when l_linenumber % 3 = 0 then p_brand else null end as DRUG_NAME_GENERIC,
          case when p_size % 4 = 0 then null else concat('F', cast(p_size as varchar(5))) end
            as FORMULARY_DRUG_CD,
          case when p_size % 3 = 0 then null else concat('G', cast(p_size as varchar(5))) end as GSN,
          case when p_size % 2 = 0 then null else l_partkey end as NDC,
          case when p_size % 7 = 0 then null else p_brand end as PROD_STRENGTH,
          case p_size % 5 when 0
              then concat(cast(p_size as varchar(5)), '-', cast(p_size + 1 as varchar(5)))
            when 1 then 'per protocol' when 2 then concat(cast(p_size as varchar(5)), '.5 mg')
            else cast(p_size as varchar(5)) end as DOSE_VAL_RX,
          case when p_size % 5 = 1 then null else 'mg' end as DOSE_UNIT_RX,
          case when l_linenumber = 4 then null else 'TAB' end as FORM_UNIT_DISP,
          lower(concat(' ', p_type)) as ROUTE,
          case when l_linenumber = 6 then null else o_orderdate end as STARTDATE,
          case when l_linenumber = 5 then null else l_shipdate end as ENDDATE
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
          join {{part}} on l_partkey = p_partkey""",
}

_TABLE = re.compile(r"\{(\w+)\}")


def input_frame(
    spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False
) -> DataFrame:
    """The input as a lazy DataFrame over the Parquet files in ``sf_dir``.

    ``spread_rows`` uses all cores for the table the rows come from (the first one named), even if
    its file cannot be split.
    """
    folder = str(sf_dir).rstrip("/")
    names = list(dict.fromkeys(_TABLE.findall(INPUTS[name])))
    tables = {table: spark.read.parquet(f"{folder}/{table}.parquet") for table in names}
    if spread_rows:
        tables[names[0]] = spread(tables[names[0]])
    return spark.sql(INPUTS[name], **tables)


def input_sql(name: str) -> str:
    """The same SELECT over tables of the same names."""
    return _TABLE.sub(r"\1", INPUTS[name])
