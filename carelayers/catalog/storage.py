"""Queries that write and read back: CSV sources, Parquet layers and the table runner.

Everything is written below the folder the cluster shares, in a new folder per run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from carelayers.catalog.inputs import INPUTS
from carelayers.catalog.registry import Inputs, register, rounded
from carelayers.catalog.reporting import SQL_COMPARE, SQL_RECONCILE, SQL_SHOWCASE
from carelayers.catalog.results import SQL_UNIFIED_INPUTS
from carelayers.plans import procedures
from carelayers.plans.checks import write_reports
from carelayers.plans.runner import run_tables
from carelayers.sources.layers import (
    layer_counts,
    layer_path,
    materialize,
    read_layer,
    shared_folder,
    write_layer,
)
from carelayers.sources.published import publish_layer, read_published
from carelayers.sources.raw import RawFolder, first_rows, read_raw


def _as_csv(df, path: str, compression: str):
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    text.write.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        compression=compression,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


@register(
    "scan_csv_inferred",
    """select cast(ROW_ID as int) as ROW_ID, cast(SUBJECT_ID as int) as SUBJECT_ID,
       cast(HADM_ID as int) as HADM_ID, cast(SEQ_NUM as int) as SEQ_NUM,
       cast(ICD9_CODE as int) as ICD9_CODE from in_procedures_icd""",
)
def scan_csv_inferred(t):
    path = _as_csv(t.procedures_icd, shared_folder(t.spark, "csv"), "none")
    return read_raw(t.spark, path, infer=True)


@register("scan_csv_declared", "select * from in_procedures_icd")
def scan_csv_declared(t):
    path = _as_csv(t.procedures_icd, shared_folder(t.spark, "csv"), "none")
    return read_raw(t.spark, path, table="procedures_icd")


@register(
    "scan_csv_strings",
    "select * replace (cast(CHARTTIME as varchar) as CHARTTIME) from in_labevents",
)
def scan_csv_strings(t):
    path = _as_csv(t.labevents, shared_folder(t.spark, "csv"), "gzip")
    return read_raw(t.spark, path)


@register("scan_parquet_layer", "select * from gold_procedures_icd")
def scan_parquet_layer(t):
    root = shared_folder(t.spark, "layers")
    silver = procedures.silver_procedures_icd(t.procedures_icd)
    write_layer(procedures.gold_procedures_icd(silver), root, "gold", "procedures_icd")
    return read_layer(t.spark, root, "gold", "procedures_icd")


@register("sample_limit", "select * from in_diagnoses_icd order by ROW_ID limit 1000")
def sample_limit(t):
    return first_rows(t.diagnoses_icd, 1000, ["ROW_ID"])


@register("sink_parquet_overwrite", "select * from in_cptevents")
def sink_parquet_overwrite(t):
    root = shared_folder(t.spark, "layers")
    write_layer(t.procedures_icd, root, "bronze", "cptevents")
    write_layer(t.cptevents, root, "bronze", "cptevents")
    return t.spark.read.parquet(layer_path(root, "bronze", "cptevents"))


@register("sink_published", "select * from in_cptevents")
def sink_published(t):
    root = shared_folder(t.spark, "layers")
    publish_layer(t.procedures_icd, root, "bronze", "cptevents")
    publish_layer(t.cptevents, root, "bronze", "cptevents")
    return read_published(t.spark, root, "bronze", "cptevents")


@register("sink_parquet_partitions", "select * from in_d_cpt")
def sink_parquet_partitions(t):
    root = shared_folder(t.spark, "layers")
    write_layer(t.d_cpt, root, "bronze", "d_cpt", partitions=10)
    return read_layer(t.spark, root, "bronze", "d_cpt")


@register("layer_checkpoint", "select * from gold_cptevents")
def layer_checkpoint(t):
    root = shared_folder(t.spark, "layers")
    silver = materialize(procedures.silver_cptevents(t.cptevents), root, "silver", "cptevents")
    return procedures.gold_cptevents(silver)


@register(
    "layer_counts",
    """select 'bronze' as layer, 'cptevents' as "table", count(*) as rows from in_cptevents
       union all select 'silver', 'cptevents', count(*) from silver_cptevents
       union all select 'gold', 'cptevents', count(*) from gold_cptevents""",
)
def _layer_counts(t):
    root = shared_folder(t.spark, "layers")
    bronze = materialize(t.cptevents, root, "bronze", "cptevents")
    silver = materialize(procedures.silver_cptevents(bronze), root, "silver", "cptevents")
    write_layer(procedures.gold_cptevents(silver), root, "gold", "cptevents")
    layers = [(layer, "cptevents") for layer in ("bronze", "silver", "gold")]
    return layer_counts(t.spark, root, layers)


class _RawInputs(dict):
    """Inputs by table name, made when asked for."""

    def __init__(self, t: Inputs):
        super().__init__({name: None for name in INPUTS})
        self._inputs = t

    def __getitem__(self, name):
        return self._inputs.spread(name)


_RUN_LAYERS = [
    *[("bronze", n, f"in_{n}") for n in (
        "cptevents", "procedures_icd", "procedureevents_mv", "d_cpt", "d_icd_procedures",
        "outputevents", "diagnoses_icd", "d_icd_diagnoses", "inputevents_cv", "inputevents_mv",
        "prescriptions")],
    *[("silver", n, f"silver_{n}") for n in (
        "cptevents", "procedures_icd", "procedureevents_mv", "outputevents", "diagnoses_icd",
        "d_icd_diagnoses", "inputevents_cv", "inputevents_mv", "prescriptions")],
    *[("gold", n, f"gold_{n}") for n in (
        "cptevents", "procedures_icd", "procedureevents_mv", "d_cpt", "d_icd_procedures",
        "outputevents", "diagnoses_icd", "inputevents_cv", "inputevents_mv", "prescriptions")],
    ("result", "chart_events_named", "step_chart_named"),
    ("result", "lab_events_named", "step_lab_named"),
    ("result", "microbiology_clean", "step_micro"),
    ("result", "clinical_observation", "step_clinical_observation"),
]


RUN_SQL = (
    " union all ".join(
        f"""select '{layer}' as layer, '{name}' as "table", count(*) as rows from {source}"""
        for layer, name, source in _RUN_LAYERS
    )
    + """ union all select 'gold', 'unified_inputevents',
      (select count(*) from gold_inputevents_cv) + (select count(*) from gold_inputevents_mv)"""
)


@register("run_tables", RUN_SQL)
@register("run_pipelines", RUN_SQL)
def _run_tables(t):
    return run_tables(t.spark, _RawInputs(t), shared_folder(t.spark, "tables"))


def _written(t: Inputs, *names: str) -> str:
    """The folder of layers that the runner has written for these results."""
    root = shared_folder(t.spark, "tables")
    run_tables(t.spark, _RawInputs(t), root, names)
    return root


@register("run_prescriptions", "select * from gold_prescriptions")
def run_prescriptions(t):
    gold = read_layer(t.spark, _written(t, "prescriptions"), "gold", "prescriptions")
    return rounded(gold, "AVG_DOSE", "AVG_DURATION")


@register("run_procedureevents_mv", "select * from gold_procedureevents_mv")
def run_procedureevents_mv(t):
    root = _written(t, "procedureevents_mv")
    return read_layer(t.spark, root, "gold", "procedureevents_mv")


@register("run_inputevents", SQL_UNIFIED_INPUTS)
def run_inputevents(t):
    root = _written(t, "inputevents_cv", "inputevents_mv", "unified_inputevents")
    return rounded(read_layer(t.spark, root, "gold", "unified_inputevents"), "AVG_AMOUNT", "AVG_RATE")


@register("run_clinical_observation", "select * from step_clinical_observation")
def run_clinical_observation(t):
    root = _written(t, "chart_events_named", "lab_events_named", "clinical_observation")
    return read_layer(t.spark, root, None, "clinical_observation")


@register("gzip_chart_events_named", "select * from step_chart_named")
def gzip_chart_events_named(t):
    """From a folder of gzip files per table, one for each task, to the written result."""
    folder, root = shared_folder(t.spark, "csv"), shared_folder(t.spark, "tables")
    for table in ("chartevents", "d_items"):
        _as_csv(getattr(t, table), f"{folder}/{table.upper()}.csv.gz", "gzip")
    run_tables(t.spark, RawFolder(t.spark, folder), root, ["chart_events_named"])
    return read_layer(t.spark, root, None, "chart_events_named")


def _report(t: Inputs, table: str, name: str):
    root = _written(t, table)
    write_reports(t.spark, root, [table])
    return read_layer(t.spark, root, "report", f"{table}_{name}")


@register("report_duplicate_rows", SQL_SHOWCASE)
def report_duplicate_rows(t):
    return _report(t, "cptevents", "duplicate_rows")


@register("report_duplicate_groups", "select * from step_icd_repeated")
def report_duplicate_groups(t):
    return _report(t, "procedures_icd", "duplicate_groups")


@register("report_removed", SQL_COMPARE)
def report_removed(t):
    return _report(t, "procedureevents_mv", "removed")


@register("report_reconcile", SQL_RECONCILE)
def report_reconcile(t):
    return _report(t, "prescriptions", "reconcile")
