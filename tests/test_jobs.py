"""What the job writes besides the layers, and how it reads gzip tables."""

import os

from pyspark.sql import functions as F

from carelayers.catalog.storage import _as_csv
from carelayers.plans.checks import admission_reports, table_reports, write_reports
from carelayers.plans.runner import run_tables
from carelayers.sources.layers import read_layer, shared_folder
from carelayers.sources.raw import RawFolder


def test_reports_are_written_as_layers(spark, inputs, rows):
    root, tables = shared_folder(spark, "reports"), ["cptevents", "procedureevents_mv"]
    raw = {name: getattr(inputs, name) for name in tables}
    run_tables(spark, raw, root, tables)
    counts = write_reports(spark, root, tables)
    assert "cptevents_duplicate_rows" in counts and "procedureevents_mv_removed" in counts
    for table in tables:
        for name, report in table_reports(spark, root, table).items():
            written = read_layer(spark, root, "report", f"{table}_{name}")
            assert rows(written) == rows(report) and counts[f"{table}_{name}"] == written.count()


def test_one_admission(spark, inputs):
    root, tables = shared_folder(spark, "admission"), ["cptevents", "procedureevents_mv"]
    run_tables(spark, {name: getattr(inputs, name) for name in tables}, root, tables)
    silver = read_layer(spark, root, "silver", "procedureevents_mv")
    admission = silver.groupBy("HADM_ID").count().orderBy(F.desc("count"), "HADM_ID").first()[0]
    found = admission_reports(spark, root, admission)
    gold = read_layer(spark, root, "gold", "procedureevents_mv")
    sizes = {r["layer"]: r["count"] for r in found["procedure_rows"].groupBy("layer").count().collect()}
    here = F.col("HADM_ID") == admission
    assert sizes == {"before": silver.where(here).count(), "after": gold.where(here).count()}
    codes = read_layer(spark, root, "silver", "cptevents").where(here)
    assert found["billing_codes"].count() == codes.count()


def test_one_gzip_file_is_written_by_many_tasks(spark, inputs):
    folder, root = shared_folder(spark, "csv"), shared_folder(spark, "tables")
    for table in ("chartevents", "d_items"):
        _as_csv(getattr(inputs, table).coalesce(1), f"{folder}/{table.upper()}.csv.gz", "gzip")
    raw = RawFolder(spark, folder)
    assert raw["chartevents"].rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    run_tables(spark, raw, root, ["chart_events_named"])
    files = [f for f in os.listdir(f"{root}/chart_events_named") if f.endswith(".parquet")]
    assert len(files) > 1
    assert RawFolder(spark, folder, pieces=3)["d_items"].rdd.getNumPartitions() == 3


def test_plain_tables_are_named_by_the_caller(spark, inputs):
    folder = shared_folder(spark, "csv")
    _as_csv(inputs.procedures_icd, f"{folder}/PROCEDURES_ICD.csv", "none")
    raw = RawFolder(spark, folder, plain=("procedures_icd",))
    assert raw["procedures_icd"].count() == inputs.procedures_icd.count()


def test_gzip_tables_are_written_by_many_tasks(spark, inputs, monkeypatch):
    from types import SimpleNamespace

    from carelayers.catalog import storage

    written = []

    def kept(df, path, compression):
        written.append(path)
        return _as_csv(df, path, compression)

    monkeypatch.setattr(storage, "_as_csv", kept)
    tables = {name: getattr(inputs, name).repartition(4) for name in ("chartevents", "d_items")}
    out = storage.gzip_chart_events_named(SimpleNamespace(spark=spark, **tables))
    assert out.count() == inputs.chartevents.count()
    assert all(len([f for f in os.listdir(path) if f.endswith(".gz")]) == 4 for path in written) and len(written) == 2
