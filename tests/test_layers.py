import glob
import threading
import time

import pytest
from pyspark.sql import functions as F

from carelayers.catalog.inputs import INPUTS
from carelayers.operators.reports import null_profile, null_profile_of
from carelayers.plans import inputs as input_plans
from carelayers.plans.checks import table_reports
from carelayers.plans.runner import PLANS, TablePlan, run_tables
from carelayers.sources.layers import layer_path, materialize, read_layer, shared_folder, write_layer
from carelayers.sources.raw import RawFolder, first_rows, read_raw, spread


@pytest.fixture
def root(spark):
    return shared_folder(spark, "test")


def test_shared_folder_is_new_below_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a != b and a.startswith(configured)


def test_write_counts_rows_and_overwrites(spark, root):
    assert write_layer(spark.range(100), root, "gold", "t") == 100
    assert write_layer(spark.range(7), root, "gold", "t", partitions=3) == 7
    assert read_layer(spark, root, "gold", "t").count() == 7
    assert len(glob.glob(layer_path(root, "gold", "t") + "/*.parquet")) <= 3


def test_materialize_reads_the_written_copy(spark, root, plan):
    out = materialize(spark.range(10).withColumn("x", F.col("id") * 2), root, None, "t")
    assert "FileScan parquet" in plan(out) and out.count() == 10


def test_missing_input_fails_at_once(spark, root):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_raw(spark, f"{root}/none.csv.gz")


def write_text(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def test_inference_loses_leading_zeros_and_declared_types_keep_them(spark, root):
    write_text(spark, root, ["ROW_ID,ICD9_CODE,SEQ_NUM", '1,"0331",x', '2,"331",4'])
    inferred = read_raw(spark, root, infer=True)
    assert dict(inferred.dtypes)["ICD9_CODE"] == "int"
    declared = read_raw(spark, root, table="procedures_icd")
    assert [tuple(r) for r in declared.orderBy("ROW_ID").collect()] == [(1, "0331", None), (2, "331", 4)]


def test_doubled_quotes_and_partitions(spark, root):
    write_text(spark, root, ["a,b", '"say ""hi"", twice",2'])
    df = read_raw(spark, root, partitions=3)
    assert [tuple(r) for r in df.collect()] == [('say "hi", twice', "2")]
    assert df.rdd.getNumPartitions() == 3


def test_spread_only_what_comes_in_few_pieces(spark, plan):
    one, many = spark.range(100).coalesce(1), spark.range(0, 100, 1, 50)
    assert spread(one).rdd.getNumPartitions() == 8
    assert "Exchange" not in plan(spread(many))


def test_first_rows(spark):
    df = spark.range(50)
    assert first_rows(df, 0).count() == 50
    assert [r.id for r in first_rows(df, 3, ["id"]).collect()] == [0, 1, 2]


def test_unknown_table_is_refused_before_writing(spark, root):
    with pytest.raises(ValueError, match="nope"):
        run_tables(spark, {}, root, ["cptevents", "nope"])
    assert glob.glob(f"{root}/*") == []


def test_csv_to_results(spark, root, inputs, rows):
    """CSV in, every layer out, the same results as straight from the inputs."""
    raw = RawFolder(spark, f"{root}/raw")
    for name in INPUTS:
        df = getattr(inputs, name)
        text = df.select(*[F.col(c).cast("string") for c in df.columns])
        text.repartition(2).write.csv(
            raw.path(name), header=True, quote='"', escape='"',
            compression="gzip" if raw.path(name).endswith(".gz") else "none",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    # Documents hold line breaks, which single-line records cannot carry.
    chosen = [name for name in PLANS if name != "microbiology_clean"]
    counts = run_tables(spark, raw, f"{root}/out", chosen)
    got = {(r.layer, r.table): r.rows for r in counts.collect()}
    assert got[("bronze", "cptevents")] == inputs.cptevents.count()
    fused = got[("gold", "inputevents_cv")] + got[("gold", "inputevents_mv")]
    assert got[("gold", "unified_inputevents")] == fused
    assert got[("result", "chart_events_named")] == inputs.chartevents.count()

    silver = input_plans.silver_inputevents_cv(inputs.inputevents_cv)
    direct = input_plans.gold_inputevents_cv(silver)
    written = read_layer(spark, f"{root}/out", "gold", "inputevents_cv")
    exact = [c for c in direct.columns if not c.startswith("AVG_")]
    assert rows(written, exact) == rows(direct, exact)

    reports = {name: table_reports(spark, f"{root}/out", name) for name in chosen}
    assert reports["chart_events_named"] == {}
    for name, named in reports.items():
        for report in named:
            df = named[report]
            if report == "reconcile":
                assert df.first().difference == 0, name
            elif report.startswith("null_profile"):
                assert {r.total for r in df.collect()} == {got[("bronze", report[13:])]}
            else:
                assert df.columns and df.count() >= 0, (name, report)
    bronze = read_layer(spark, f"{root}/out", "bronze", "procedureevents_mv")
    counted = reports["procedureevents_mv"]["null_profile_procedureevents_mv"]
    assert rows(counted) == rows(null_profile(bronze))
    silver = read_layer(spark, f"{root}/out", "silver", "procedureevents_mv")
    assert set(bronze.columns) - set(silver.columns) == {"COMMENTS_DATE"}
    removed = reports["procedureevents_mv"]["removed"].agg(F.sum("removed")).first()[0]
    before, after = (got[(layer, "procedureevents_mv")] for layer in ("silver", "gold"))
    assert removed == before - after > 0


def test_file_counts(spark, root, inputs):
    raw = {"d_cpt": inputs.d_cpt, "procedures_icd": inputs.procedures_icd}
    run_tables(spark, raw, root, list(raw), partitions=6, dictionary_partitions=2)
    files = {path.split("/")[-2]: 0 for path in glob.glob(f"{root}/*/*.parquet")}
    for path in glob.glob(f"{root}/*/*.parquet"):
        files[path.split("/")[-2]] += 1
    assert files["bronze_procedures_icd"] == 6 and files["gold_d_cpt"] == 2


def test_sample_limits_all_but_the_named_tables(spark, root):
    for name in ("CPTEVENTS", "D_CPT"):
        write_text(spark, f"{root}/{name}.csv.gz", ["ROW_ID", *map(str, range(30))])
    raw = RawFolder(spark, root, sample=5, whole=("d_cpt",))
    assert raw["cptevents"].count() == 5 and raw["d_cpt"].count() == 30
    with pytest.raises(KeyError):
        raw["other"]


def test_empty_tables_are_written_and_counted(spark, root):
    nothing = spark.range(5).where("false")
    assert write_layer(nothing, root, "bronze", "a") == 0
    assert write_layer(spark.createDataFrame([], "x int"), root, "bronze", "b", partitions=2) == 0
    assert write_layer(nothing.groupBy("id").count(), root, "gold", "c") == 0
    assert read_layer(spark, root, "gold", "c").columns == ["id", "count"]


def test_profile_of_an_empty_table(spark):
    assert [tuple(r) for r in null_profile_of(spark, 0, {"a": 0}).collect()] == [
        ("a", 0, 0, 0.0, False)
    ]


def test_independent_results_are_written_at_the_same_time(spark, root, monkeypatch):
    both = threading.Barrier(2, timeout=60)

    def met(df):
        both.wait()
        return df

    for name in ("x", "y"):
        monkeypatch.setitem(PLANS, name, TablePlan((name,), met, plain=True))
    counts = run_tables(spark, {"x": spark.range(3), "y": spark.range(4)}, root, ["x", "y"])
    assert [tuple(r) for r in counts.collect()] == [("result", "x", 3), ("result", "y", 4)]


def test_a_result_waits_for_those_it_is_built_on(spark, root, monkeypatch):
    monkeypatch.setitem(PLANS, "x", TablePlan(("x",), lambda df: df, plain=True))
    monkeypatch.setitem(PLANS, "z", TablePlan((), lambda df: df.union(df), after=("x",), plain=True))
    again = ["x", "z", "x", "z", "x"]
    counts = run_tables(spark, {"x": spark.range(3)}, root, again)
    assert [tuple(r) for r in counts.collect()] == [("result", n, {"x": 3, "z": 6}[n]) for n in again]


def test_a_failed_result_is_an_error_and_those_built_on_it_are_not_written(spark, root, monkeypatch):
    def failed(df):
        raise RuntimeError("no gold")

    monkeypatch.setitem(PLANS, "x", TablePlan(("x",), failed, plain=True))
    monkeypatch.setitem(PLANS, "z", TablePlan((), lambda df: df, after=("x",), plain=True))
    with pytest.raises(RuntimeError, match="no gold"):
        run_tables(spark, {"x": spark.range(3)}, root, ["x", "z"])
    assert glob.glob(f"{root}/*") == []


def test_rows_are_those_counted_by_the_writes(spark, root, inputs, plan):
    counts = run_tables(spark, {"cptevents": inputs.cptevents}, root, ["cptevents"])
    assert "FileScan" not in plan(counts)
    read = [(layer, "cptevents", read_layer(spark, root, layer, "cptevents").count()) for layer in ("bronze", "silver", "gold")]
    assert [tuple(r) for r in counts.collect()] == read


def shuffle_files(spark):
    """What shuffles hold on this machine's disk, as paths."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    paths = [str(files.apply(k)) for k in range(files.size())]
    return {p for p in paths if "/shuffle_" in p}


@pytest.mark.parametrize("fails", [False, True])
def test_what_a_run_has_shuffled_does_not_stay(spark, root, monkeypatch, fails):
    def dealt(df):
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
        counted = df.repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count()
        assert counted.count() == 7
        if fails:
            raise RuntimeError("no gold")
        return counted

    before = shuffle_files(spark)
    monkeypatch.setitem(PLANS, "x", TablePlan(("x",), dealt, plain=True))
    if fails:
        with pytest.raises(RuntimeError, match="no gold"):
            run_tables(spark, {"x": spark.range(1000)}, root, ["x"])
    else:
        assert [tuple(r) for r in run_tables(spark, {"x": spark.range(1000)}, root, ["x"]).collect()] == [("result", "x", 7)]
    until = time.time() + 30  # files are deleted a little later
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    # The session is left as it was.
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_layers_take_less_disk_than_by_the_default_codec(spark, root):
    hashed = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    hashed.write.parquet(f"{root}/plain")
    write_layer(hashed, root, "gold", "t")

    def files(folder):
        return glob.glob(f"{folder}/*.parquet")

    assert read_layer(spark, root, "gold", "t").exceptAll(hashed).count() == 0
    size = {f: sum(len(open(p, "rb").read()) for p in files(f"{root}/{f}")) for f in ("plain", "gold_t")}
    assert size["gold_t"] < 0.75 * size["plain"]
    spark.conf.set("spark.sql.parquet.compression.codec", "gzip")
    try:
        write_layer(hashed, root, "gold", "u")
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")
    assert files(f"{root}/gold_u") and all(".gz." in p for p in files(f"{root}/gold_u"))
