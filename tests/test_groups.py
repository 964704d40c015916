"""Steps that look through hashes of groups first: the same rows, less shuffled."""

import os

import pytest
from pyspark.sql import functions as F

from carelayers.catalog.storage import _as_csv
from carelayers.operators import groups
from carelayers.operators.groups import for_repeated
from carelayers.operators.ranking import first_within
from carelayers.operators.repeats import distinct_rows
from carelayers.plans import observations, prescriptions
from carelayers.sources.layers import materialize, shared_folder
from carelayers.sources.raw import RawFolder


@pytest.fixture(scope="module")
def named(inputs):
    charts = observations.chart_events_named(inputs.chartevents, inputs.d_items)
    return charts, observations.lab_events_named(inputs.labevents, inputs.d_labitems)


@pytest.mark.parametrize("most", [groups.FEW_REPEATED, 0], ids=["few", "many"])
def test_copies_go_whichever_way(spark, rows, monkeypatch, most):
    monkeypatch.setattr(groups, "FEW_REPEATED", most)
    odd = [(1, None, 0.0), (1, None, -0.0), (2, "a", float("nan")), (2, "a", float("nan")), (3, "b", 1.0), (None,) * 3]
    df = spark.createDataFrame(odd, "k int, v string, x double")
    got = for_repeated(df, df.columns, distinct_rows)
    assert got.columns == df.columns and got.count() == df.distinct().count() == 4
    assert for_repeated(df.limit(0), df.columns, distinct_rows).collect() == []


def test_rows_alone_in_their_group_are_not_shuffled(spark, plan):
    df = spark.range(100).selectExpr("id as k", "id * 2 as v")
    assert "Exchange" not in plan(for_repeated(df, df.columns, distinct_rows))


def test_observations_with_ids_of_their_own_meet_no_window(named, plan, rows):
    charts, labs = named
    assert "windowspecdefinition(observation_id" not in plan(observations.clinical_observation(charts, labs))
    twice = observations.clinical_observation(charts.union(charts.withColumn("warning", F.lit("a"))), labs)
    every = observations.observations(charts.union(charts.withColumn("warning", F.lit("a"))), labs)
    assert rows(twice) == rows(first_within(every, ["observation_id"], []))


def test_sources_of_observations_are_those_of_the_whole_rows(named, rows):
    charts, labs = named
    twice = charts.union(charts.withColumn("value_text", F.lit("0")))
    whole = observations.clinical_observation(twice, labs).select("source_table", "observation_id")
    assert rows(observations.observation_sources(twice, labs)) == rows(whole)


@pytest.mark.parametrize("limit", [10_000, 3], ids=["no large group", "large groups"])
def test_groups_rolled_up_after_one_shuffle(spark, inputs, rows, plan, monkeypatch, limit):
    silver = prescriptions.silver_prescriptions(inputs.prescriptions)
    hot = {"SUBJECT_ID": F.lit(1), "HADM_ID": F.lit(2), "MEDICATION_NAME": F.lit("X")}
    silver = silver.union(silver.limit(50).withColumns(hot).select(*silver.columns))
    silver = materialize(silver, shared_folder(spark, "rx"), "silver", "prescriptions")
    expected = rows(prescriptions._rolled_up(silver))
    monkeypatch.setattr(prescriptions, "SMALL_TABLE", 0)
    monkeypatch.setattr(prescriptions, "SMALL_BUCKET", limit)
    monkeypatch.setattr(prescriptions, "LARGE_SHARE", 10**9)
    gold = prescriptions.gold_prescriptions(silver)
    assert rows(gold) == expected
    assert plan(gold).count("Exchange hashpartitioning") == (1 if limit > 50 else 3)


def test_many_gzip_files_are_not_shuffled_to_be_read(spark, inputs, plan):
    folder = shared_folder(spark, "csv")
    _as_csv(inputs.procedures_icd.repartition(16), f"{folder}/PROCEDURES_ICD.csv.gz", "gzip")
    assert len([f for f in os.listdir(f"{folder}/PROCEDURES_ICD.csv.gz") if f.endswith(".gz")]) == 16
    read = RawFolder(spark, folder)["procedures_icd"]
    assert "Exchange" not in plan(read) and read.count() == inputs.procedures_icd.count()


def test_a_costly_key_is_not_made_to_look_through_groups(spark):
    df = spark.range(100).withColumn("k", F.raise_error(F.lit("made")).cast("string"))
    assert for_repeated(df, ["k"], distinct_rows, [F.col("id")]).drop("k").count() == 100


def test_equal_ids_of_unlike_parts_are_found(spark, named, rows):
    charts, labs = named
    one = charts.limit(1)
    split = {"chart_row_id": F.lit("a"), "subject_id": F.lit("b||c")}
    joined = {"chart_row_id": F.lit("a||b"), "subject_id": F.lit("c")}
    both = one.withColumns(split).unionByName(one.withColumns(joined))
    both = materialize(both, shared_folder(spark, "ids"), None, "charts")
    out = observations.clinical_observation(both, labs.limit(0)).collect()
    assert [r.source_row_id for r in out] == ["a"]


def test_stays_are_counted_without_combining_rows_twice(spark, inputs, rows, plan, monkeypatch):
    silver = prescriptions.silver_prescriptions(inputs.prescriptions)
    group = {"SUBJECT_ID": F.lit(1), "HADM_ID": F.lit(2), "MEDICATION_NAME": F.lit("X")}
    stays = {"ICUSTAY_ID": F.when(F.col("ICUSTAY_ID") != 3, F.col("ICUSTAY_ID"))}
    silver = silver.union(silver.limit(50).withColumns({**group, **stays}).select(*silver.columns))
    silver = materialize(silver, shared_folder(spark, "rx"), "silver", "prescriptions")
    expected = silver.groupBy(*prescriptions.MEDICATION_EDGE).agg(F.count_distinct("ICUSTAY_ID").alias("n"))
    monkeypatch.setattr(prescriptions, "SMALL_TABLE", 0)
    gold = prescriptions.gold_prescriptions(silver)
    assert plan(gold).count("SortAggregate(") == 2
    keys = prescriptions.MEDICATION_EDGE
    assert rows(gold, [*keys, "ICU_STAY_COUNT"]) == rows(expected, [*keys, "n"])
