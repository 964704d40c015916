"""Shapes of the physical plans that matter at scale."""

import random
import re

import pytest
from pyspark.sql import functions as F

from carelayers.functions import clean_text, normalize_title
from carelayers.plans import inputs as input_plans
from carelayers.plans import observations, outputs, prescriptions, procedures
from carelayers.sources.layers import materialize, shared_folder


@pytest.fixture(scope="module")
def layer(spark, inputs):
    root = shared_folder(spark, "plans")
    return lambda name: materialize(getattr(inputs, name), root, "bronze", name)


def exchanges(text):
    return re.findall(r"Exchange (?:hash|RoundRobin|range|Single)\w*\(?[^\n]*", text)


def test_edges_combine_before_their_only_shuffle(layer, plan):
    text = plan(procedures.gold_cptevents(procedures.silver_cptevents(layer("cptevents"))))
    assert len(exchanges(text)) == 1 and "partial_count" in text
    assert "CPT_SUFFIX" not in text and "DESCRIPTION" not in text
    assert all(f"IsNotNull({key})" in text for key in procedures.CPT_KEYS)


def test_rollups_combine_before_the_shuffle(layer, plan):
    silver = input_plans.silver_inputevents_cv(layer("inputevents_cv"))
    text = plan(input_plans.gold_inputevents_cv(silver))
    # One shuffle for the copies, one of the combined groups.
    assert len(exchanges(text)) == 2 and "partial_min" in text and "partial_avg" in text


def test_full_row_duplicates_without_a_look_take_one_more(layer, plan):
    silver = input_plans.silver_inputevents_cv(layer("inputevents_cv"))
    assert len(exchanges(plan(input_plans.gold_inputevents_cv(silver)))) == 2


def test_priority_choice_keeps_one_row_per_group_before_the_shuffle(layer, plan):
    text = plan(procedures.gold_procedureevents_mv(layer("procedureevents_mv")))
    assert len(exchanges(text)) == 1
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_events_are_not_shuffled_to_meet_a_small_dictionary(layer, plan):
    named = observations.chart_events_named(layer("chartevents"), layer("d_items"))
    text = plan(named)
    assert "BroadcastHashJoin" in text
    assert len(exchanges(text)) == 1 and "hashpartitioning(item_id" in exchanges(text)[0]
    only = plan(named.select("chart_row_id", "chart_label"))
    assert "WARNING" not in only and "VALUEUOM" not in only


def test_diagnoses_join_without_any_shuffle(layer, plan):
    text = plan(
        outputs.gold_diagnoses_icd(
            outputs.silver_diagnoses_icd(layer("diagnoses_icd")),
            outputs.silver_d_icd_diagnoses(layer("d_icd_diagnoses")),
        )
    )
    assert exchanges(text) == [] and "BroadcastHashJoin" in text


def test_distinct_icu_stays_are_split_by_stay(layer, plan):
    """A hot medication is shuffled by stay first, then as one row per task."""
    silver = prescriptions.silver_prescriptions(layer("prescriptions"))
    found = exchanges(plan(prescriptions.gold_prescriptions(silver)))
    assert any("ICUSTAY_ID" in e for e in found)


def random_texts(seed, n=400):
    rng = random.Random(seed)
    alphabet = "[]()  \t\n\x0b\r\f aBéÉ<>+_-.,'9日"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_text_rules_equal_another_regex_engine(spark, seed):
    texts = random_texts(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select(
        "i", clean_text(F.col("t")).alias("c"), normalize_title(F.col("t")).alias("n")
    ).orderBy("i").collect()
    for row, text in zip(got, texts):
        note_free = re.sub(r"\([^)]*\)", "", re.sub(r"\[[^\]]*\]", "", text))
        spaced = re.sub(r"\s+", " ", note_free, flags=re.ASCII)
        assert row.c == spaced.strip(" ").lower(), repr(text)
        kept = re.sub(r"[^\w\s<>+]", "", text.lower().strip(" "), flags=re.ASCII)
        assert row.n == re.sub(r"\s+", " ", kept, flags=re.ASCII), repr(text)


def test_output_times_may_be_typed_already(spark, inputs):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        time = F.lit("2101-10-20 16:40:00.5")
        typed = inputs.outputevents.withColumns(
            {"CHARTTIME": time.cast("timestamp"), "STORETIME": time.cast("timestamp_ntz")}
        )
        gold = outputs.gold_outputevents(typed).selectExpr(
            "cast(CHARTTIME as string) as a", "cast(STORETIME as string) as b"
        )
        assert set(map(tuple, gold.collect())) == {("2101-10-20 16:40:00.5",) * 2}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
