import pytest
from pyspark.sql import functions as F

from carelayers.operators import dictionary
from carelayers.operators.dictionary import enrich, one_per_key, text_bytes


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [("1", "b", "u"), ("1", "a", None), ("2", None, "v"), ("2", "z", "w"), (None, "n", "n")],
        "code string, label string, unit string",
    )


@pytest.fixture(scope="module")
def facts(spark):
    """Code 1 holds a third of the rows and more."""
    return spark.range(90).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "1").when(F.col("id") % 3 == 1, "2")
        .when(F.col("id") % 2 == 0, "9").alias("code"),
    )


def test_survivor_is_the_first_in_order(dim):
    kept = {r.code: r.label for r in one_per_key(dim, "code").collect()}
    assert kept == {"1": "a", "2": "z", None: "n"}
    kept = {r.code: r.label for r in one_per_key(dim, "code", ["unit"]).collect()}
    assert kept == {"1": "b", "2": None, None: "n"}


@pytest.mark.parametrize("limit", [10**6, 0], ids=["broadcast", "shuffled"])
def test_left_join_keeps_every_fact(spark, facts, dim, limit, plan):
    out = enrich(facts, dim, "code", max_bytes=limit)
    assert ("BroadcastHashJoin" in plan(out)) or limit == 0
    got = out.collect()
    assert len(got) == 90 and out.columns == ["code", "id", "label", "unit"]
    labels = {(r.code, r.label) for r in got}
    assert labels == {("1", "a"), ("2", "z"), ("9", None), (None, None)}


def test_only_counted_big_codes_are_sent_beyond_the_limit(spark, facts, dim):
    hinted = enrich(facts, dim, "code")._jdf.queryExecution().logical().toString()
    shuffled = enrich(facts, dim, "code", max_bytes=0)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower() and "__salts" not in hinted
    assert "__salts" in shuffled


def test_repeated_codes_fan_out_when_asked(facts, dim):
    assert enrich(facts, dim, "code", dedup=False).count() == 30 * 2 + 30 * 2 + 30


@pytest.mark.parametrize("dedup", [True, False])
def test_big_codes_are_salted_and_nothing_changes(spark, facts, dim, rows, dedup):
    copies = facts.union(facts.where("id = 0")).union(facts.where("id = 0")).repartition(4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        salted = enrich(copies, dim, "code", dedup=dedup, max_bytes=0)
        assert "SortMergeJoin [code" in salted._jdf.queryExecution().executedPlan().toString()
        got = rows(salted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == rows(enrich(copies, dim, "code", dedup=dedup))


def test_salts_follow_the_share_of_a_code(spark, dim, monkeypatch):
    """More big codes than any fixed number, and pieces no bigger than one share."""
    monkeypatch.setattr(dictionary, "HOT_SHARE", 50)
    many = spark.range(0, 4000, 1, 8).selectExpr("id", "if(id % 2 = 0, '1', cast(id % 40 as string)) as code")
    joined = dictionary._shuffled_left_join(many, one_per_key(dim, "code"), "code")
    assert joined.count() == 4000 and "__salt" not in joined.columns and "__salts" not in joined.columns
    assert {r.label for r in joined.where("code = '1'").select("label").distinct().collect()} == {"a"}


def test_measured_size_grows_with_the_text(spark, dim):
    assert text_bytes(dim.where("false")) == 0
    long = dim.withColumn("label", F.repeat(F.lit("é"), 1000))
    assert text_bytes(long) > text_bytes(dim) + 5 * 1900


def test_nothing_is_salted_without_a_big_code(spark, dim, plan):
    """Of 4000 codes none has one in 1000 facts more than its share, so keys are not counted one by one."""
    even = spark.range(0, 8000, 1, 8).selectExpr("id", "cast(id % 4000 as string) as code")
    joined = enrich(even, dim, "code", max_bytes=0)
    assert "__salt" not in joined._jdf.queryExecution().logical().toString()
    assert joined.count() == 8000 and joined.where("label is not null").count() == 4


def test_derived_columns_come_after_the_choice(spark, facts, dim, rows):
    derived = {"loud": F.upper("label")}
    for limit in (10**6, 0):
        out = enrich(facts, dim, "code", max_bytes=limit, derived=derived)
        assert {(r.code, r.loud) for r in out.collect()} == {("1", "A"), ("2", "Z"), ("9", None), (None, None)}
