import math

import pytest
from pyspark.sql import functions as F

from carelayers.operators.fuse import fuse
from carelayers.operators.reports import (
    bucket_stats,
    compare_counts,
    compare_rows,
    distinct_count,
    duplicate_groups,
    duplicate_summary,
    exact_duplicate_count,
    head_by,
    null_profile,
    reconcile,
    top_groups,
)
from carelayers.operators.rollup import edge_counts, representative


@pytest.fixture(scope="module")
def table(spark):
    data = [(1, "a", None), (1, "a", None), (1, "b", 2.0), (None, "a", 3.0), (None, "a", math.nan)]
    return spark.createDataFrame(data, "k int, c string, v double")


def test_null_profile(table):
    got = {r.column: tuple(r)[1:] for r in null_profile(table).collect()}
    assert got == {
        "k": (2, 5, 40.0, True), "c": (0, 5, 0.0, False), "v": (2, 5, 40.0, True),
    }


def test_reports_on_an_empty_table(table):
    empty = table.where("false")
    assert {tuple(r)[1:] for r in null_profile(empty).collect()} == {(0, 0, 0.0, False)}
    assert tuple(duplicate_summary(empty, ["k"]).first()) == (0, 0, 0, 0.0)
    assert tuple(exact_duplicate_count(empty).first()) == (0, 0, 0)
    assert tuple(bucket_stats(empty, "k").first()) == (None, None, None, None, 0)
    assert tuple(distinct_count(empty, "k").first()) == (0, 0)
    gold = edge_counts(empty, ["k"], "n")
    assert tuple(reconcile(empty, gold, "n").first()) == (0, 0, 0)


def test_one_bucket_has_no_deviation(table):
    assert bucket_stats(table.where("k = 1"), "k").first().stddev_rows is None


def test_duplicates(table):
    assert tuple(duplicate_summary(table, ["k", "c"]).first()) == (5, 3, 2, 40.0)
    assert {tuple(r) for r in duplicate_groups(table, ["k", "c"]).collect()} == {
        (1, "a", 2), (None, "a", 2),
    }
    assert tuple(exact_duplicate_count(table).first()) == (5, 4, 1)
    assert [tuple(r) for r in top_groups(table, ["k"], 1).collect()] == [(1, 3)]
    assert [tuple(r) for r in top_groups(table, ["k", "c"], 9, min_count=2).collect()] == [
        (None, "a", 2), (1, "a", 2),
    ]


def test_distinct_count_with_and_without_null(table):
    assert tuple(distinct_count(table, "k").first()) == (2, 1)


def test_reconcile_counts_every_edge_report(inputs):
    for df, keys in (
        (inputs.cptevents, ["SUBJECT_ID", "HADM_ID", "CPT_CD"]),
        (inputs.procedures_icd, ["HADM_ID", "ICD9_CODE"]),
        (inputs.inputevents_cv, ["SUBJECT_ID", "HADM_ID", "ITEMID"]),
    ):
        assert reconcile(df, edge_counts(df, keys, "n"), "n").first().difference == 0


def test_representative_skips_nulls_and_has_an_order(spark):
    data = [(1, 2, 1, None), (1, 2, 2, "late"), (1, 3, 1, "later"), (1, 2, 2, "earlier text"),
            (2, 1, 1, None)]
    df = spark.createDataFrame(data, "k int, t int, row int, c string")
    got = df.groupBy("k").agg(representative("c", ["t", "row"]).alias("c")).orderBy("k").collect()
    assert [r.c for r in got] == ["earlier text", None]


def test_compare_layers(spark):
    before = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    after = before.where("id < 4")
    counts = compare_counts(before, after, "k").collect()
    got = {r.k: (r.rows_before, r.rows_after, r.removed) for r in counts}
    assert got == {0: (4, 2, 2), 1: (3, 1, 2), 2: (3, 1, 2)}
    shown = compare_rows(before, after, "k", 0, ["id"], ["id"]).collect()
    assert [tuple(r) for r in shown] == [
        ("before", 0), ("before", 3), ("before", 6), ("before", 9), ("after", 0), ("after", 3),
    ]


def test_head_by(table):
    assert [r.k for r in head_by(table, ["k"], ["k"], 3).collect()] == [None, None, 1]


def test_unique_plus_duplicates_is_total(inputs):
    twice = fuse([inputs.outputevents, inputs.outputevents])
    r = exact_duplicate_count(twice).first()
    assert r.total_rows == r.distinct_rows + r.duplicate_rows
    assert r.duplicate_rows == inputs.outputevents.count()
