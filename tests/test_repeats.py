from carelayers.operators.repeats import distinct_rows


def test_copies_go_and_null_equals_null(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "b"), (None, None)], "k int, v string")
    assert rows(distinct_rows(df)) == rows(df.distinct())
    assert distinct_rows(df.limit(0)).collect() == []


def test_a_million_repeated_keys(spark):
    df = spark.range(2_000_000).selectExpr("id % 1000000 as k", "cast(id % 1000000 as string) as v")
    assert distinct_rows(df).count() == 1_000_000


def test_copies_leave_a_task_as_one_row(spark, plan):
    text = plan(distinct_rows(spark.range(10).selectExpr("id % 2 as k")))
    assert text.count("HashAggregate") == 2
