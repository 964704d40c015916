import random
from datetime import datetime, timedelta

import pytest

from carelayers.operators.near_duplicates import _half_neighbourhood, first_pairs, near_duplicates

START = datetime(2101, 1, 1)
SCHEMA = "id long, k string, g int, s timestamp, e timestamp, status string"


def events(seed, n=240):
    """A third of the rows share one key; gaps sit around the one-hour border."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        s = START + timedelta(seconds=rng.choice([0, 1, 3599, 3600, 3601, 7199, 7200, rng.randrange(40000)]))
        e = None if rng.random() < 0.1 else s + timedelta(seconds=rng.choice([0, 1800, 3599, 3600, 9000]))
        out.append((rng.randrange(n), key, rng.randrange(2), s, e, f"st{i}"))
    return out


def pairs_by_hand(data, tolerance):
    found = []
    for a in data:
        for b in data:
            if a[0] >= b[0] or None in (a[1], b[1], a[4], b[4]) or a[1:3] != b[1:3]:
                continue
            if all(abs((a[t] - b[t]).total_seconds()) < tolerance for t in (3, 4)):
                found.append((a[1], a[2], a[0], a[5], b[0], b[5]))
    return sorted(found)


@pytest.mark.parametrize("seed,tolerance", [(1, 3600), (2, 3600), (3, 60), (4, 5000)])
@pytest.mark.parametrize("broadcast", [True, False])
def test_pairs_equal_a_plain_double_loop(spark, seed, tolerance, broadcast):
    data = events(seed)
    df = spark.createDataFrame(data, SCHEMA)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        if not broadcast:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = near_duplicates(df, ["k", "g"], "id", ["s", "e"], tolerance, ["status"])
        got = sorted((r.k, r.g, r.a.id, r.a.status, r.b.id, r.b.status) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == pairs_by_hand(data, tolerance)
    assert got


def test_times_before_1970(spark):
    early = datetime(1969, 12, 31, 23, 30)
    data = [(1, "a", 0, early, early, "x"), (2, "a", 0, early + timedelta(minutes=59), early, "y")]
    out = near_duplicates(spark.createDataFrame(data, SCHEMA), ["k"], "id", ["s", "e"])
    assert [(r.a.id, r.b.id) for r in out.collect()] == [(1, 2)]


@pytest.mark.parametrize("dimensions", [1, 2, 3])
def test_each_neighbour_is_visited_from_one_side(dimensions):
    steps = _half_neighbourhood(dimensions)
    own = (0,) * dimensions
    assert own in steps
    opposite = {tuple(-x for x in s) for s in steps}
    assert len(set(steps) | opposite) == 3**dimensions
    assert set(steps) & opposite == {own}


def test_cells_are_join_keys(spark, plan, inputs):
    out = near_duplicates(inputs.procedureevents_mv, ["HADM_ID"], "ROW_ID", ["RAW_START"])
    text = plan(out)
    assert "__cell0" in text and "Join [HADM_ID" in text
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_a_big_cell_is_split_at_run_time(spark):
    """With both sides shuffled, adaptive execution splits the partition of a hot cell."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    old = {name: spark.conf.get(name, None) for name in settings}
    data = [(i, "hot" if i % 3 else f"k{i}", 0, START, START, "x") for i in range(900)]
    df = spark.createDataFrame(data, SCHEMA).repartition(8)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        out = near_duplicates(df, ["k"], "id", ["s", "e"])
        assert len(out.collect()) == 600 * 599 // 2
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("n", [5, 40, 10_000])
def test_first_pairs_make_few_pairs(spark, n):
    """Three near events in each of 300 groups and in none of the first 20: as all pairs in order, from few of them."""
    data = [(g * 10 + i, "k", g, START, START + timedelta(minutes=i if g >= 20 else 90 * i), "x") for g in range(320) for i in range(3)]
    df = spark.createDataFrame(data, SCHEMA)
    seen = []

    def pairs_of(rows):
        seen.append(rows.count())
        return near_duplicates(rows, ["k", "g"], "id", ["s", "e"])

    got = [(r.g, r.a.id, r.b.id) for r in first_pairs(df, pairs_of, "g", ["a.id", "b.id"], n).collect()]
    every = sorted((g, a * 1, b) for g in range(20, 320) for a, b in ((g * 10, g * 10 + 1), (g * 10, g * 10 + 2), (g * 10 + 1, g * 10 + 2)))
    assert got == every[:n]
    assert seen[-1] <= (3 * 64 if n < 100 else len(data))
    assert first_pairs(df.limit(0), pairs_of, "g", ["a.id"], 3).collect() == []
