import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from carelayers.functions import (
    clean_text,
    dose_numeric,
    duration_hours,
    event_flag,
    normalize_title,
    observation_id,
    parse_timestamp,
    remap,
    safe_double,
    safe_long,
    upper_trim,
)


def apply(spark, function, values, kind="string"):
    data = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in data.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("a[b[c]d]e", "ad]e"),
        ("x (a(b)c) y", "x c) y"),
        ("(all)", ""),
        ("  Heart\t\tRate  [bpm] ", "heart rate"),
        ("two\nlines (note\nover lines) END", "two lines end"),
        ("", ""),
        (None, None),
        ("ÉCG (x)", "écg"),
    ],
)
def test_clean_text(spark, text, expected):
    assert apply(spark, clean_text, [text]) == [expected]


@pytest.mark.parametrize(
    "title,expected",
    [
        (" - Foo, BAR ", " foo bar"),
        ("Ménière's", "mnires"),
        ("<37 Wks> + 50%", "<37 wks> + 50"),
        ("a\t b", "a b"),
        (None, None),
    ],
)
def test_normalize_title(spark, title, expected):
    assert apply(spark, normalize_title, [title]) == [expected]


def test_lenient_numbers(spark):
    texts = [" 7.5 ", "n/a", "", None, "-1e3", "<=16"]
    assert apply(spark, safe_double, texts) == [7.5, None, None, None, -1000.0, None]
    texts = ["12", " 7 ", "12.0", "-3.", "12.9", "1e3", "x", "", None]
    assert apply(spark, safe_long, texts) == [12, 7, 12, -3, 12, None, None, None, None]
    assert apply(spark, safe_long, [12.9, None, 1e12], "double") == [12, None, 10**12]
    assert apply(spark, safe_long, [5, None], "int") == [5, None]


def test_dose_numeric(spark):
    texts = ["1-2", "12.5 mg", "2,000", "per protocol", "", None, "3."]
    assert apply(spark, dose_numeric, texts) == [1.0, 12.5, 2.0, None, None, None, 3.0]


def test_parse_timestamp(spark):
    texts = ["2101-10-20 16:40:00", "2101-10-20", "pending", None]
    assert apply(spark, parse_timestamp, texts) == [
        datetime(2101, 10, 20, 16, 40), datetime(2101, 10, 20), None, None,
    ]
    strict = apply(spark, lambda c: parse_timestamp(c, "yyyy-MM-dd HH:mm:ss"), texts)
    assert strict == [datetime(2101, 10, 20, 16, 40), None, None, None]


def test_duration_ignores_fractions_and_may_be_negative(spark):
    row = spark.sql(
        """select timestamp'2024-01-01 00:00:00.900' a, timestamp'2024-01-01 01:30:00.100' b,
           cast(null as timestamp) n"""
    )
    got = row.select(
        duration_hours(F.col("a"), F.col("b")).alias("x"),
        duration_hours(F.col("b"), F.col("a")).alias("y"),
        duration_hours(F.col("a"), F.col("n")).alias("z"),
    ).first()
    assert tuple(got) == (1.5, -1.5, None)


def test_codes_and_units(spark):
    assert apply(spark, lambda c: remap(c, {"75539": "75529", "mL": "ml"}), ["75539", "mL", "x", None]) == [
        "75529", "ml", "x", None,
    ]
    assert apply(spark, lambda c: remap(c, {"331": "0331"}), [331, 332, None], "int") == [
        "0331", "332", None,
    ]
    assert apply(spark, upper_trim, [" ml ", "", None]) == ["ML", "", None]


def test_observation_id_parts(spark):
    df = spark.sql(
        """select * from values
           ('chartevents', '1', '2', '3', '4', timestamp'2101-10-20 16:40:00'),
           ('labevents', '1', cast(null as string), null, null, null) t(s, r, p, h, i, t)"""
    )
    got = [
        r[0] for r in df.select(observation_id(*[F.col(c) for c in "srphit"])).collect()
    ]
    texts = ["chartevents||1||2||3||4||2101-10-20 16:40:00", "labevents||1||NO_HADM||NO_ITEM||NO_TIME"]
    assert got == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def test_event_flag(spark):
    df = spark.sql("select '1' as w, cast(null as string) as e")
    assert df.select(event_flag(warning=F.col("w"), error=F.col("e"))).first()[0] == "warning=1|error="


def test_observation_id_is_the_same_in_every_session_zone(spark):
    from carelayers.functions import observation_id

    times = spark.sql(
        "select timestamp_micros(x) as t from values (0L), (1583046000000000L), (1604196000123000L), (null) as v(x)"
    )
    ids, old = [], spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            parts = [F.lit(x) for x in ("chartevents", "1", "2", "3", "4")]
            ids.append([r[0] for r in times.select(observation_id(*parts, F.col("t"))).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ids[0] == ids[1] == ids[2] and len(set(ids[0])) == 4


def test_a_row_without_a_time_is_not_the_earliest(spark):
    from carelayers.operators.rollup import representative

    rows = [(None, 1, "untimed"), ("2020-01-01", 2, "early"), ("2020-01-02", None, "late"), (None, None, "x")]
    df = spark.createDataFrame(rows, "t string, id int, v string")
    assert df.agg(representative("v", ["t", "id"])).first()[0] == "early"
    assert df.where("t is null").agg(representative("v", ["t", "id"])).first()[0] == "untimed"
