import datetime as dt

import pytest
from pyspark.sql import functions as F

from faceoff import functions as Fn


def test_utc_clock_fixture(spark):
    hours = [0, 3, 4, 6, 7, 23]
    rows = [(dt.datetime(2021, 3, 1, h, 5),) for h in hours]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    out = df.select(*[Fn.utc_clock("ts", z).alias(z) for z in Fn.ZONES]).collect()
    assert [r.est for r in out] == ["20:05", "23:05", "0:05", "2:05", "3:05", "19:05"]
    assert [r.pst for r in out] == ["17:05", "20:05", "21:05", "23:05", "0:05", "16:05"]


def test_utc_clock_all_hours_wrap(spark):
    df = spark.range(24).select(F.make_timestamp_ntz(F.lit(2021), F.lit(1), F.lit(1), "id", F.lit(30), F.lit(0)).alias("ts"))
    got = [r[0] for r in df.select(Fn.utc_clock("ts", "CST")).collect()]
    assert got == [f"{(h - 5) % 24}:30" for h in range(24)]


def test_unknown_zone():
    with pytest.raises(ValueError):
        Fn.utc_clock("ts", "gmt")


def test_local_clock_uses_zone_rules(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 15, 0, 30),), (dt.datetime(2021, 4, 15, 0, 30),)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(Fn.local_clock("ts", "America/New_York")).collect()]
    assert got == ["19:30", "20:30"]


def test_parse_utc_instant(spark):
    rows = [("2021-03-01T23:00:00Z",), ("2021-03-01T23:00:00.250Z",), ("garbage",), ("2021-02-30T01:00:00Z",),
            ("2021-03-14T02:30:00Z",)]
    df = spark.createDataFrame(rows, "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")  # 02:30 on 2021-03-14 is a DST gap there
    try:
        got = [r[0] for r in df.select(Fn.parse_utc_instant("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2021, 3, 1, 23, 0), dt.datetime(2021, 3, 1, 23, 0, 0, 250000), None, None,
                   dt.datetime(2021, 3, 14, 2, 30)]


def test_normalize_key_java_whitespace(spark):
    raw = [" A", "b\tC", "x y", "n b", "s\u001ct", "MiXeD  Case\n"]
    df = spark.createDataFrame([(r,) for r in raw], "k string")
    got = [r[0] for r in df.select(Fn.normalize_key("k")).collect()]
    # em-space and U+001C are whitespace for Java, the no-break space is not
    assert got == ["a", "bc", "xy", "n b", "st", "mixedcase"]


def test_java_trim(spark):
    df = spark.createDataFrame([("\t\u0001 x y \n",)], "s string")
    assert df.select(Fn.java_trim("s")).first()[0] == "x y"


def test_label(spark):
    assert spark.createDataFrame([("est",)], "z string").select(Fn.label("z")).first()[0] == "EST"


def test_json_scalar(spark):
    df = spark.createDataFrame([('{"k": 7}',), ('{"k": "x"}',), ('{"j": 1}',), ("not json",)], "p string")
    got = [r[0] for r in df.select(Fn.json_scalar("p", "k", cast="int")).collect()]
    assert got == [7, None, None, None]
    assert df.select(Fn.json_scalar("p", "k")).collect()[1][0] == "x"


def test_try_casts(spark):
    df = spark.createDataFrame([("12",), ("1.5",), ("abc",)], "s string")
    assert [r[0] for r in df.select(Fn.try_int("s")).collect()] == [12, None, None]
    assert [r[0] for r in df.select(Fn.try_double("s")).collect()] == [12.0, 1.5, None]


def test_without_separator_fails_job(spark):
    df = spark.createDataFrame([("a,b",)], "s string")
    with pytest.raises(Exception, match="separator"):
        df.select(Fn.without_separator("s")).collect()


def test_normalize_key_text_matches_column_version(spark):
    samples = [" A", "b\tC", "x y", "n b", "s\u001ct", "p q", "r s", "MiXeD  Case\n", "u　v"]
    df = spark.createDataFrame([(r,) for r in samples], "k string")
    got = [r[0] for r in df.select(Fn.normalize_key("k")).collect()]
    assert got == [Fn.normalize_key_text(r) for r in samples]


def test_json_scalar_keys_are_taken_literally(spark):
    from faceoff.functions.text import json_scalar

    df = spark.createDataFrame([('{"a.b": 1, "a": {"b": 2}, "it\'s": "x"}',)], "doc string")
    got = df.select(json_scalar("doc", "a.b").alias("x"), json_scalar("doc", "it's").alias("y"), json_scalar("doc", "none").alias("z")).first()
    assert tuple(got) == ("1", "x", None)


def test_instants_with_long_fractions_and_offsets(spark):
    from faceoff.functions.clock import parse_utc_instant

    texts = ["2021-03-01T23:00:00.1234567Z", "2021-03-01T23:00:00+00:00", "2021-03-01T23:00:00-05:30", "2021-03-01T23:00:00+0100",
             "2021-03-01T23:00:005Z", "2021-03-01T23:00:00.5", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_utc_instant("t").cast("string").alias("v"))
    assert [r["v"] for r in df.collect()] == [
        "2021-03-01 23:00:00.123456", "2021-03-01 23:00:00", "2021-03-02 04:30:00", "2021-03-01 22:00:00", None,
        "2021-03-01 23:00:00.5", None,
    ]


def test_java_trim_ends_at_the_end(spark):
    rows = [(" a b \n",), ("a \u2028",), ("a \u0085",), ("\x00a\x1f",), (" \t",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").coalesce(1).select(Fn.java_trim("t")).collect()]
    assert got == ["a b", "a \u2028", "a \u0085", "a", "", "", None]
