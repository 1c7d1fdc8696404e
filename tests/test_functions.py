import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelforge import functions as pf


def test_safe_cast_tolerant(spark):
    df = spark.createDataFrame([(" 12 ",), ("12.7",), ("N/A",), ("",), (None,), ("+3",)], "s string")
    got = [r.v for r in df.select(pf.safe_cast("s", "int").alias("v")).collect()]
    assert got == [12, None, None, None, None, 3]


def test_parse_timestamp_and_date(spark):
    df = spark.createDataFrame([("2024-01-15T10:20:30.000",), ("junk",), ("2024-01-15 23:59:59.500",)], "s string")
    got = [r.t for r in df.select(pf.parse_timestamp("s").alias("t")).collect()]
    assert got[0] == dt.datetime(2024, 1, 15, 10, 20, 30)
    assert got[1] is None
    assert got[2] == dt.datetime(2024, 1, 15, 23, 59, 59, 500000)
    d = spark.createDataFrame([("2020-01-31",), ("20xx-note",)], "s string")
    assert [r.d for r in d.select(pf.parse_date("s").alias("d")).collect()] == [dt.date(2020, 1, 31), None]


def test_rates_and_changes(spark):
    df = spark.createDataFrame([(10, 1000, 2.0, 1.0), (5, 0, 1.0, 0.0), (5, None, None, 2.0)],
                               "n int, pop int, cur double, prev double")
    out = df.select(pf.rate_per_k("n", "pop").alias("r"),
                    pf.relative_change("cur", "prev").alias("d"),
                    pf.signal_product("cur", "prev").alias("s")).collect()
    assert out[0].r == pytest.approx(10.0) and out[0].d == pytest.approx(1.0)
    assert out[1].r is None and out[1].d is None
    assert out[2].r is None and out[2].d is None and out[2].s is None


def test_closed_day_window_loses_last_fraction(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 23, 59, 59, 500000),),
                                (dt.datetime(2024, 1, 15, 0, 0),)], "t timestamp_ntz")
    closed = df.filter(pf.in_day("t", "2024-01-15", closed=True)).count()
    half = df.filter(pf.in_day("t", "2024-01-15", closed=False)).count()
    assert (closed, half) == (1, 2)
    assert df.filter(pf.in_year("t", 2024, closed=False)).count() == 2


def test_round_doubles_only_touches_doubles(spark):
    df = spark.createDataFrame([(1, 0.1234567891, "x")], "a int, b double, c string")
    r = pf.round_doubles(df, 3).collect()[0]
    assert (r.a, r.b, r.c) == (1, 0.123, "x")


def test_closed_and_half_open_windows(spark):
    df = spark.createDataFrame([(1,), (5,), (10,)], "x int")
    assert df.filter(pf.closed_window("x", 1, 10)).count() == 3
    assert df.filter(pf.half_open_window("x", 1, 10)).count() == 2


def test_day_slice_relative_to_today(spark):
    today = dt.date.today()
    two = today - dt.timedelta(days=2)
    rows = [(dt.datetime(two.year, two.month, two.day, 5),),
            (dt.datetime(two.year, two.month, two.day, 23, 59, 59, 500000),),
            (dt.datetime(today.year, today.month, today.day, 1),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    assert df.filter(pf.in_day("t", pf.days_ago(2), closed=True)).count() == 1
    assert df.filter(pf.in_day("t", pf.days_ago(2))).count() == 2
    assert df.filter(pf.in_day("t", two.isoformat(), closed=False)).count() == 2
