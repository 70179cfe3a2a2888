import math

from pyspark.sql import functions as F

from kestrel import functions as kf


def test_two_format_times_flags(spark):
    rows = [("01-31-2017 07:00:00",), ("02/01/2017 12:00:00 AM",), ("02/01/2017 12:00:00 PM",),
            ("02/04/2017 05:30:00 PM",), ("garbage",), (None,)]
    df = spark.createDataFrame(rows, "s string").select(
        "s", kf.parse_trip_ts("s").alias("ts"))
    out = df.select("s", kf.in_month("ts", 1).alias("jan"), kf.in_month("ts", 2).alias("feb"),
                    kf.peak_time("ts").alias("peak"), kf.is_weekend("ts").alias("wk"),
                    F.hour("ts").alias("h")).collect()
    got = {r["s"]: (r["jan"], r["feb"], r["peak"], r["wk"], r["h"]) for r in out}
    assert got["01-31-2017 07:00:00"] == (True, False, 1, 0, 7)
    assert got["02/01/2017 12:00:00 AM"] == (False, True, 0, 0, 0)
    assert got["02/01/2017 12:00:00 PM"] == (False, True, 0, 0, 12)
    assert got["02/04/2017 05:30:00 PM"] == (False, True, 1, 1, 17)   # Saturday, peak
    assert got["garbage"] == (False, False, -1, 0, None)
    assert got[None] == (False, False, -1, 0, None)


def test_text_hour_flag(spark):
    df = spark.createDataFrame([("2009-06-15 17:26:21 UTC",), ("2009-06-15 03:26:21",), ("x",), (None,)], "s string")
    got = [r[0] for r in df.select(kf.peak_flag_text("s")).collect()]
    assert got == [1, 0, 0, 0]


def test_money_and_casts(spark):
    df = spark.createDataFrame([("1,234.50",), ("-3",), ("abc",), (None,)], "s string")
    got = [r[0] for r in df.select(kf.money_to_double("s")).collect()]
    assert got == [1234.5, -3.0, None, None]


def test_haversine(spark):
    df = spark.createDataFrame([(10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0), (None, 1.0, 2.0, 3.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(kf.haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0
    assert math.isclose(got[1], math.pi * 6371.0, rel_tol=1e-12)   # antipodes ≈ 20015.09 km
    assert got[2] is None


def test_quarter_and_month_labels(spark):
    df = spark.createDataFrame([("2000Q1",), ("2001Q4",), ("2000Q5",), ("junk",)], "s string")
    got = [str(r[0]) if r[0] else None for r in df.select(kf.quarter_start("s")).collect()]
    assert got == ["2000-01-01", "2001-10-01", None, None]
    m = spark.createDataFrame([("1949-03",)], "s string").select(kf.parse_month("s")).first()[0]
    assert (m.year, m.month, m.day) == (1949, 3, 1)


def test_future_periods_and_caps(spark):
    df = spark.createDataFrame([("2001-07-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    got = df.select(kf.future_periods("d", 3, 3)).first()[0]
    assert [str(x) for x in got] == ["2001-10-01", "2002-01-01", "2002-04-01"]
    t = spark.createDataFrame([("  a  b   c ",), ("",)], "t string")
    assert [r[0] for r in t.select(kf.cap_tokens("t", 2)).collect()] == ["a b", ""]
    q = spark.createDataFrame([("q", "a"), (None, "a")], "q string, a string")
    assert [r[0] for r in q.select(kf.instruction_text("q", "a")).collect()] == ["question: q answer: a", None]
