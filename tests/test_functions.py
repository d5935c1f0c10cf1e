"""Scalar helpers: calendar, periods, ratios, buckets, named ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from usagelens.functions import calendar as C
from usagelens.functions import ratios as RA
from usagelens.functions.buckets import bucketize
from usagelens.sources import registry as R


def test_week_of_year_matches_strftime_u(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(0, 800, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: r.w for r in df.select("d", C.week_of_year(F.col("d")).alias("w")).collect()}
    for d in days:
        assert got[d] == int(d.strftime("%U")), d


def test_calendar_attributes(spark):
    cal = C.calendar(spark, "2019-12-29", "2020-01-05").collect()
    assert len(cal) == 8
    new_year = [r for r in cal if r.d == dt.date(2020, 1, 1)][0]
    assert (new_year.year, new_year.quarter, new_year.month, new_year.day) == (2020, 1, 1, 1)
    assert new_year.dayofweek == 3  # Wednesday, 0 = Sunday
    sunday = [r for r in cal if r.d == dt.date(2019, 12, 29)][0]
    assert sunday.dayofweek == 0


def test_period_index_and_start(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),), (dt.date(2024, 2, 29),)], "d date")
    rows = df.select("d", C.period_index(F.col("d"), "week").alias("w"),
                     C.week_start(F.col("d")).alias("ws"),
                     C.period_index(F.col("d"), "month").alias("m")).collect()
    sat, sun, leap = rows
    assert sun.w == sat.w + 1                       # Sunday starts a new week
    assert sat.ws == dt.date(2023, 12, 31) and sun.ws == dt.date(2024, 1, 7)
    assert leap.m - sat.m == 1


def test_month_end_clamp(spark):
    r = spark.sql("SELECT add_months(DATE'2020-01-31', 1) AS a, last_day(DATE'2020-02-10') AS b").collect()[0]
    assert r.a == dt.date(2020, 2, 29) and r.b == dt.date(2020, 2, 29)


def test_period_bounds_and_named_range():
    wed = dt.date(2024, 1, 17)
    assert C.period_bounds("week", wed) == (dt.date(2024, 1, 7), dt.date(2024, 1, 13))
    assert C.period_bounds("month", wed) == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))
    assert C.period_bounds("day", wed) == (dt.date(2024, 1, 16),) * 2
    assert C.named_range("7day", wed) == (dt.date(2024, 1, 11), wed)
    assert C.named_range("any", wed, a=dt.date(2024, 1, 20), b=dt.date(2024, 1, 2)) == \
        (dt.date(2024, 1, 2), dt.date(2024, 1, 20))
    assert C.named_range("3month", wed, product_start=dt.date(2024, 1, 1))[0] == dt.date(2024, 1, 1)


def test_ratio_zero_denominator_and_rounding(spark):
    df = spark.createDataFrame([(1, 0), (1, 8), (57, 200), (2, 3), (0, 0)], "n long, d long")
    rows = df.select(RA.ratio(F.col("n"), F.col("d")).alias("r"),
                     RA.pct_round(F.col("n"), F.col("d"), 1).alias("p"),
                     RA.format_pct(F.col("n"), F.col("d"), 1).alias("s")).collect()
    assert rows[0].r is None and rows[0].p is None and rows[0].s == "--"
    assert rows[1].p == 12.5
    assert rows[2].p == 28.5          # 28.5 exactly, no binary drift
    assert rows[3].p == 66.7 and rows[3].s == "66.7%"
    assert rows[4].r is None


def test_bucket_edges(spark):
    durs = spark.createDataFrame([(2999,), (3000,), (1799999,), (1800000,)], "v long")
    got = dict(bucketize(durs, "v", R.USAGE_BUCKETS, "left").select("v", "bucket_id").collect())
    assert got == {2999: 1, 3000: 2, 1799999: 7, 1800000: 8}
    launches = spark.createDataFrame([(2,), (3,), (49,), (50,)], "v long")
    got = dict(bucketize(launches, "v", R.LAUNCH_BUCKETS, "both").select("v", "bucket_id").collect())
    assert got == {2: 1, 3: 2, 49: 5, 50: 6}


def test_densify_asof_reads_before_range_and_fills_gaps(spark):
    from usagelens.functions.densify import densify
    rows = [(1, dt.date(2024, 1, 1), 5, 10), (1, dt.date(2024, 1, 4), 2, 12), (2, dt.date(2024, 1, 3), 1, 1)]
    k = spark.createDataFrame(rows, "product_id int, d date, n long, total long")
    out = {(r.product_id, r.d): (r.n, r.total) for r in
           densify(k, ["product_id"], ["n"], ["total"], lo=F.lit("2024-01-02").cast("date")).collect()}
    assert out[(1, dt.date(2024, 1, 2))] == (0, 10)     # as-of value from before the range
    assert out[(1, dt.date(2024, 1, 3))] == (0, 10)
    assert out[(1, dt.date(2024, 1, 4))] == (2, 12)
    assert out[(2, dt.date(2024, 1, 2))] == (0, 0)      # nothing known yet
    assert (1, dt.date(2024, 1, 1)) not in out          # rows before the range are not reported
