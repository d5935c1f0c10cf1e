"""Calendar, period arithmetic and densification.

The calendar is generated with ``sequence`` + ``explode`` from the span of
the data it densifies, so it never depends on a seeded date table and stays
proportional to the number of days (thousands of rows at most).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def week_of_year(d: Column) -> Column:
    """Sunday-first week number (strftime ``%U``): days before the first
    Sunday of the year are week 0."""
    return F.floor((F.dayofyear(d) + 6 - (F.dayofweek(d) - 1)) / 7).cast("int")


def calendar_columns(d: Column) -> list[Column]:
    """True calendar attributes of ``d`` (no one-day shift)."""
    return [
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        week_of_year(d).alias("week"),
        (F.dayofweek(d) - 1).alias("dayofweek"),  # 0 = Sunday
        F.dayofmonth(d).alias("day"),
    ]


def date_span(df: DataFrame, col: str = "d") -> DataFrame:
    """One row (lo, hi) with the first and last date of ``df`` -- a global
    aggregate, partial on every task, one row shuffled per task."""
    return df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))


def calendar_from_span(span: DataFrame, with_attrs: bool = True) -> DataFrame:
    """Explode a (lo, hi) row into one row per date ``d``."""
    cal = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    if with_attrs:
        cal = cal.select("d", *calendar_columns(F.col("d")))
    return cal


def calendar(spark, a: str | dt.date, b: str | dt.date, with_attrs: bool = True) -> DataFrame:
    """Dates ``a`` .. ``b`` inclusive."""
    span = spark.range(1).select(F.lit(a).cast("date").alias("lo"), F.lit(b).cast("date").alias("hi"))
    return calendar_from_span(span, with_attrs)


def day_number(d: Column) -> Column:
    """Days since 1970-01-01; a numeric key for range frames over dates."""
    return F.unix_date(d)


def week_start(d: Column) -> Column:
    """Sunday that starts the Sunday-Saturday week of ``d``."""
    return F.date_sub(d, (F.dayofweek(d) - 1))


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def period_start(d: Column, kind: str) -> Column:
    if kind == "day":
        return d
    if kind == "week":
        return week_start(d)
    if kind == "month":
        return month_start(d)
    raise ValueError(kind)


def period_end(start: Column, kind: str) -> Column:
    if kind == "day":
        return start
    if kind == "week":
        return F.date_add(start, 6)
    if kind == "month":
        return F.last_day(start)
    raise ValueError(kind)


def period_index(d: Column, kind: str) -> Column:
    """Integer index of the period holding ``d``; differences of indexes are
    period offsets (day, Sunday week, calendar month)."""
    if kind == "day":
        return F.unix_date(d)
    if kind == "week":
        # 1970-01-04 was a Sunday
        return F.floor((F.unix_date(d) - 3) / 7).cast("int")
    if kind == "month":
        return (F.year(d) * 12 + F.month(d) - 1).cast("int")
    raise ValueError(kind)


# ---------------------------------------------------------------------------
# driver-side report parameters (plain date math on two scalars)
# ---------------------------------------------------------------------------

def period_bounds(kind: str, asof: dt.date) -> tuple[dt.date, dt.date]:
    """The last complete Sunday-Saturday week before ``asof``, the last
    calendar month, the trailing 7 days, or the day before."""
    if kind == "week":
        # Saturday on or before asof - 1
        end = asof - dt.timedelta(days=1)
        end = end - dt.timedelta(days=(end.weekday() + 2) % 7)
        return end - dt.timedelta(days=6), end
    if kind == "month":
        first_this = asof.replace(day=1)
        end = first_this - dt.timedelta(days=1)
        return end.replace(day=1), end
    if kind == "7day":
        return asof - dt.timedelta(days=7), asof - dt.timedelta(days=1)
    if kind == "day":
        y = asof - dt.timedelta(days=1)
        return y, y
    raise ValueError(kind)


NAMED_RANGE_DAYS = {"7day": 6, "1month": 31, "3month": 92}  # fixed values


def named_range(name: str, asof: dt.date, product_start: dt.date | None = None,
                a: dt.date | None = None, b: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """Named report ranges; an explicit range is swapped when reversed
    and clamped to the product start."""
    if name in NAMED_RANGE_DAYS:
        lo, hi = asof - dt.timedelta(days=NAMED_RANGE_DAYS[name]), asof
    elif name == "all":
        lo, hi = product_start or asof, asof
    elif name == "any":
        lo, hi = min(a, b), max(a, b)
    else:
        raise ValueError(name)
    if product_start is not None and lo < product_start:
        lo = product_start
    return lo, hi
