"""Crash analytics.

Rates divide crash counts by launch/session counts of the same key; both
sides are partial aggregates joined on small keys.  Breakdowns of a title
("brand within version", ...) are computed for every title at once with a
window total over (product, title, within) -- a report for one title is a
filter on the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.densify import date_grid, span_bounds
from usagelens.functions.ratios import ratio
from usagelens.operators.distribution import in_range
from usagelens.operators.kpis import only_active


def error_rate(crash: DataFrame, launch: DataFrame, by: str, active: DataFrame | None = None,
               top_n: int | None = None, a=None, b=None) -> DataFrame:
    """Crashes per key value (active entries) and crashes per
    launch with that value (version: launches = sessions of the version;
    os/brand: launches on that os/brand).  ``top_n`` keeps the largest
    counts (ties by name)."""
    errs = (only_active(in_range(crash, a, b), active)
            .groupBy("product_id", by).agg(F.count(F.lit(1)).alias("errorcount")))
    launches = in_range(launch, a, b).groupBy("product_id", by).agg(F.count(F.lit(1)).alias("launches"))
    out = errs.join(launches, ["product_id", by], "left").select(
        "product_id", by, F.col("errorcount").cast("bigint").alias("errorcount"),
        ratio(F.col("errorcount"), F.col("launches")).alias("percentage"))
    if top_n is not None:
        rk = Window.partitionBy("product_id").orderBy(F.col("errorcount").desc(), F.col(by))
        out = out.withColumn("rank", F.row_number().over(rk)).where(F.col("rank") <= top_n)
    return out


def error_series(crash: DataFrame, launch: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """Dense daily crash counts per product (active entries) and the
    ratio to the sessions of the whole span."""
    errs = only_active(crash, active).groupBy("product_id", "d").agg(F.count(F.lit(1)).alias("n"))
    total = launch.groupBy("product_id").agg(F.count(F.lit(1)).alias("_sessions"))
    lo, hi = span_bounds(crash)
    grid = date_grid(crash.select("product_id").distinct(), lo, hi)
    out = grid.join(errs, ["product_id", "d"], "left").join(total, "product_id", "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    return out.select("product_id", "d", n.cast("bigint").alias("errorcount"),
                      ratio(n, F.col("_sessions")).alias("per_session"))


def error_groups(crash: DataFrame, by: str, active: DataFrame | None = None, a=None, b=None) -> DataFrame:
    """Crash groups title x version/os/brand over active entries:
    count, last time seen, fixed flag, and one sample stack (the latest)."""
    rows = only_active(in_range(crash, a, b), active)
    return (rows.groupBy("product_id", "title", by)
            .agg(F.count(F.lit(1)).cast("bigint").alias("errorcount"),
                 F.max("ts").alias("last_seen"),
                 F.max(F.col("is_fixed").cast("int")).alias("is_fixed"),
                 F.max_by("stacktrace", F.struct("ts", "crash_id")).alias("sample_stack")))


def error_occurrences(crash: DataFrame, by: str, a=None, b=None) -> DataFrame:
    """Every occurrence listed newest first within (title, by value); a
    report of one title/value filters this and pages it.  A global sort
    (range partitioning samples the keys and splits a hot title across
    tasks) instead of a per-title window."""
    return (in_range(crash, a, b)
            .select("product_id", "title", by, "crash_id", "ts", "device_id")
            .orderBy("product_id", "title", by, F.col("ts").desc(), F.col("crash_id").desc()))


def error_breakdown(crash: DataFrame, by: str, within: str | None, a=None, b=None) -> DataFrame:
    """For each title, counts of ``by`` values within each
    ``within`` value (or within the whole title when ``within`` is None) and
    their share of that total."""
    keys = ["product_id", "title"] + ([within] if within else [])
    c = in_range(crash, a, b).groupBy(*keys, by).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*keys)
    return c.select(*keys, by, F.col("count").cast("bigint").alias("count"),
                    ratio(F.col("count"), F.sum("count").over(w)).alias("percentage"))
