"""KPI report reads.

Reports read the daily summaries (``kpis.daily_kpis``) or the fact; every
dense grid is an explode of a date sequence per key row (no join to a
calendar table), every as-of read is a running max over the grid, and
"today" is the last day of the data taken as a scalar subquery -- nothing
is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.calendar import week_of_year
from usagelens.functions.densify import densify, span_bounds
from usagelens.functions.ratios import pct_round, ratio
from usagelens.operators.distribution import in_range
from usagelens.operators.kpis import only_active

KPI_METRICS = ["sessions", "startusers", "newusers", "upgradeusers", "usingtime"]
ASOF = ["allusers", "allsessions"]


def last_day(df: DataFrame, col: str = "d") -> Column:
    """Scalar subquery: the latest day present in ``df``."""
    return df.select(F.max(col)).scalar()


def derive_ratios(kpis: DataFrame) -> DataFrame:
    """new/active percentage (1 decimal) and average session seconds
    usingtime / sessions / 1000 (0 without sessions)."""
    return kpis.withColumns({
        "new_pct": F.coalesce(pct_round(F.col("newusers"), F.col("startusers"), 1), F.lit(0.0)),
        "avg_session_s": F.coalesce(ratio(F.col("usingtime"), F.col("sessions") * 1000), F.lit(0.0)),
    })


def kpi_detail(kpis: DataFrame, span_src: DataFrame | None = None, key_rows: DataFrame | None = None) -> DataFrame:
    """R2: dense series with derived ratios, newest first."""
    dense = densify(kpis, ["product_id"], KPI_METRICS, ASOF, key_rows=key_rows, span_src=span_src)
    return derive_ratios(dense).orderBy(F.col("d").desc(), "product_id")


def owner_series(kpis: DataFrame, products: DataFrame, span_src: DataFrame | None = None,
                 key_rows: DataFrame | None = None) -> DataFrame:
    """KPIs summed over all apps of each owner, dense by day; cumulative
    users are the sum of each app's as-of value."""
    dense = densify(kpis, ["product_id"], KPI_METRICS, ASOF, key_rows=key_rows, span_src=span_src)
    own = products.select("product_id", "owner_id")
    return (dense.join(own, "product_id")
            .groupBy("owner_id", "d")
            .agg(*[F.sum(c).cast("bigint").alias(c) for c in ["newusers", "startusers", "sessions",
                                                              "usingtime", "allusers"]]))


def snapshot(kpis: DataFrame, keys: list[str], key_rows: DataFrame | None = None,
             day: Column | None = None) -> DataFrame:
    """The values of the last day of data per key with as-of
    cumulative users; keys without data that day show 0 (``key_rows`` lists
    the keys to report, e.g. the registry's channels).  ``day`` defaults to
    the last day of ``kpis``; pass ``last_day(raw_log)`` to take it from a
    one-column scan instead of a second evaluation of the summary."""
    day = last_day(kpis) if day is None else day
    kr = key_rows if key_rows is not None else kpis.select(*keys).distinct()
    asof = (kpis.where(F.col("d") <= day).groupBy(*keys)
            .agg(F.max("allusers").alias("allusers")))
    today = kpis.where(F.col("d") == day).select(*keys, *KPI_METRICS)
    out = kr.join(today, keys, "left").join(asof, keys, "left")
    return out.select(*keys, day.alias("d"),
                      *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                        for c in KPI_METRICS + ["allusers"]])


def channel_series(kpis_channel: DataFrame, channels: DataFrame, span_src: DataFrame | None = None) -> DataFrame:
    """Dense (registry channel x day) grid with KPIs and as-of users."""
    kr = channels.select("product_id", "channel_id")
    return densify(kpis_channel, ["product_id", "channel_id"], KPI_METRICS, ASOF, key_rows=kr, span_src=span_src)


def version_series(kpis_version: DataFrame, span_src: DataFrame | None = None,
                   key_rows: DataFrame | None = None) -> DataFrame:
    """Dense (version x day) grid of active and new devices."""
    return densify(kpis_version.select("product_id", "version", "d", "startusers", "newusers"),
                   ["product_id", "version"], ["startusers", "newusers"], key_rows=key_rows, span_src=span_src)


def channel_active_sum(kpis_channel: DataFrame, channels: DataFrame, a=None, b=None) -> DataFrame:
    """R8/R24-style: sum of daily active devices per registry channel over a
    range, 0 for channels without data."""
    s = (in_range(kpis_channel, a, b).groupBy("product_id", "channel_id")
         .agg(F.sum("startusers").alias("active_sum")))
    return (channels.select("product_id", "channel_id", "channel_name")
            .join(s, ["product_id", "channel_id"], "left")
            .select("product_id", "channel_id", "channel_name",
                    F.coalesce("active_sum", F.lit(0)).cast("bigint").alias("active_sum")))


def rolling_actives(kpis_channel: DataFrame, channels: DataFrame, days: int = 7,
                    span_src: DataFrame | None = None) -> DataFrame:
    """Per channel and day, the sum of daily active devices over the
    trailing ``days`` days (a sum of DAU, as the reference reports it) and
    the as-of cumulative users."""
    dense = channel_series(kpis_channel, channels, span_src)
    w = (Window.partitionBy("product_id", "channel_id").orderBy(F.unix_date("d"))
         .rangeBetween(-(days - 1), 0))
    return dense.select("product_id", "channel_id", "d",
                        F.sum("startusers").over(w).cast("bigint").alias(f"active_{days}d"),
                        "allusers")


def channel_ratio_series(ratios: DataFrame, channels: DataFrame, kind: str = "week") -> DataFrame:
    """Channel active ratio per period start, dense over (registry
    channel x every period start from the first to the last), 0 where a
    channel had no active devices in that period."""
    step = F.expr("INTERVAL 7 DAYS") if kind == "week" else F.expr("INTERVAL 1 MONTH")
    lo, hi = span_bounds(ratios, "period_start")
    grid = channels.select("product_id", "channel_id", F.explode(F.sequence(lo, hi, step)).alias("period_start"))
    out = grid.join(ratios, ["product_id", "channel_id", "period_start"], "left")
    return out.select("product_id", "channel_id", "period_start",
                      F.coalesce("activeusers", F.lit(0)).cast("bigint").alias("activeusers"),
                      F.coalesce("percent", F.lit(0.0)).alias("percent"))


def channel_ratio_at(ratios: DataFrame, channels: DataFrame, start) -> DataFrame:
    """Active ratio of every registry channel in the period that begins at
    ``start``, 0 where it has none."""
    at = ratios.where(F.col("period_start") == F.lit(start).cast("date")).select("product_id", "channel_id", "percent")
    return channels.select("product_id", "channel_id").join(at, ["product_id", "channel_id"], "left") \
        .select("product_id", "channel_id", F.coalesce("percent", F.lit(0.0)).alias("percent"))


def ratio_window(kind: str, a, b, shifted: bool = True) -> tuple[Column, Column]:
    """First and last period start that a report over [a, b] shows: periods that
    have ended by then (R10), or those from one period before ``a`` on (R12)."""
    a, b = F.lit(a).cast("date"), F.lit(b).cast("date")
    if not shifted:
        return (F.date_sub(a, 7) if kind == "week" else F.add_months(a, -1)), b
    if kind == "week":
        return F.date_sub(a, 13), F.date_sub(b, 7)
    return F.date_add(F.add_months(a, -2), 1), F.add_months(b, -1)


def channel_ratio_window(ratios: DataFrame, channels: DataFrame, kind: str, a, b) -> DataFrame:
    """Channel active ratios over a report range, whose window is
    shifted to periods that have ended; every registry channel for every period
    that its product has ratios of, 0 where a channel has none."""
    lo, hi = ratio_window(kind, a, b)
    rows = ratios.where(F.col("period_start").between(lo, hi))
    grid = channels.select("product_id", "channel_id", "channel_name").join(rows.select("product_id", "period_start").distinct(), "product_id")
    return grid.join(rows.select("product_id", "channel_id", "period_start", "percent"), ["product_id", "channel_id", "period_start"], "left") \
        .select("product_id", "channel_id", "channel_name", "period_start", F.coalesce("percent", F.lit(0.0)).alias("percent"))


def ratio_keys(ratios: DataFrame, channels: DataFrame, kind: str, a, b) -> DataFrame:
    """Period starts, with the names of the channels, that have ratio rows in a report range."""
    lo, hi = ratio_window(kind, a, b, shifted=False)
    return ratios.where(F.col("period_start").between(lo, hi)).join(channels, ["product_id", "channel_id"]) \
        .select("product_id", "period_start", "channel_name").distinct()


def fact_series(rollup: DataFrame, keys: list[str], a, b, key_rows: DataFrame, new: DataFrame) -> DataFrame:
    """Dense series of [a, b] from the fact: active devices (each once a
    day and key), starts and new users; ``new`` holds first launches (keys, d)."""
    rows = in_range(rollup, a, b)
    device_day = rows.groupBy(*keys, "d", "device_id").agg(F.sum("n").alias("starts"))
    counts = device_day.groupBy(*keys, "d").agg(F.count("device_id").cast("bigint").alias("actives"), F.sum("starts").cast("bigint").alias("starts"))
    firsts = in_range(new, a, b).groupBy(*keys, "d").agg(F.count(F.lit(1)).cast("bigint").alias("newusers"))
    both = counts.unionByName(firsts, allowMissingColumns=True).groupBy(*keys, "d").agg(
        *[F.max(m).alias(m) for m in ("actives", "starts", "newusers")])
    return densify(both, keys, ["actives", "starts", "newusers"], lo=F.lit(a).cast("date"), hi=F.lit(b).cast("date"), key_rows=key_rows)


def portfolio(kpis: DataFrame, products: DataFrame, day: Column | None = None) -> DataFrame:
    """Every app with today's and yesterday's new users, launches and
    active devices (two-day conditional aggregation) and as-of users."""
    day = last_day(kpis) if day is None else day
    prev = F.date_sub(day, 1)
    two = kpis.where(F.col("d").between(prev, day))
    agg = two.groupBy("product_id").agg(
        *[F.sum(F.when(F.col("d") == day, F.col(m))).alias(f"{m}_today")
          for m in ("newusers", "sessions", "startusers")],
        *[F.sum(F.when(F.col("d") == prev, F.col(m))).alias(f"{m}_yesterday")
          for m in ("newusers", "sessions", "startusers")])
    asof = kpis.where(F.col("d") <= day).groupBy("product_id").agg(F.max("allusers").alias("allusers"))
    cols = [f"{m}_{t}" for t in ("today", "yesterday") for m in ("newusers", "sessions", "startusers")]
    return (products.select("product_id", "product_name", "platform")
            .join(agg, "product_id", "left").join(asof, "product_id", "left")
            .select("product_id", "product_name", "platform",
                    *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in cols],
                    F.coalesce("allusers", F.lit(0)).cast("bigint").alias("allusers")))


def hour_profile(hourly: DataFrame, by: list[str] = ("product_id",), a=None, b=None) -> DataFrame:
    """24 rows per key (zero filled): active devices, new devices
    and launches summed over the range by hour of day."""
    by = list(by)
    s = (in_range(hourly, a, b).groupBy(*by, "h")
         .agg(F.sum("startusers").alias("startusers"), F.sum("newusers").alias("newusers"),
              F.sum("sessions").alias("sessions")))
    grid = hourly.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
    return (grid.join(s, [*by, "h"], "left")
            .select(*by, "h", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                for c in ("startusers", "newusers", "sessions")]))


def version_contrast(kpis_version: DataFrame, r1: tuple, r2: tuple, n: int = 10) -> DataFrame:
    """Top-n versions of each range by active then new devices, with the
    share of the range total; the two ranges side by side."""
    parts = []
    for tag, (a, b) in (("r1", r1), ("r2", r2)):
        s = (in_range(kpis_version, a, b).groupBy("product_id", "version")
             .agg(F.sum("startusers").alias("active"), F.sum("newusers").alias("new")))
        tot = Window.partitionBy("product_id")
        rk = Window.partitionBy("product_id").orderBy(F.col("active").desc(), F.col("new").desc(), "version")
        parts.append(s.select("product_id", F.lit(tag).alias("range_id"), "version",
                              F.col("active").cast("bigint").alias("active"),
                              F.col("new").cast("bigint").alias("new"),
                              ratio(F.col("active"), F.sum("active").over(tot)).alias("active_share"),
                              ratio(F.col("new"), F.sum("new").over(tot)).alias("new_share"),
                              F.row_number().over(rk).alias("rank"))
                     .where(F.col("rank") <= n))
    return parts[0].unionByName(parts[1])


def endpoint_values(kpis: DataFrame, keys: list[str], nested: bool = False,
                    span_src: DataFrame | None = None) -> DataFrame:
    """Per key, the KPI values on the first and on the last day of
    the data (``endpoint`` = 'first' / 'last'); ``nested`` returns them as a
    day-ordered list of structs per key (the API shape)."""
    lo, hi = span_bounds(span_src if span_src is not None else kpis)
    ends = kpis.where(F.col("d").isin(lo, hi)).select(
        *keys, F.when(F.col("d") == lo, F.lit("first")).otherwise(F.lit("last")).alias("endpoint"),
        "d", "startusers", "newusers", "sessions")
    if not nested:
        return ends
    return (ends.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("d", "startusers", "newusers", "sessions")))
                 .alias("endpoints")))


def product_list(launch: DataFrame, products: DataFrame) -> DataFrame:
    """Each owner's apps with platform, first/last day seen and
    launches, newest id first."""
    s = launch.groupBy("product_id").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"),
                                         F.count(F.lit(1)).cast("bigint").alias("launches"))
    return (products.join(s, "product_id", "left")
            .select("owner_id", "product_id", "product_name", "platform", "first_day", "last_day",
                    F.coalesce("launches", F.lit(0)).cast("bigint").alias("launches"))
            .orderBy("owner_id", F.col("product_id").desc()))


def active_sum_to(kpis: DataFrame) -> DataFrame:
    """Cumulative sum of daily active devices up to each day."""
    w = Window.partitionBy("product_id").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    return kpis.select("product_id", "d", F.sum("startusers").over(w).cast("bigint").alias("active_sum"))


def active_devices(launch: DataFrame, by: list[str] = ("product_id", "channel_id"), a=None, b=None) -> DataFrame:
    """Distinct devices and launches per key over a range (all
    time when no range)."""
    by = list(by)
    return (in_range(launch, a, b).groupBy(*by)
            .agg(F.countDistinct("device_id").cast("bigint").alias("devices"),
                 F.count(F.lit(1)).cast("bigint").alias("launches")))


def day_counts(launch: DataFrame) -> DataFrame:
    """Per day, launches and active devices per (product, channel) and
    per product over all channels (channel_id -1)."""
    g = launch.groupingSets([["product_id", "channel_id", "d"], ["product_id", "d"]],
                            "product_id", "channel_id", "d")
    agg = g.agg(F.count(F.lit(1)).alias("launches"), F.countDistinct("device_id").alias("devices"),
                F.grouping("channel_id").alias("_g"))
    return agg.select("product_id",
                      F.when(F.col("_g") == 1, F.lit(-1)).otherwise(F.col("channel_id")).alias("channel_id"),
                      "d", F.col("launches").cast("bigint").alias("launches"),
                      F.col("devices").cast("bigint").alias("devices"))


def avg_session(pages: DataFrame, by: list[str] = ("product_id",), daily: bool = True) -> DataFrame:
    """Average session length = total duration / distinct sessions
    (per day, or over the whole range)."""
    by = list(by) + (["d"] if daily else [])
    return (pages.groupBy(*by)
            .agg(F.sum("duration_ms").alias("_t"), F.countDistinct("session_id").alias("sessions"))
            .select(*by, F.col("sessions").cast("bigint").alias("sessions"),
                    F.col("_t").cast("bigint").alias("duration_ms"),
                    ratio(F.col("_t"), F.col("sessions")).alias("avg_ms")))


def compare(kpis: DataFrame, metric: str, product_ids: list[int],
            span_src: DataFrame | None = None, key_rows: DataFrame | None = None) -> DataFrame:
    """One metric of several products side by side (pivot with the
    listed products as fixed values)."""
    return (densify(kpis.select("product_id", "d", metric), ["product_id"], [metric], span_src=span_src, key_rows=key_rows)
            .where(F.col("product_id").isin(product_ids))
            .groupBy("d").pivot("product_id", product_ids).agg(F.first(metric))
            .select("d", *[F.coalesce(F.col(str(p)), F.lit(0)).cast("bigint").alias(f"p{p}")
                           for p in product_ids]))


def compare_wide(kpis: DataFrame, metrics: list[str], product_ids: list[int],
                 span_src: DataFrame | None = None, key_rows: DataFrame | None = None) -> DataFrame:
    """Metric block x day x products: unpivot the metrics, pivot the
    products."""
    dense = densify(kpis.select("product_id", "d", *metrics), ["product_id"], metrics, span_src=span_src, key_rows=key_rows)
    long = dense.unpivot(["product_id", "d"], metrics, "metric", "value")
    return (long.where(F.col("product_id").isin(product_ids))
            .groupBy("metric", "d").pivot("product_id", product_ids).agg(F.first("value"))
            .select("metric", "d", *[F.coalesce(F.col(str(p)), F.lit(0)).cast("bigint").alias(f"p{p}")
                                     for p in product_ids]))


def page(df: DataFrame, order: list, index: int, size: int = 10000) -> DataFrame:
    """Page ``index`` (0-based) of ``size`` rows in ``order``."""
    return df.orderBy(*order).offset(index * size).limit(size)


def calendar_active_share(launch: DataFrame, active: DataFrame | None, kind: str = "week",
                          by: list[str] = ("product_id", "channel_id")) -> DataFrame:
    """Per key, year and week (Sunday-first) or month: active devices of
    the period and their share of distinct devices seen so far that year
    (running sum of first-seen counts within the year)."""
    by = list(by)
    per = F.col("week") if kind == "week" else F.col("month")
    rows = only_active(launch, active).select(
        *by, "device_id", F.year("d").alias("year"),
        (week_of_year(F.col("d")) if kind == "week" else F.month("d")).alias(kind)).distinct()
    act = rows.groupBy(*by, "year", kind).agg(F.count(F.lit(1)).alias("activeusers"))
    first = (rows.groupBy(*by, "year", "device_id").agg(F.min(per).alias(kind))
             .groupBy(*by, "year", kind).agg(F.count(F.lit(1)).alias("_new")))
    w = Window.partitionBy(*by, "year").orderBy(kind).rowsBetween(Window.unboundedPreceding, 0)
    out = act.join(first, [*by, "year", kind], "left").withColumn(
        "_cum", F.sum(F.coalesce("_new", F.lit(0))).over(w))
    return out.select(*by, "year", kind, F.col("activeusers").cast("bigint").alias("activeusers"),
                      F.col("_cum").cast("bigint").alias("year_users"),
                      ratio(F.col("activeusers"), F.col("_cum")).alias("share"))


def channel_share(launch: DataFrame, a=None, b=None, new_only: bool = False) -> DataFrame:
    """Per channel, distinct active (or new) devices in a range divided
    by the channel's distinct devices of all time."""
    keys = ["product_id", "channel_id"]
    # one row per device tells whether it counts, so the log is read once
    day = F.min("d") if new_only else F.col("d")
    hit = F.lit(True)
    hit = hit & (day >= F.lit(a).cast("date")) if a is not None else hit
    hit = hit & (day <= F.lit(b).cast("date")) if b is not None else hit
    device = launch.groupBy(*keys, "device_id").agg((hit if new_only else F.bool_or(hit)).alias("hit"))
    return (device.groupBy(*keys).agg(F.count(F.when(F.col("hit"), F.col("device_id"))).alias("devices"), F.count("device_id").alias("all_devices"))
            .select(*keys, F.col("devices").cast("bigint").alias("devices"), F.col("all_devices").cast("bigint").alias("all_devices"),
                    ratio(F.col("devices"), F.col("all_devices")).alias("share")))


def channel_vector(launch: DataFrame) -> DataFrame:
    """Per channel, new devices today and yesterday (first launch in the
    channel), active devices today and all-time devices -- one conditional
    aggregation over per-device first/last days."""
    keys = ["product_id", "channel_id"]
    day = last_day(launch)
    prev = F.date_sub(day, 1)
    dev = launch.groupBy(*keys, "device_id").agg(
        F.min("d").alias("first_d"), F.max(F.when(F.col("d") == day, 1)).alias("seen_today"))
    return dev.groupBy(*keys).agg(
        F.count(F.when(F.col("first_d") == day, 1)).cast("bigint").alias("new_today"),
        F.count(F.when(F.col("first_d") == prev, 1)).cast("bigint").alias("new_yesterday"),
        F.count(F.col("seen_today")).cast("bigint").alias("active_today"),
        F.count(F.lit(1)).cast("bigint").alias("all_users"))
