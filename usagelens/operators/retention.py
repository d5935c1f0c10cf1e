"""Cohorts, retention and period active ratios.

Retention is one join instead of the reference's 8 x 2 dynamic statements:
first launches (a partial aggregate per (product, device)) are joined to the
device's distinct active periods, the period offset is computed, and counts
with the offset as a key give every
(cohort, product[, version][, channel], offset) number; a pivot with fixed
offsets 1..depth turns offsets into columns.

Grouping sets follow the reference's two unioned rollups:
(p, v, c), (p, v), (p, c), (p), () -- totals are marked with
product_id = -1 and version/channel = 'all' via ``grouping()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.calendar import period_end, period_index, period_start
from usagelens.functions.ratios import pct_round, ratio
from usagelens.operators.kpis import first_launch, only_active

PREFIX = {"day": "day", "week": "week", "month": "month"}


def _with_channel(df: DataFrame) -> DataFrame:
    return df.withColumn("channel", F.col("channel_id").cast("string"))


def _rollup_count(df: DataFrame, extra: list[str], out: str) -> DataFrame:
    """count(distinct device) over the five grouping sets, totals marked.

    Rows of a device are one group where they lie (``df`` is dealt by product
    and device): the versions, channels and pairs of a device are made distinct
    there, and each is then one of a plain count with a partial aggregate.  Only
    the set over all products has devices that meet from elsewhere, so only there
    are devices shuffled, once and without the other sets.
    """
    null = F.lit(None).cast("string")
    entry = lambda v, c, gv, gc: F.struct(v.alias("version"), c.alias("channel"), F.lit(gv).alias("gv"), F.lit(gc).alias("gc"))
    own = lambda name: F.array_distinct(F.transform("pairs", lambda p: p[name]))
    sets = F.concat(F.transform("pairs", lambda p: entry(p["version"], p["channel"], 0, 0)),
                    F.transform(own("version"), lambda v: entry(v, null, 0, 1)),
                    F.transform(own("channel"), lambda c: entry(null, c, 1, 0)), F.array(entry(null, null, 1, 1)))
    device = df.groupBy("product_id", "device_id", *extra).agg(F.collect_set(F.struct("version", "channel")).alias("pairs"))
    each = device.select(*extra, "product_id", F.explode(sets).alias("s"), F.col("device_id").isNotNull().cast("int").alias("one"))
    by_product = each.groupBy(*extra, "product_id", "s.version", "s.channel", "s.gv", "s.gc").agg(F.sum("one").alias(out))
    whole = df.select(*extra, "device_id").distinct().groupBy(*extra).agg(F.count("device_id").alias(out))
    return by_product.select(
        *extra, "product_id", F.when(F.col("gv") == 1, F.lit("all")).otherwise(F.col("version")).alias("version"),
        F.when(F.col("gc") == 1, F.lit("all")).otherwise(F.col("channel")).alias("channel"), F.col(out).cast("bigint").alias(out)) \
        .unionByName(whole.select(*extra, F.lit(-1).cast(df.schema["product_id"].dataType).alias("product_id"), F.lit("all").alias("version"),
                                  F.lit("all").alias("channel"), F.col(out).cast("bigint").alias(out)))


def cohort_size(launch: DataFrame, active: DataFrame | None, kind: str = "day",
                keys: DataFrame | None = None) -> DataFrame:
    """Distinct new devices per cohort period by the grouping sets,
    keyed by the new launch's version and channel.  ``keys`` may pass a
    prepared ``launch_keys`` table (e.g. derived from the bucketed rollup)."""
    keys = keys if keys is not None else launch_keys(launch)
    firsts = only_active(first_launch(keys, ["product_id"]), active)
    firsts = _with_channel(firsts).withColumn("cohort_start", period_start(F.col("d"), kind))
    return _rollup_count(firsts, ["cohort_start"], "usercount")


def launch_keys(launch: DataFrame) -> DataFrame:
    """Distinct (entry, device, day) with the day's smallest launch id -- the
    only launch attributes cohorting needs (partial aggregate)."""
    return (launch.groupBy("product_id", "channel_id", "version", "device_id", "d")
            .agg(F.min("launch_id").alias("first_id")))


def keys_from_rollup(rollup: DataFrame) -> DataFrame:
    """``launch_keys`` from the device-hour rollup; on the bucketed rollup this
    aggregate and everything per device after it run without a shuffle."""
    return (rollup.groupBy("product_id", "channel_id", "version", "device_id", "d")
            .agg(F.min("first_id").alias("first_id")))


def retention(launch: DataFrame, active: DataFrame | None, kind: str = "day", depth: int = 8,
              keys: DataFrame | None = None) -> DataFrame:
    """(cohort_start, product_id, version, channel, usercount,
    <kind>1..<kind>depth).

    <kind>N counts devices active in period cohort+N whose new (first) launch
    fell in the cohort period, grouped by the version/channel of the return
    visit; usercount groups new devices by the new launch's version/channel.

    The cohort rows (offset 0, keyed by the new launch) and the return rows
    (offset 1..depth, keyed by the visit) are counted apart, each where the
    device's rows lie, then pivoted on the fixed offsets 0..depth.
    """
    keys = keys if keys is not None else launch_keys(launch)
    firsts = only_active(first_launch(keys, ["product_id"]), active)
    cohort = firsts.select("product_id", "device_id",
                           period_index(F.col("d"), kind).alias("_pf"),
                           period_start(F.col("d"), kind).alias("cohort_start"),
                           F.col("version").alias("_fv"), F.col("channel_id").cast("string").alias("_fc"))
    act = (_with_channel(only_active(keys, active))
           .select("product_id", "device_id", "version", "channel",
                   period_index(F.col("d"), kind).alias("_pa"))
           .distinct())
    returned = (act.join(cohort, ["product_id", "device_id"])
                .withColumn("offset", F.col("_pa") - F.col("_pf"))
                .where(F.col("offset").between(1, depth))
                .select("product_id", "device_id", "version", "channel", "cohort_start", "offset"))
    new = cohort.select("product_id", "device_id", F.col("_fv").alias("version"), F.col("_fc").alias("channel"),
                        "cohort_start", F.lit(0).alias("offset"))
    counts = _rollup_count(new, ["cohort_start", "offset"], "n").unionByName(_rollup_count(returned, ["cohort_start", "offset"], "n"))
    prefix = PREFIX[kind]
    wide = (counts.groupBy("cohort_start", "product_id", "version", "channel")
            .pivot("offset", list(range(0, depth + 1))).agg(F.first("n")))
    names = {"0": "usercount", **{str(k): f"{prefix}{k}" for k in range(1, depth + 1)}}
    return wide.select("cohort_start", "product_id", "version", "channel",
                       *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias(n) for c, n in names.items()])


def retention_report(ret: DataFrame, product_id=None, version: str = "all", channel: str = "all",
                     a=None, b=None, kind: str = "day") -> DataFrame:
    """Rows of one (product, version, channel) whose cohort period lies
    whole in [a, b], newest first."""
    df = ret.where((F.col("version") == version) & (F.col("channel") == channel))
    if product_id is not None:
        df = df.where(F.col("product_id") == product_id)
    if a is not None:
        df = df.where(F.col("cohort_start") >= F.lit(a).cast("date"))
    if b is not None:
        df = df.where(period_end(F.col("cohort_start"), kind) <= F.lit(b).cast("date"))
    return df.orderBy(F.col("cohort_start").desc(), "product_id")


def retention_pct(ret: DataFrame, kind: str = "day", depth: int = 8) -> DataFrame:
    """<kind>N / usercount * 100 rounded to one decimal (NULL when the
    cohort is empty)."""
    prefix = PREFIX[kind]
    return ret.select("cohort_start", "product_id", "version", "channel", "usercount",
                      *[pct_round(F.col(f"{prefix}{k}"), F.col("usercount"), 1).alias(f"{prefix}{k}_pct")
                        for k in range(1, depth + 1)])


def active_ratio(launch: DataFrame, active: DataFrame | None, kind: str = "week",
                 by: list[str] = ("product_id",), keys: DataFrame | None = None) -> DataFrame:
    """Per period and key, distinct active devices and their share of
    all devices seen up to the period end (cumulative distinct = running sum
    of first-seen counts)."""
    by = list(by)
    keys = only_active(keys if keys is not None else launch_keys(launch), active)
    per = keys.select(*by, "device_id", period_start(F.col("d"), kind).alias("period_start")).distinct()
    act = per.groupBy(*by, "period_start").agg(F.count(F.lit(1)).alias("activeusers"))
    first = (per.groupBy(*by, "device_id").agg(F.min("period_start").alias("period_start"))
             .groupBy(*by, "period_start").agg(F.count(F.lit(1)).alias("_new")))
    from pyspark.sql import Window
    w = Window.partitionBy(*by).orderBy("period_start").rowsBetween(Window.unboundedPreceding, 0)
    out = (act.join(first, [*by, "period_start"], "left")
           .withColumn("_cum", F.sum(F.coalesce("_new", F.lit(0))).over(w)))
    return out.select(*by, "period_start", F.col("activeusers").cast("bigint").alias("activeusers"),
                      F.col("_cum").cast("bigint").alias("allusers"),
                      ratio(F.col("activeusers"), F.col("_cum")).alias("percent"))
