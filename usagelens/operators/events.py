"""Custom events and funnels.

Funnel steps in the reference are independent event counts (a step is not
conditioned on the previous one for the same device); ``funnel_steps`` and
friends keep that meaning.  ``ordered_funnel`` (E15) is the per-device
ordered variant, offered as an extension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.densify import date_grid, span_bounds
from usagelens.functions.ratios import format_pct, pct_round, ratio, ratio_or_zero
from usagelens.operators.distribution import in_range


def event_fact(app_event: DataFrame, event_defs: DataFrame) -> DataFrame:
    """L4: events of defined, active definitions, with their names."""
    defs = (event_defs.where("active = 1")
            .select("product_id", "event_id", "event_identifier", "event_name"))
    return app_event.join(defs, ["product_id", "event_id"], "inner")


def event_counts(fact: DataFrame, event_defs: DataFrame, by_version: bool = False,
                 measure: str = "count", a=None, b=None) -> DataFrame:
    """Per product, every active event with its count (0 without
    data); ``by_version`` lists, per version, the events seen in it.
    ``measure`` 'count' counts rows, 'sum' sums ``num``."""
    m = F.count(F.lit(1)) if measure == "count" else F.sum("num")
    rows = in_range(fact, a, b)
    if by_version:
        return (rows.groupBy("product_id", "version", "event_id", "event_identifier")
                .agg(m.cast("bigint").alias("count")))
    cnt = rows.groupBy("product_id", "event_id").agg(m.alias("count"))
    defs = event_defs.where("active = 1").select("product_id", "event_id", "event_identifier", "event_name")
    return (defs.join(cnt, ["product_id", "event_id"], "left")
            .select("product_id", "event_id", "event_identifier", "event_name",
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def event_amounts(app_event: DataFrame, event_defs: DataFrame) -> DataFrame:
    """E5: sum of amounts per defined event over the raw event rows, in the
    amounts' own kind: whole numbers stay whole, fractions stay fractions."""
    amt = app_event.groupBy("product_id", "event_id").agg(F.sum("num").alias("amount"))
    return (event_defs.select("product_id", "event_id", "event_identifier")
            .join(amt, ["product_id", "event_id"], "left")
            .select("product_id", "event_id", "event_identifier",
                    F.coalesce(F.col("amount"), F.lit(0).cast(amt.schema["amount"].dataType)).alias("amount")))


def event_daily(fact: DataFrame, by: list[str] = ("product_id", "event_id")) -> DataFrame:
    """Event count per key and day."""
    return fact.groupBy(*by, "d").agg(F.count(F.lit(1)).cast("bigint").alias("count"))


def event_grid(fact: DataFrame, event_defs: DataFrame, lo=None, hi=None) -> DataFrame:
    """Dense (defined event x day) grid with counts, 0 where none.
    The day span defaults to the span of the data."""
    dlo, dhi = span_bounds(fact) if lo is None or hi is None else (None, None)
    lo = dlo if lo is None else F.lit(lo).cast("date") if not isinstance(lo, Column) else lo
    hi = dhi if hi is None else F.lit(hi).cast("date") if not isinstance(hi, Column) else hi
    grid = date_grid(event_defs.select("product_id", "event_id", "event_identifier"), lo, hi)
    return (grid.join(event_daily(fact), ["product_id", "event_id", "d"], "left")
            .select("product_id", "event_id", "event_identifier", "d",
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def of_version(df: DataFrame, version: str | None) -> DataFrame:
    """Rows of one version, or of all."""
    return df if version is None else df.where(F.col("version") == version)


def event_series(fact: DataFrame, kpis: DataFrame, event_defs: DataFrame, version: str | None = None, a=None, b=None) -> DataFrame:
    """Dense daily event counts with count per active device and per
    session of the product that day (0 where there is none).  With ``version``
    both are of that version (``kpis`` at the version grain then); the days are
    [a, b], by default those of all versions' events."""
    dlo, dhi = span_bounds(fact) if a is None or b is None else (None, None)
    g = event_grid(of_version(fact, version), event_defs, dlo if a is None else a, dhi if b is None else b)
    k = of_version(kpis, version).select("product_id", "d", "startusers", "sessions")
    return (g.join(k, ["product_id", "d"], "left")
            .select("product_id", "event_id", "d", "count",
                    ratio_or_zero(F.col("count"), F.col("startusers")).alias("per_user"),
                    ratio_or_zero(F.col("count"), F.col("sessions")).alias("per_session")))


# ---------------------------------------------------------------------------
# funnels
# ---------------------------------------------------------------------------

def funnel_ends(funnels: DataFrame) -> DataFrame:
    """First (smallest sequence) and last (largest) event of each funnel."""
    return (funnels.groupBy("product_id", "funnel_id", "funnel_name", "unit_price")
            .agg(F.min_by("event_id", "seq").alias("start_event"),
                 F.max_by("event_id", "seq").alias("end_event")))


def funnel_steps(fact: DataFrame, funnels: DataFrame, a=None, b=None, version: str | None = None) -> DataFrame:
    """E9 (of one version, if given): per funnel step, the step event's count and its percentage of the
    first step's count (1 decimal, half up; '--' shown when the first step
    has no events).  Steps are ranked by sequence (renumbering-proof)."""
    cnt = of_version(in_range(fact, a, b), version).groupBy("product_id", "event_id").agg(F.count(F.lit(1)).alias("count"))
    steps = funnels.withColumn("step", F.row_number().over(
        Window.partitionBy("product_id", "funnel_id").orderBy("seq")))
    j = steps.join(cnt, ["product_id", "event_id"], "left").withColumn(
        "count", F.coalesce("count", F.lit(0)).cast("bigint"))
    first = F.first("count").over(Window.partitionBy("product_id", "funnel_id").orderBy("step")
                                  .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return j.select("product_id", "funnel_id", "step", "event_id", "alias", "count",
                    pct_round(F.col("count"), first, 1).alias("pct_of_first"),
                    format_pct(F.col("count"), first, 1).alias("pct_label"))


def funnel_summary(fact: DataFrame, funnels: DataFrame, a=None, b=None, compat: bool = False) -> DataFrame:
    """Start and end counts per funnel summed over the range,
    conversion rate end/start, and value = end count x unit price.
    ``compat=True`` reports start/end, as the reference's screen does (Q10)."""
    ends = funnel_ends(funnels)
    cnt = in_range(fact, a, b).groupBy("product_id", "event_id").agg(F.count(F.lit(1)).alias("n"))
    s = cnt.select("product_id", F.col("event_id").alias("start_event"), F.col("n").alias("start_count"))
    e = cnt.select("product_id", F.col("event_id").alias("end_event"), F.col("n").alias("end_count"))
    j = ends.join(s, ["product_id", "start_event"], "left").join(e, ["product_id", "end_event"], "left")
    sc = F.coalesce("start_count", F.lit(0)).cast("bigint")
    ec = F.coalesce("end_count", F.lit(0)).cast("bigint")
    return j.select("product_id", "funnel_id", "funnel_name", sc.alias("start_count"),
                    ec.alias("end_count"), (ratio(sc, ec) if compat else ratio(ec, sc)).alias("conversion_rate"),
                    (ec.cast("decimal(20,0)") * F.col("unit_price")).cast("double").alias("value"))


def funnel_daily(fact: DataFrame, funnels: DataFrame) -> DataFrame:
    """Per product and day over all its funnels: target (end) count,
    start count, value = sum of end count x unit price; dense over the
    span of the data."""
    ends = funnel_ends(funnels)
    # an event's part in its funnels: one pass over the daily counts serves starts and ends
    role = lambda event, starts, ends_: ends.select("product_id", F.col(event).alias("event_id"), F.lit(starts).alias("_s"), F.lit(ends_).alias("_e"), "unit_price")
    roles = role("start_event", 1, 0).unionByName(role("end_event", 0, 1))
    n = F.col("count")
    sums = event_daily(fact).join(roles, ["product_id", "event_id"]).groupBy("product_id", "d").agg(
        F.sum(n * F.col("_s")).alias("start_count"), F.sum(n * F.col("_e")).alias("end_count"),
        F.sum(F.when(F.col("_e") == 1, n.cast("decimal(20,0)") * F.col("unit_price"))).alias("value"))
    lo, hi = span_bounds(fact)
    grid = date_grid(ends.select("product_id").distinct(), lo, hi)
    out = grid.join(sums, ["product_id", "d"], "left")
    return out.select("product_id", "d",
                      F.coalesce("end_count", F.lit(0)).cast("bigint").alias("end_count"),
                      F.coalesce("start_count", F.lit(0)).cast("bigint").alias("start_count"),
                      F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"))


def funnel_target_series(fact: DataFrame, funnels: DataFrame) -> DataFrame:
    """Dense daily count of each funnel's target (last) event."""
    ends = funnel_ends(funnels).select("product_id", "funnel_id", F.col("end_event").alias("event_id"))
    lo, hi = span_bounds(fact)
    grid = date_grid(ends, lo, hi)
    return (grid.join(event_daily(fact), ["product_id", "event_id", "d"], "left")
            .select("product_id", "funnel_id", "event_id", "d",
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def ordered_funnel(fact: DataFrame, funnels: DataFrame, max_steps: int,
                   window_seconds: int = 7 * 86400, bucket_seconds: int = 86400) -> DataFrame:
    """E15 (extension, not in the reference): devices reaching each step in
    order.  A device enters at its first step-1 event; step k counts when a
    step-k event follows the step-(k-1) time (or falls on it) within
    ``window_seconds`` of the entry.  ``max_steps`` is the longest configured
    funnel.

    One scan for all steps.  A (device, time bucket) is reduced to a funnel
    state: for each step that a device may have reached before, the times at
    which the bucket reaches the next ones.  States of a device's buckets
    compose in time order, so a hot device is spread over its buckets and what
    meets at the device is ``max_steps`` short lists a bucket.  Events without a
    time can't be ordered and don't count.
    """
    steps = (funnels.withColumn("step", F.row_number().over(
        Window.partitionBy("product_id", "funnel_id").orderBy("seq")))
        .select("product_id", "funnel_id", "step", "event_id"))
    keys = ["product_id", "funnel_id", "device_id"]
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ev = fact.where("ts is not null").select("product_id", "device_id", "event_id", us.alias("us")) \
        .join(steps, ["product_id", "event_id"]).withColumn("b", F.floor(F.col("us") / (bucket_seconds * 1_000_000)))
    none = F.array().cast("array<bigint>")
    after = lambda k: F.aggregate(
        "seen", none, lambda times, e: F.when(e["step"] == F.size(times) + k + 1, F.concat(times, F.array(e["us"]))).otherwise(times))
    # of a step's repeats at one time one is enough
    seen = F.array_sort(F.collect_set(F.struct("us", "step")))
    states = ev.groupBy(*keys, "b").agg(seen.alias("seen")).select(*keys, "b", F.array(*[after(k) for k in range(max_steps)]).alias("next"))
    device = states.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("b", "next"))).alias("states"))
    times = F.aggregate("states", none, lambda t, s: F.when(
        F.size(t) < max_steps, F.concat(t, F.element_at(s["next"], F.least(F.size(t), F.lit(max_steps - 1)) + 1))).otherwise(t))
    reached = device.select(*keys, times.alias("times")).select(
        *keys, F.size(F.filter("times", lambda t: t <= F.element_at("times", 1) + window_seconds * 1_000_000)).alias("n"))
    counts = reached.where("n > 0").select("product_id", "funnel_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("step")) \
        .groupBy("product_id", "funnel_id", "step").agg(F.count(F.lit(1)).alias("devices"))
    return (steps.select("product_id", "funnel_id", "step").join(counts, ["product_id", "funnel_id", "step"], "left")
            .select("product_id", "funnel_id", "step",
                    F.coalesce("devices", F.lit(0)).cast("bigint").alias("devices")))
