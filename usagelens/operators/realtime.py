"""Real-time counts on the raw logs.

"Today" is the last day present in the log (a scalar subquery); the batch
forms here are what the streaming forms in ``streaming/`` keep up to date
incrementally.  New devices are today's devices whose first day in the scope is
today.  That day comes from a kept index (``first_days``: one row per entry and
device, bucketed by device), joined to the devices of the day; of the log
only the day is read.  Without an index the history is aggregated instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.ratios import ratio

SCOPES = {"product": ["product_id"], "channel": ["product_id", "channel_id"], "owner": ["owner_id"]}


def _scoped(df: DataFrame, registry: DataFrame, products: DataFrame | None, scope: str) -> DataFrame:
    """Keep rows of registered app keys (semi join on the registry) and add
    the owner when the scope needs it."""
    rows = df.join(registry.select("product_id", "channel_id"), ["product_id", "channel_id"], "left_semi")
    if scope == "owner":
        rows = rows.join(products.select("product_id", "owner_id"), "product_id")
    return rows


def first_days(rollup: DataFrame) -> DataFrame:
    """First day of every device per (product, channel): what ``today_counts`` asks of the history."""
    return rollup.groupBy("product_id", "channel_id", "device_id").agg(F.min("d").alias("first_d"))


def on_day(rows: DataFrame, day) -> DataFrame:
    """Rows of one day; their time bounds, where they have one, reach the scan."""
    kept = rows.where(F.col("d") == day)
    if "ts" in rows.columns:
        start = day.cast("timestamp_ntz")
        kept = kept.where((F.col("ts") >= start) & (F.col("ts") < start + F.expr("INTERVAL 1 DAY")))
    return kept


def today_counts(launch: DataFrame, registry: DataFrame, scope: str = "product",
                 products: DataFrame | None = None, day=None, index: DataFrame | None = None) -> DataFrame:
    """Launches, devices and new devices of ``day`` (default: the last
    day in the log) per scope.

    With ``index`` (``first_days`` up to the day at least) the devices of the
    day are looked up there.  Without, one aggregate per device over the log
    to the day holds its first day and its launches of the day.
    """
    keys = SCOPES[scope]
    rows = _scoped(launch, registry, products, scope)
    day = rows.select(F.max("d")).scalar() if day is None else F.lit(day).cast("date")
    if index is None:
        per_device = (rows.where(F.col("d") <= day).groupBy(*keys, "device_id")
                      .agg(F.min("d").alias("_first"), F.count(F.when(F.col("d") == day, 1)).alias("_n")).where("_n > 0"))
    else:
        today = on_day(rows, day).groupBy(*keys, "device_id").agg(F.count(F.lit(1)).alias("_n"))
        known = _scoped(index, registry, products, scope)
        seen = known.join(today.select(*[F.col(k).alias(f"_{k}") for k in (*keys, "device_id")]),
                          [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in (*keys, "device_id")], "left_semi") \
            .groupBy(*keys, "device_id").agg(F.min("first_d").alias("_first"))
        per_device = today.join(seen.select(*[F.col(k).alias(f"_{k}") for k in (*keys, "device_id")], "_first"),
                                [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in (*keys, "device_id")], "left")
    return (per_device.groupBy(*keys)
            .agg(F.sum("_n").cast("bigint").alias("launches"), F.count(F.lit(1)).cast("bigint").alias("devices"),
                 F.count(F.when(F.coalesce("_first", day) >= day, 1)).cast("bigint").alias("new_devices"))
            .select(*keys, day.alias("d"), "launches", "devices", "new_devices"))


def today_avg_session(pages: DataFrame, registry: DataFrame, scope: str = "product",
                      products: DataFrame | None = None) -> DataFrame:
    """T4: average session time of the last day: total duration / distinct
    sessions, per scope."""
    keys = SCOPES[scope]
    rows = _scoped(pages, registry, products, scope)
    day = rows.select(F.max("d")).scalar()
    return (rows.where(F.col("d") == day).groupBy(*keys)
            .agg(F.sum("duration_ms").alias("_t"), F.countDistinct("session_id").alias("_s"))
            .select(*keys, day.alias("d"), F.col("_s").cast("bigint").alias("sessions"),
                    ratio(F.col("_t"), F.col("_s")).alias("avg_ms")))
