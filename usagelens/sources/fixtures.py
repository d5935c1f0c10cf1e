"""Fact-shaped views over the driver's tables.

The analytics model needs four device logs (launches, page views, custom
events, crashes).  The test data ships a generic ``events`` stream and TPC-H
``orders``; these builders derive the logs from them column by column so that
every operator reads data whose size grows with the scale factor.  All
derivations are per-row expressions (plus a join to the 25-row ``nation`` /
5-row ``region`` tables, which the planner broadcasts by measured size), so
the views add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event type -> custom event definition id.
EVENT_TYPE_IDS = {"signup": 1, "view": 2, "click": 3, "purchase": 4, "error": 5}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _product(eid: Column) -> Column:
    return (F.lit(1) + eid % 3).cast("int")


def _channel(uid: Column, ts: Column) -> Column:
    return (F.lit(1) + (uid + F.dayofmonth(ts)) % 4).cast("int")


def _version(uid: Column, ts: Column) -> Column:
    day = F.dayofmonth(ts)
    return (F.when(day <= F.lit(8) + uid % 7, F.lit("1.2"))
            .when(day <= 20, F.lit("1.9"))
            .otherwise(F.lit("1.10")))


def _device(uid: Column) -> Column:
    return F.concat(F.lit("d"), uid.cast("string"))


def _tagged(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def launch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Launch log: one row per app start (``launch_id`` is the arrival id)."""
    return launch_from_events(_events(spark, sf_dir), _table(spark, sf_dir, "nation"),
                              _table(spark, sf_dir, "region"))


def launch_from_events(e: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Launch rows from an ``events`` DataFrame -- batch or streaming (the
    nation/region lookup is a stream-static join)."""
    nation = nation.select("n_nationkey", "n_name", "n_regionkey")
    region = region.select("r_regionkey", "r_name")
    uid, eid, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    base = e.select(
        eid.alias("launch_id"),
        _product(eid).alias("product_id"),
        _channel(uid, ts).alias("channel_id"),
        _version(uid, ts).alias("version"),
        _device(uid).alias("device_id"),
        ts.alias("ts"),
        F.to_date(ts).alias("d"),
        F.hour(ts).alias("h"),
        F.when(eid % 50 == 0, ts + F.expr("INTERVAL 3 DAYS")).otherwise(ts).alias("ingest_ts"),
        _tagged("os", uid % 5).alias("os"),
        _tagged("brand", uid % 12).alias("brand"),
        _tagged("net", eid % 4).alias("network"),
        _tagged("res", uid % 6).alias("resolution"),
        _tagged("lang", uid % 3).alias("language"),
        _tagged("car", uid % 7).alias("carrier"),
        (uid % 25).cast("int").alias("nation_key"),
    )
    geo = (nation.join(region, nation.n_regionkey == region.r_regionkey)
           .select(F.col("n_nationkey").alias("nation_key"),
                   F.col("r_name").alias("country"), F.col("n_name").alias("region")))
    # nation/region have a fixed size (25 and 5 rows), so broadcasting them is
    # bounded by definition; the hint keeps the fact side from ever being the
    # build side when both look small.
    return base.join(F.broadcast(geo), "nation_key").drop("nation_key")


def page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-view log: one session per device, product and ISO week."""
    e = _events(spark, sf_dir)
    uid, eid, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    product = _product(eid)
    dur = F.round(F.col("value") * 1000).cast("bigint")
    return e.select(
        eid.alias("view_id"),
        product.alias("product_id"),
        _channel(uid, ts).alias("channel_id"),
        _version(uid, ts).alias("version"),
        _device(uid).alias("device_id"),
        F.concat(F.lit("s"), uid.cast("string"), F.lit("-"), product.cast("string"), F.lit("-"),
                 F.date_trunc("week", ts).cast("date").cast("string")).alias("session_id"),
        F.col("event_type").alias("activity"),
        ts.alias("start_ts"),
        F.timestamp_add("MILLISECOND", dur, ts).alias("end_ts"),
        dur.alias("duration_ms"),
        F.to_date(ts).alias("d"),
    )


def app_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Custom-event log (``event_id`` = id of the event definition)."""
    e = _events(spark, sf_dir)
    uid, eid, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    def_id = F.lit(None).cast("int")
    for name, i in EVENT_TYPE_IDS.items():
        def_id = F.when(F.col("event_type") == name, F.lit(i)).otherwise(def_id)
    return e.select(
        eid.alias("row_id"),
        _product(eid).alias("product_id"),
        _channel(uid, ts).alias("channel_id"),
        _version(uid, ts).alias("version"),
        _device(uid).alias("device_id"),
        def_id.alias("event_id"),
        F.lit("").alias("label"),
        (F.lit(1) + eid % 3).cast("int").alias("num"),
        ts.alias("ts"),
        F.to_date(ts).alias("d"),
    )


def crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crash log: the ``error`` events with a synthetic stack trace.

    Version, OS and brand are those of the launch with the same id (the same
    source row), so no join is needed.
    """
    from usagelens.operators.ingest import crash_title  # local: avoid import cycle

    e = _events(spark, sf_dir).where(F.col("event_type") == "error")
    uid, eid, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    nl = F.lit("\n")
    stack = F.concat(F.lit("E"), (eid % 9).cast("string"), nl, F.lit("at f"),
                     (eid % 4).cast("string"), nl, F.lit("at g"), nl, F.lit("at main"))
    df = e.select(
        eid.alias("crash_id"),
        _product(eid).alias("product_id"),
        _channel(uid, ts).alias("channel_id"),
        _version(uid, ts).alias("version"),
        _device(uid).alias("device_id"),
        _tagged("os", uid % 5).alias("os"),
        _tagged("brand", uid % 12).alias("brand"),
        F.lit("main").alias("activity"),
        stack.alias("stacktrace"),
        ts.alias("ts"),
        F.to_date(ts).alias("d"),
        (eid % 9 < 2).alias("is_fixed"),
    )
    return crash_title(df, "stacktrace", "title")


def launch_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six and a half years of launches from ``orders`` (monthly cohorts)."""
    o = _table(spark, sf_dir, "orders")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        ok.alias("launch_id"),
        _product(ok).alias("product_id"),
        (F.lit(1) + ck % 4).cast("int").alias("channel_id"),
        F.concat(F.lit("v"), (F.year("o_orderdate") % 3).cast("string")).alias("version"),
        _device(ck).alias("device_id"),
        F.col("o_orderdate").cast("date").alias("d"),
    )
