"""Streaming jobs run to completion over the table replayed as a file stream
(``availableNow``); each query returns the job's output read back as a
DataFrame, so stream results are checked against the same oracle as batch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from usagelens.operators.first_index import FirstLaunchIndex
from usagelens.plans.catalog import Inputs, query
from usagelens.plans.ingest_queries import CRASH_SQL, EVENT_SQL, LAUNCH_SQL, PAGE_SQL
from usagelens.session import spread
from usagelens.sources import payloads as PL
from usagelens.sources import registry as R
from usagelens.sources.fixtures import launch_from_events
from usagelens.streaming import increments as IC
from usagelens.streaming import ingest as SI
from usagelens.streaming import jobs as J
from usagelens.streaming import stateful as ST


def event_streams(i: Inputs, wd: str, reposted: str | None = None):
    """The events table as a stream of four micro-batches in time order, handed out once per batch.
    A batch's tasks follow the files landed, so a span lands in one per core at least."""
    return J.landed_streams(spread(i.spark.read.parquet(f"{i.sf_dir}/events.parquet")), f"{wd}/landing", reposted=reposted)


def launch_streams(i: Inputs, wd: str, reposted: str | None = None):
    for e in event_streams(i, wd, reposted):
        yield launch_from_events(e, i.spark.read.parquet(f"{i.sf_dir}/nation.parquet"),
                                 i.spark.read.parquet(f"{i.sf_dir}/region.parquet"))


#: (ids, days late): rows that arrive after their day, some beyond the late-data horizon
DELAYS = (("event_id % 50 = 0", 3), ("event_id % 50 = 7", 10))
ARRIVED = "CASE " + " ".join(f"WHEN {ids} THEN ts + INTERVAL {n} DAY" for ids, n in DELAYS) + " ELSE ts END"
ROLLUP_COLUMNS = ["launch_id", "product_id", "channel_id", "version", "device_id", "ts", "d", "h"]


def arriving_streams(i: Inputs, wd: str):
    """The launches as a stream of four micro-batches in order of arrival: rows
    of DELAYS come days after their event time."""
    events = spread(i.spark.read.parquet(f"{i.sf_dir}/events.parquet")).withColumn("arrived", F.expr(ARRIVED))
    for e in J.landed_streams(events, f"{wd}/landing", order="arrived"):
        yield launch_from_events(e, i.spark.read.parquet(f"{i.sf_dir}/nation.parquet"), i.spark.read.parquet(f"{i.sf_dir}/region.parquet"))


@query("stream_daily_counts", """
SELECT product_id, d, CAST(count(*) AS BIGINT) AS launches, CAST(count(DISTINCT device_id) AS BIGINT) AS devices
FROM launch GROUP BY ALL""")
def stream_daily_counts(i: Inputs):
    """The hourly job over rows in order of arrival -- one delta a batch,
    merged into the days it touches, deltas compacted after every second
    batch; the rows behind the watermark, landed apart, follow at the end."""
    wd = J.work_dir(i.spark, "daily")
    job = IC.IncrementJob(i.spark, f"{wd}/job", compact_every=2)
    for launches in arriving_streams(i, wd):
        rows = launches.select(*ROLLUP_COLUMNS)
        job.start(rows, f"{wd}/ckpt", available_now=True).awaitTermination()
    job.repair(rows.schema, 4)
    return job.summary().select("product_id", "d", "launches", "devices")


@query("stream_late_rows", f"""
WITH e AS (SELECT *, {ARRIVED} AS arrived FROM events),
b AS (SELECT epoch_us(min(arrived)) AS lo, epoch_us(max(arrived)) AS hi FROM e),
k AS (SELECT e.*, CAST(least(3, floor(4.0 * (epoch_us(arrived) - lo) / (hi - lo))) AS BIGINT) AS batch FROM e, b),
m AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen, max(ts) AS max_ts FROM k GROUP BY batch)
SELECT batch, CAST(count(*) FILTER (NOT coalesce(ts <= seen - INTERVAL 7 DAY, FALSE)) AS BIGINT) AS on_time,
  CAST(count(*) FILTER (coalesce(ts <= seen - INTERVAL 7 DAY, FALSE)) AS BIGINT) AS late, any_value(m.max_ts) AS max_ts
FROM k JOIN m USING (batch) GROUP BY batch""")
def stream_late_rows(i: Inputs):
    """Rows of each micro-batch on time and behind the watermark; the two
    together are the rows that came."""
    wd = J.work_dir(i.spark, "late")
    job = IC.IncrementJob(i.spark, f"{wd}/job")
    for launches in arriving_streams(i, wd):
        job.start(launches.select(*ROLLUP_COLUMNS), f"{wd}/ckpt", available_now=True).awaitTermination()
    return job.journal()


@query("stream_first_launches", """
SELECT l.product_id, l.device_id, l.launch_id, l.channel_id, l.d, l.h FROM launch l WHERE NOT EXISTS (
  SELECT 1 FROM launch p WHERE p.product_id = l.product_id AND p.device_id = l.device_id
  AND (p.d < l.d OR (p.d = l.d AND p.launch_id < l.launch_id)))""")
def stream_first_launches(i: Inputs):
    """First launch of every device by event time while rows arrive late:
    keyed state corrects it within the horizon, the landed late rows beyond it."""
    wd = J.work_dir(i.spark, "firsts")
    index = FirstLaunchIndex(i.spark, f"{wd}/index", ["product_id"], ["channel_id", "h"], n_buckets=8)
    job = IC.IncrementJob(i.spark, f"{wd}/job")
    for launches in arriving_streams(i, wd):
        rows = launches.select(*ROLLUP_COLUMNS)
        job.start(rows, f"{wd}/land", available_now=True).awaitTermination()
        ST.first_launch_job(J.event_time(rows), index, f"{wd}/ckpt", available_now=True).awaitTermination()
    index.update(IC.landed(i.spark, f"{wd}/job", True, rows.schema), 1 << 20)
    return index.read().select("product_id", "device_id", "launch_id", "channel_id", "d", "h")


@query("stream_hourly_actives", """
SELECT date_trunc('hour', ts) AS window_start, product_id, CAST(count(DISTINCT device_id) AS BIGINT) AS actives FROM launch
GROUP BY ALL HAVING date_trunc('hour', any_value(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM launch)""")
def stream_hourly_actives(i: Inputs):
    """Exact distinct devices per product and closed hour, by two chained
    stateful operators (two hours of watermark, rows in time order)."""
    wd = J.work_dir(i.spark, "actives")
    for launches in launch_streams(i, wd):
        J.append_sink(IC.hourly_actives(J.event_time(launches), "2 hours"), f"{wd}/out", f"{wd}/ckpt", available_now=True).awaitTermination()
    return i.spark.read.parquet(f"{wd}/out").select("window_start", "product_id", "actives")


def _rolling_sql(days: int) -> str:
    return f"""
WITH e AS (SELECT DISTINCT product_id, d FROM launch)
SELECT e.product_id, e.d, CAST(count(DISTINCT l.device_id) AS BIGINT) AS actives, TRUE AS estimated FROM e
JOIN launch l ON l.product_id = e.product_id AND l.d BETWEEN e.d - {days - 1} AND e.d GROUP BY ALL"""


def _rolling(i: Inputs, days: int):
    wd = J.work_dir(i.spark, "sketches")
    for launches in arriving_streams(i, wd):
        IC.sketch_job(launches.select("product_id", "device_id", "d"), f"{wd}/out", f"{wd}/ckpt", available_now=True).awaitTermination()
    guess = IC.rolling_actives(i.spark.read.parquet(f"{wd}/out"), days).withColumnRenamed("actives", "guess")
    exact = IC.exact_rolling_actives(i.launch, days)
    near = F.abs(F.col("guess") - F.col("actives")) <= 4 * IC.SKETCH_ERROR * F.col("actives") + 0.5
    return exact.join(guess, ["product_id", "d"], "left").select("product_id", "d", "actives", F.coalesce(near, F.lit(False)).alias("estimated"))


@query("stream_rolling_actives_7d", _rolling_sql(7))
def stream_rolling_actives_7d(i: Inputs):
    """Distinct devices of seven days, from sketches of the micro-batches;
    ``estimated`` tells that the estimate lies within four standard errors of
    the exact batch count beside it."""
    return _rolling(i, 7)


@query("stream_rolling_actives_31d", _rolling_sql(31))
def stream_rolling_actives_31d(i: Inputs):
    """The same over 31 days."""
    return _rolling(i, 31)


@query("stream_run_journal", "SELECT 'daily_counts' AS op, CAST(4 AS BIGINT) AS batches, CAST(count(*) AS BIGINT) AS rows FROM launch")
def stream_run_journal(i: Inputs):
    """The job's journal, one row per micro-batch, summed up."""
    wd = J.work_dir(i.spark, "journal")
    for launches in launch_streams(i, wd):
        rows = launches.select("launch_id", "product_id", "device_id", "ts", "d")
        J.day_partition_job(rows, f"{wd}/fact", f"{wd}/summary", f"{wd}/ckpt", available_now=True,
                            journal_path=f"{wd}/journal").awaitTermination()
    return i.spark.read.parquet(f"{wd}/journal").groupBy("op").agg(
        F.count(F.lit(1)).cast("bigint").alias("batches"), F.sum("rows").cast("bigint").alias("rows"))


@query("stream_hourly_launches", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  product_id, CAST(count(*) AS BIGINT) AS launches FROM launch GROUP BY ALL""")
def stream_hourly_launches(i: Inputs):
    """Launches per product per event-time hour (watermark 7 days),
    updated windows upserted by version."""
    wd = J.work_dir(i.spark, "hourly")
    for launches in launch_streams(i, wd):
        agg = J.windowed_launches(J.event_time(launches), "1 hour")
        J.versioned_sink(agg, f"{wd}/out", f"{wd}/ckpt", available_now=True).awaitTermination()
    return J.read_latest(i.spark, f"{wd}/out", ["window_start", "product_id"]).select(
        "window_start", "window_end", "product_id", "launches")


@query("stream_rolling_7d", """
WITH w AS (SELECT date_trunc('day', ts) - to_days(CAST(r.k AS INTEGER)) AS window_start, product_id
           FROM launch, range(7) r(k))
SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, product_id, CAST(count(*) AS BIGINT) AS launches
FROM w GROUP BY ALL""")
def stream_rolling_7d(i: Inputs):
    """7-day windows sliding by a day, per product."""
    wd = J.work_dir(i.spark, "rolling")
    for launches in launch_streams(i, wd):
        agg = J.windowed_launches(J.event_time(launches), "7 days", "1 day")
        J.versioned_sink(agg, f"{wd}/out", f"{wd}/ckpt", available_now=True).awaitTermination()
    return J.read_latest(i.spark, f"{wd}/out", ["window_start", "product_id"]).select(
        "window_start", "window_end", "product_id", "launches")


@query("stream_first_arrivals", "SELECT DISTINCT product_id, device_id FROM launch")
def stream_first_arrivals(i: Inputs):
    """First arrival per (product, device) via streaming dropDuplicates."""
    wd = J.work_dir(i.spark, "first")
    for launches in launch_streams(i, wd):
        rows = J.first_arrivals(launches.select("product_id", "device_id", "ts"))
        J.append_sink(rows, f"{wd}/out", f"{wd}/ckpt", available_now=True).awaitTermination()
    return i.spark.read.parquet(f"{wd}/out").select("product_id", "device_id")


@query("stream_dedupe", "SELECT launch_id, product_id, device_id FROM launch")
def stream_dedupe(i: Inputs):
    """Re-posted rows dropped within the watermark: a third of the launches
    arrives a second time one micro-batch later."""
    wd = J.work_dir(i.spark, "dedupe")
    for launches in launch_streams(i, wd, "event_id % 3 = 0"):
        rows = J.dedupe_posts(J.event_time(launches).select("launch_id", "product_id", "device_id", "ts"))
        J.append_sink(rows, f"{wd}/out", f"{wd}/ckpt", available_now=True).awaitTermination()
    return i.spark.read.parquet(f"{wd}/out").select("launch_id", "product_id", "device_id")


@query("stream_ingest_launch", LAUNCH_SQL)
def stream_ingest_launch(i: Inputs):
    """Payload stream validated and landed per micro-batch."""
    wd = J.work_dir(i.spark, "ingest")
    for events in event_streams(i, wd):
        raw = PL.launch_payloads_from(events)
        SI.ingest_launch_stream(raw, i.channels, R.mccmnc(i.spark), f"{wd}/out", f"{wd}/rejects",
                                f"{wd}/ckpt", available_now=True).awaitTermination()
    return i.spark.read.parquet(f"{wd}/out").drop("ingest_day", "epoch")


@query("stream_ingest_event", EVENT_SQL)
def stream_ingest_event(i: Inputs):
    """The custom-event queue."""
    wd = J.work_dir(i.spark, "ingest")
    for events in event_streams(i, wd):
        SI.ingest_event_stream(PL.event_payloads_from(events), i.channels, i.event_defs, f"{wd}/out", f"{wd}/rejects",
                               f"{wd}/ckpt", available_now=True).awaitTermination()
    return i.spark.read.parquet(f"{wd}/out").drop("ingest_day", "epoch")


@query("stream_ingest_page", PAGE_SQL)
def stream_ingest_page(i: Inputs):
    """The page-view queue."""
    wd = J.work_dir(i.spark, "ingest")
    for events in event_streams(i, wd):
        SI.ingest_page_stream(PL.page_payloads_from(events), i.channels, f"{wd}/out", f"{wd}/rejects",
                              f"{wd}/ckpt", available_now=True).awaitTermination()
    return i.spark.read.parquet(f"{wd}/out").drop("ingest_day", "epoch")


@query("stream_ingest_crash", CRASH_SQL)
def stream_ingest_crash(i: Inputs):
    """The crash queue."""
    wd = J.work_dir(i.spark, "ingest")
    for events in event_streams(i, wd):
        SI.ingest_crash_stream(PL.crash_payloads_from(events), i.channels, f"{wd}/out", f"{wd}/rejects",
                               f"{wd}/ckpt", available_now=True).awaitTermination()
    return i.spark.read.parquet(f"{wd}/out").drop("ingest_day", "epoch")


GAP = 6 * 3600


DEVICE_SESSIONS_SQL = f"""
WITH l AS (SELECT product_id, device_id, ts FROM launch),
g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) >= {GAP * 1_000_000}
                 THEN 1 ELSE 0 END AS nw
      FROM l WINDOW w AS (PARTITION BY product_id, device_id ORDER BY ts)),
s AS (SELECT *, sum(nw) OVER (PARTITION BY product_id, device_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sn FROM g)
SELECT product_id, device_id, min(ts) AS session_start, max(ts) + INTERVAL {GAP} SECOND AS session_end,
  CAST(count(*) AS BIGINT) AS launches FROM s GROUP BY product_id, device_id, sn"""


@query("device_sessions", DEVICE_SESSIONS_SQL)
def device_sessions(i: Inputs):
    """Session windows (6-hour gap) over the whole table."""
    return J.session_windows(J.event_time(i.launch), "6 hours")


@query("stream_device_sessions", DEVICE_SESSIONS_SQL)
def stream_device_sessions(i: Inputs):
    """The same sessions from keyed state while rows arrive late; a session
    that a later batch extends replaces its earlier form by key."""
    wd = J.work_dir(i.spark, "sessions")
    for launches in arriving_streams(i, wd):
        ST.session_job(J.event_time(launches), f"{wd}/out", f"{wd}/ckpt", "6 hours", "30 days", available_now=True).awaitTermination()
    return ST.latest_sessions(i.spark, f"{wd}/out", "6 hours")


@query("late_arrivals", """
SELECT product_id, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(CASE WHEN CAST(ingest_ts AS DATE) > d THEN 1 END) AS BIGINT) AS late_rows,
  CAST(count(CASE WHEN ingest_ts > ts + INTERVAL 7 DAY THEN 1 END) AS BIGINT) AS beyond_horizon
FROM launch GROUP BY ALL""")
def late_arrivals(i: Inputs):
    """Rows arriving after their event day / beyond the 7-day horizon."""
    return J.lateness(i.launch)


@query("late_arrivals_horizon", f"""
WITH a AS (SELECT l.*, {ARRIVED.replace("event_id", "launch_id")} AS arrived FROM launch l)
SELECT product_id, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(CASE WHEN CAST(arrived AS DATE) > d THEN 1 END) AS BIGINT) AS late_rows,
  CAST(count(CASE WHEN arrived > ts + INTERVAL 7 DAY THEN 1 END) AS BIGINT) AS beyond_horizon
FROM a GROUP BY ALL""")
def late_arrivals_horizon(i: Inputs):
    """The same where some rows come ten days late, beyond the horizon."""
    return J.lateness(i.launch.withColumn("ingest_ts", F.expr(ARRIVED.replace("event_id", "launch_id"))))
