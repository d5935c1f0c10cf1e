"""Structured Streaming forms of the hourly/daily jobs.

Sources are file streams (a landing folder of raw rows; Kafka works the same
way through ``readStream.format('kafka')``).  Sinks:

* ``versioned_sink``: ``foreachBatch`` writes each micro-batch's updated
  aggregate rows under ``epoch=<id>`` (overwrite, so a replayed batch after
  a failure rewrites its own folder -- idempotent); ``read_latest`` keeps the
  newest version of every key with a partial ``max_by`` aggregate.  This is
  the streaming form of the reference's ``ON DUPLICATE KEY UPDATE``.
* ``increments.IncrementJob``: the hourly job (W1) as deltas that merge.
* ``day_partition_job``: the same for summaries that need a day's raw rows -- land the batch's rows under
  ``d=<day>/epoch=<id>``, then recompute the summary of the days the batch
  touched (late rows included, W2) from just those day folders and overwrite
  just those ``d=`` partitions of the summary (dynamic partition overwrite).

All state, checkpoints and outputs live under the session's shared
``spark.checkpoint.dir`` (never a machine-local folder on a cluster).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usagelens.session import ensure_checkpoint_dir

DEFAULT_TRIGGER = "10 seconds"   # fixed value: queue drain interval
LATE_HORIZON = "7 days"          # fixed value: late-data horizon


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/usagelens-stream/{name}-{uuid.uuid4().hex[:12]}"


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """File stream over one table of the landing folder (the glob keeps the
    table's own file/folder and avoids its siblings)."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


def landed_streams(rows: DataFrame, path: str, order: str = "ts", parts: int = 4, reposted: str | None = None) -> Iterator[DataFrame]:
    """Replay a table as a stream of several micro-batches: its rows are landed
    by ``parts`` equal spans of ``order``, each in its natural partitions, and
    a stream over the landing folder is handed out after each.  A query started
    on each of them in turn (``availableNow``, same checkpoint) takes up the
    span just landed as one batch.  Rows without ``order`` land with the first
    span.  ``reposted`` is a predicate: the rows it picks arrive once more, with
    the span after their own."""
    lo, hi = rows.agg(F.min(order), F.max(order)).first()
    cut = lambda k: F.lit(lo + (hi - lo) * k / parts).cast(rows.schema[order].dataType)
    span = lambda n: ((F.col(order) >= cut(n)) & ((F.col(order) < cut(n + 1)) if n + 1 < parts else F.lit(True))
                      | (F.col(order).isNull() if n == 0 else F.lit(False)))
    for k in range(parts if lo is not None else 1):
        here = rows.where(span(k)) if lo is not None else rows
        if reposted and k:
            here = here.unionAll(rows.where(span(k - 1)).where(reposted))
        here.write.mode("append").parquet(path)
        yield rows.sparkSession.readStream.schema(rows.schema).parquet(path)


def _start(writer, trigger: str | None, available_now: bool) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger or DEFAULT_TRIGGER)
    return writer.start()


def versioned_sink(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                   available_now: bool = False, output_mode: str = "update") -> StreamingQuery:
    """Start ``df`` (an aggregate) writing each batch's updated rows under
    ``path/epoch=<id>``."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")

    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(write))
    return _start(w, trigger, available_now)


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest version of every key written by ``versioned_sink``."""
    df = spark.read.parquet(path)
    vals = [c for c in df.columns if c not in keys and c != "epoch"]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("epoch")).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])


def append_sink(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                available_now: bool = False) -> StreamingQuery:
    """Plain append of a stream's rows to parquet (exactly-once through the
    file sink's commit log)."""
    w = (df.writeStream.outputMode("append").format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint))
    return _start(w, trigger, available_now)


# ---------------------------------------------------------------------------
# Hourly job = land rows, recompute touched days, overwrite those days
# ---------------------------------------------------------------------------

def daily_counts(fact: DataFrame) -> DataFrame:
    """Day-local launch counts recomputed from the landed fact."""
    return (fact.groupBy("product_id", "d")
            .agg(F.count(F.lit(1)).cast("bigint").alias("launches"),
                 F.countDistinct("device_id").cast("bigint").alias("devices")))


def day_partition_job(rows: DataFrame, fact_path: str, summary_path: str, checkpoint: str,
                      summarize=daily_counts, trigger: str | None = None,
                      available_now: bool = False, journal_path: str | None = None,
                      op_name: str = "daily_counts") -> StreamingQuery:
    """W1 (+W2 for late rows): each micro-batch lands its rows under
    ``fact_path/d=<day>/epoch=<id>`` and replaces the summary partitions
    ``d=...`` of every day it touched with a recompute over all landed rows of
    those days.  Only the touched day folders are listed and read (the day
    keys of one batch -- a handful, bounded by the late-data horizon -- are
    the only thing brought to the driver, to name those folders), so the
    cost of a batch does not grow with the history.  A replayed batch
    overwrites the same (day, epoch) folders and the same summary days, so
    the job is idempotent.

    With ``journal_path`` every batch also appends one run-journal row (I20):
    operation, epoch, start and end time, rows landed, seconds -- the row
    count comes from a ``DataFrame.observe`` on the landing write, not from
    an extra action.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        import datetime as dt
        from pyspark.sql import Observation
        spark = batch.sparkSession
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        obs = Observation(f"{op_name}-{epoch_id}")
        batch = batch.persist()          # landed, and asked for its days
        landed = batch.observe(obs, F.count(F.lit(1)).alias("rows"))
        (landed.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("d", "epoch").parquet(fact_path))
        days = [r[0] for r in batch.select("d").distinct().collect()]
        batch.unpersist()
        if not days:
            return
        fact = (spark.read.option("basePath", fact_path)
                .parquet(*[f"{fact_path}/d={d.isoformat() if d else '__HIVE_DEFAULT_PARTITION__'}" for d in days]).drop("epoch"))
        (summarize(fact).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("d").parquet(summary_path))
        if journal_path is not None:
            ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            entry = [(op_name, epoch_id, started, ended, int(obs.get["rows"]), (ended - started).total_seconds())]
            (spark.createDataFrame(entry, "op string, epoch long, started timestamp_ntz, ended timestamp_ntz, "
                                          "rows long, seconds double")
             .write.mode("overwrite").parquet(f"{journal_path}/epoch={epoch_id}"))

    w = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return _start(w, trigger, available_now)


def rollup_job(rows: DataFrame, fact_path: str, rollup_path: str, checkpoint: str,
               trigger: str | None = None, available_now: bool = False,
               journal_path: str | None = None) -> StreamingQuery:
    """The deployment form of the KPI input: the hourly job maintains the
    device-hour launch rollup, partitioned by day, recomputing only the days
    each micro-batch touched (the rollup is day-local, so a late row changes
    only its own day).  Reports read it instead of the raw log."""
    from usagelens.operators.kpis import launch_rollup
    return day_partition_job(rows, fact_path, rollup_path, checkpoint, summarize=launch_rollup,
                             trigger=trigger, available_now=available_now, journal_path=journal_path,
                             op_name="launch_rollup")


# ---------------------------------------------------------------------------
# Event-time streaming aggregates
# ---------------------------------------------------------------------------

def event_time(rows: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need a TIMESTAMP (with zone) event time; the logs carry
    zoneless times read in the session zone (UTC), so this is a re-typing."""
    return rows.withColumn(col, F.col(col).cast("timestamp"))


def _ntz(c):
    return c.cast("timestamp_ntz")


def windowed_launches(rows: DataFrame, window: str = "1 hour", slide: str | None = None,
                      watermark: str = LATE_HORIZON) -> DataFrame:
    """Launches per product per tumbling (or sliding) event-time
    window; rows older than the watermark are dropped (W2).  Distinct
    devices in flight use ``approx_count_distinct`` (exact distinct is not a
    streaming aggregate); the exact value comes from the batch job."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    return (rows.withWatermark("ts", watermark).groupBy(w.alias("w"), "product_id")
            .agg(F.count(F.lit(1)).alias("launches"),
                 F.approx_count_distinct("device_id").alias("approx_devices"))
            .select(_ntz(F.col("w.start")).alias("window_start"), _ntz(F.col("w.end")).alias("window_end"),
                    "product_id", "launches", "approx_devices"))


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows a query's stateful operators dropped as later than the
    watermark, summed over the progress reports it still holds.  These are
    the operator's input rows -- already partially aggregated within each
    micro-batch -- so the number flags and sizes lateness per batch; the
    exact raw-row counts come from the batch ``lateness`` (W8)."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            total += (op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict)
                      else op.numRowsDroppedByWatermark)
    return total


def session_windows(rows: DataFrame, gap: str = "30 seconds", watermark: str = LATE_HORIZON) -> DataFrame:
    """Device sessions split at ``gap`` of inactivity (session_window)."""
    return (rows.withWatermark("ts", watermark)
            .groupBy(F.session_window("ts", gap).alias("s"), "product_id", "device_id")
            .agg(F.count(F.lit(1)).alias("launches"))
            .select("product_id", "device_id", _ntz(F.col("s.start")).alias("session_start"),
                    _ntz(F.col("s.end")).alias("session_end"), "launches"))


def first_arrivals(rows: DataFrame) -> DataFrame:
    """The first arrival of every (product, device) -- a new device by
    arrival order.  It keeps every device it has seen; ``stateful.first_launch_job``
    corrects by event time and lets state go."""
    return rows.dropDuplicates(["product_id", "device_id"])


def dedupe_posts(rows: DataFrame, key: str = "launch_id", watermark: str = LATE_HORIZON) -> DataFrame:
    """Drop re-posted rows (same id) seen within the watermark."""
    return rows.withWatermark("ts", watermark).dropDuplicatesWithinWatermark([key])


def lateness(rows: DataFrame, horizon_days: int = 7) -> DataFrame:
    """W8 (batch): rows per product arriving after their event day, and
    beyond the late-data horizon (those a watermarked stream drops)."""
    late = F.to_date("ingest_ts") > F.col("d")
    beyond = F.col("ingest_ts") > F.col("ts") + F.make_dt_interval(F.lit(horizon_days))
    return (rows.groupBy("product_id")
            .agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                 F.count(F.when(late, 1)).cast("bigint").alias("late_rows"),
                 F.count(F.when(beyond, 1)).cast("bigint").alias("beyond_horizon")))
