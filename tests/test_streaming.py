"""Stream = batch: replay the events table as several files, one per
micro-batch, out of event-time order, and compare with the batch result."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from usagelens.sources.fixtures import launch_from_events
from usagelens.streaming import jobs as J

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landing(spark):
    """events split into 6 files (by event_id % 6: every file spans the whole
    month, so later batches carry rows older than the watermark's max)."""
    d = tempfile.mkdtemp(prefix="usagelens-landing-")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.repartition(6, F.col("event_id") % 6).write.mode("overwrite").parquet(f"{d}/events.parquet")
    for t in ("nation", "region"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.mode("overwrite").parquet(f"{d}/{t}.parquet")
    return d


def _stream_rows(spark, d):
    e = J.table_stream(spark, d, "events", max_files=1)
    return launch_from_events(e, spark.read.parquet(f"{d}/nation.parquet"), spark.read.parquet(f"{d}/region.parquet"))


def _batch_rows(spark, d):
    return launch_from_events(spark.read.parquet(f"{d}/events.parquet"), spark.read.parquet(f"{d}/nation.parquet"),
                              spark.read.parquet(f"{d}/region.parquet"))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_day_partition_job_equals_batch(spark, landing):
    wd = J.work_dir(spark, "t-daily")
    q = J.day_partition_job(_stream_rows(spark, landing).select("launch_id", "product_id", "device_id", "ts", "d"),
                            f"{wd}/fact", f"{wd}/summary", f"{wd}/ckpt", available_now=True,
                            journal_path=f"{wd}/journal")
    q.awaitTermination()
    assert len(q.recentProgress) >= 2          # several micro-batches ran
    got = spark.read.parquet(f"{wd}/summary").select("product_id", "d", "launches", "devices")
    assert _same(got, J.daily_counts(_batch_rows(spark, landing)))
    journal = spark.read.parquet(f"{wd}/journal")
    assert journal.count() == sum(1 for p in q.recentProgress if p["numInputRows"] > 0)
    assert journal.agg(F.sum("rows")).collect()[0][0] == _batch_rows(spark, landing).count()


def test_windowed_counts_equal_batch(spark, landing):
    wd = J.work_dir(spark, "t-hourly")
    agg = J.windowed_launches(J.event_time(_stream_rows(spark, landing)), "1 hour", watermark="40 days")
    J.versioned_sink(agg, f"{wd}/out", f"{wd}/ckpt", available_now=True).awaitTermination()
    got = J.read_latest(spark, f"{wd}/out", ["window_start", "product_id"]).select("window_start", "product_id",
                                                                                    "launches")
    b = _batch_rows(spark, landing)
    want = (b.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start"), "product_id")
            .agg(F.count(F.lit(1)).alias("launches")))
    assert _same(got, want)


def test_watermark_drops_only_late_rows(spark, landing):
    """With a 1-day watermark, later files carry rows older than the
    watermark; whatever survives is a subset of the batch counts."""
    wd = J.work_dir(spark, "t-late")
    agg = J.windowed_launches(J.event_time(_stream_rows(spark, landing)), "1 day", watermark="1 day")
    J.versioned_sink(agg, f"{wd}/out", f"{wd}/ckpt", available_now=True).awaitTermination()
    got = J.read_latest(spark, f"{wd}/out", ["window_start", "product_id"])
    b = _batch_rows(spark, landing)
    want = (b.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"), "product_id")
            .agg(F.count(F.lit(1)).alias("full")))
    j = got.join(want, ["window_start", "product_id"])
    assert j.where(F.col("launches") > F.col("full")).count() == 0
    assert got.agg(F.sum("launches")).collect()[0][0] <= b.count()


def test_session_stream_closed_sessions_match_batch(spark, landing):
    wd = J.work_dir(spark, "t-sess")
    s = J.session_windows(J.event_time(_stream_rows(spark, landing)), "6 hours", watermark="40 days")
    J.versioned_sink(s, f"{wd}/out", f"{wd}/ckpt", available_now=True, output_mode="append").awaitTermination()
    batch = J.session_windows(J.event_time(_batch_rows(spark, landing)), "6 hours")
    try:
        got = spark.read.parquet(f"{wd}/out").drop("epoch")
    except Exception:  # nothing closed yet under a 40-day watermark
        got = batch.limit(0)
    assert got.exceptAll(batch).count() == 0   # every emitted session is a batch session


def test_first_arrivals_cover_all_devices(spark, landing):
    wd = J.work_dir(spark, "t-first")
    rows = J.first_arrivals(_stream_rows(spark, landing).select("product_id", "device_id", "ts"))
    J.append_sink(rows, f"{wd}/out", f"{wd}/ckpt", available_now=True).awaitTermination()
    got = spark.read.parquet(f"{wd}/out").select("product_id", "device_id")
    assert got.count() == got.distinct().count()
    assert _same(got, _batch_rows(spark, landing).select("product_id", "device_id").distinct())


def test_watermark_drops_are_counted(spark, landing):
    wd = J.work_dir(spark, "t-drop")
    agg = J.windowed_launches(J.event_time(_stream_rows(spark, landing)), "1 day", watermark="1 hour")
    q = J.versioned_sink(agg, f"{wd}/out", f"{wd}/ckpt", available_now=True)
    q.awaitTermination()
    kept = J.read_latest(spark, f"{wd}/out", ["window_start", "product_id"]).agg(F.sum("launches")).collect()[0][0]
    total = _batch_rows(spark, landing).count()
    assert kept < total                      # later files carried rows behind the watermark ...
    assert J.dropped_late_rows(q) > 0        # ... and the drops are reported


def test_ingest_stream_equals_batch(spark, landing):
    from usagelens.operators import ingest as IN
    from usagelens.sources import payloads as PL
    from usagelens.sources import registry as R
    from usagelens.streaming import ingest as SI
    wd = J.work_dir(spark, "t-ingest")
    raw = PL.launch_payloads_from(J.table_stream(spark, landing, "events", max_files=2))
    q = SI.ingest_launch_stream(raw, R.channels(spark), R.mccmnc(spark), f"{wd}/out", f"{wd}/rej", f"{wd}/ckpt",
                                available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(f"{wd}/out").drop("ingest_day", "epoch")
    batch_good, batch_rej = IN.ingest_launch(PL.launch_payloads_from(spark.read.parquet(f"{landing}/events.parquet")),
                                             R.channels(spark), R.mccmnc(spark))
    assert _same(got.select(*batch_good.columns), batch_good)
    rej = spark.read.parquet(f"{wd}/rej").drop("epoch")
    assert _same(rej, batch_rej)


def test_rollup_job_maintains_the_batch_rollup(spark, landing):
    from usagelens.operators.kpis import daily_kpis, launch_rollup
    wd = J.work_dir(spark, "t-rollup")
    rows = _stream_rows(spark, landing).select("launch_id", "product_id", "channel_id", "version", "device_id",
                                               "ts", "d", "h")
    J.rollup_job(rows, f"{wd}/fact", f"{wd}/rollup", f"{wd}/ckpt", available_now=True).awaitTermination()
    maintained = spark.read.parquet(f"{wd}/rollup")
    batch = launch_rollup(_batch_rows(spark, landing))
    assert _same(maintained.select(*batch.columns), batch)
    # reports computed from the maintained rollup equal reports from the raw log
    raw = _batch_rows(spark, landing)
    assert _same(daily_kpis(raw, None, None, "product", rollup=maintained.select(*batch.columns)),
                 daily_kpis(raw, None, None, "product"))


def test_landed_spans_keep_all_rows_and_partitions(spark):
    """A table replayed by spans: every row arrives, those without a time too, and no span is one file."""
    rows = spark.range(0, 4000, 1, 4).select("id", F.when(F.col("id") % 100 > 0, F.timestamp_seconds(F.pmod(F.col("id") * 7919, F.lit(4000)))).alias("ts"))
    wd = J.work_dir(spark, "t-spans")
    batches = []
    for s in J.landed_streams(rows, f"{wd}/landing"):
        batches.append(len(spark.read.parquet(f"{wd}/landing").inputFiles()))
        J.append_sink(s, f"{wd}/out", f"{wd}/ckpt", available_now=True).awaitTermination()
    assert _same(spark.read.parquet(f"{wd}/out"), rows) and batches == [4, 8, 12, 16]


def test_day_partition_job_without_time(spark):
    """Rows without a time have a day partition of their own."""
    rows = spark.range(0, 200, 1, 2).select(
        F.col("id").alias("launch_id"), (F.col("id") % 3).alias("product_id"), (F.col("id") % 7).alias("device_id"),
        F.when(F.col("id") % 10 > 0, F.timestamp_seconds(F.col("id") * 3600)).alias("ts")).withColumn("d", F.to_date("ts"))
    wd = J.work_dir(spark, "t-nots")
    for s in J.landed_streams(rows, f"{wd}/landing"):
        J.day_partition_job(s, f"{wd}/fact", f"{wd}/summary", f"{wd}/ckpt", available_now=True).awaitTermination()
    got = spark.read.parquet(f"{wd}/summary").select("product_id", "d", "launches", "devices")
    assert _same(got, J.daily_counts(rows))


# ---------------------------------------------------------------------------
# increments: deltas, compaction, late rows, sketches
# ---------------------------------------------------------------------------

ROLLUP = ["launch_id", "product_id", "channel_id", "version", "device_id", "ts", "d", "h"]


def _parts(spark, landing, n=4):
    rows = _batch_rows(spark, landing).select(*ROLLUP)
    return rows, [rows.where(F.col("launch_id") % n == k) for k in range(n)]


def test_increments_compaction_and_replays_count_once(spark, landing):
    from usagelens.streaming.increments import IncrementJob
    rows, parts = _parts(spark, landing)
    job = IncrementJob(spark, J.work_dir(spark, "t-inc"), horizon="400 days", compact_every=2)
    for epoch, part in enumerate(parts):
        job.take(part, epoch)
        job.take(part, epoch)                     # the same batch once more
    job.compact(3)                                # and a compaction that stopped before its mark
    assert _same(job.summary().select("product_id", "d", "launches", "devices"), J.daily_counts(rows))
    from usagelens.operators.kpis import launch_rollup
    assert _same(job.rollup(3).select(*launch_rollup(rows).columns), launch_rollup(rows))
    assert job._compacted() == 3 and job._deltas(4, 9) is None
    # a job started anew over the same folders goes on from them
    again = IncrementJob(spark, job.path, horizon="400 days", compact_every=2)
    again.take(parts[0].withColumn("launch_id", F.col("launch_id") + 10 ** 6), 4)
    assert again.summary().agg(F.sum("launches")).first()[0] == rows.count() + parts[0].count()


def test_a_batch_reads_only_the_days_it_touches(spark, landing):
    from usagelens.streaming.increments import IncrementJob
    rows, _ = _parts(spark, landing)
    job = IncrementJob(spark, J.work_dir(spark, "t-days"), horizon="400 days", compact_every=1)
    days = sorted(r.d for r in rows.select("d").distinct().collect())
    job.take(rows, 0)
    one = rows.where(F.col("d") == F.lit(days[3])).withColumn("launch_id", F.col("launch_id") + 10 ** 6)
    mine = one.select(F.col("d").alias("_day")).distinct()
    merged = job.rollup(0, mine)
    assert merged.agg(F.countDistinct("d")).first()[0] == 1
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    before = {r.d: r.launches for r in job.summary().groupBy("d").agg(F.sum("launches").alias("launches")).collect()}
    job.take(one, 1)
    after = {r.d: r.launches for r in job.summary().groupBy("d").agg(F.sum("launches").alias("launches")).collect()}
    assert {d for d in days if before[d] != after[d]} == {days[3]}


def test_late_rows_are_landed_apart_and_counted(spark):
    from usagelens.streaming.increments import IncrementJob, landed
    rows = spark.range(0, 1000, 1, 4).select(
        F.col("id").alias("launch_id"), F.lit(1).alias("product_id"), F.lit(1).alias("channel_id"), F.lit("1").alias("version"),
        F.concat(F.lit("d"), (F.col("id") % 9).cast("string")).alias("device_id"),
        F.when(F.col("id") % 100 != 3, F.timestamp_seconds(F.when(F.col("id") % 10 == 7, F.col("id") * 3600 - 90 * 86400).otherwise(F.col("id") * 3600))).alias("ts"))
    rows = rows.withColumn("d", F.to_date("ts")).withColumn("h", F.hour("ts"))
    job = IncrementJob(spark, J.work_dir(spark, "t-land"))
    for epoch in range(4):
        job.take(rows.where(F.floor(F.col("launch_id") / 250) == epoch), epoch)
    journal = {r.batch: (r.on_time, r.late) for r in job.journal().collect()}
    assert journal == {0: (250, 0), 1: (225, 25), 2: (225, 25), 3: (225, 25)}
    late = landed(spark, job.path, True, rows.schema)
    assert late.count() == 75 and late.where("launch_id % 10 <> 7").isEmpty()
    assert job.summary().agg(F.sum("launches")).first()[0] == 925
    job.repair(rows.schema, 4)
    assert _same(job.summary().select("product_id", "d", "launches", "devices"), J.daily_counts(rows))


def test_sketches_of_batches_merge_and_stay_within_their_error(spark):
    from usagelens.streaming import increments as IC
    rows = spark.range(0, 60_000, 1, 4).select(
        (F.col("id") % 2).cast("int").alias("product_id"), F.concat(F.lit("d"), (F.col("id") * 7919 % 20_011).cast("string")).alias("device_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 12).cast("int")).alias("d"))
    parts = [IC.day_sketches(rows.where(F.pmod(F.hash("device_id", "d"), F.lit(3)) == k)) for k in range(3)]
    united = IC.rolling_actives(parts[0].unionAll(parts[1]).unionAll(parts[2]), 7)
    both = united.withColumnRenamed("actives", "guess").join(IC.exact_rolling_actives(rows, 7), ["product_id", "d"]).collect()
    assert len(both) == 12                   # two products, six days each have rows
    assert max(abs(r.guess - r.actives) / r.actives for r in both) < 4 * IC.SKETCH_ERROR


START = 20_000 * 86_400        # rows before any watermark, which begins at the epoch, would be late


def _timed(spark, rows):
    return spark.createDataFrame(rows, "launch_id long, product_id int, device_id string, secs long") \
        .select("launch_id", "product_id", "device_id", F.timestamp_seconds(F.col("secs") + START).alias("ts")).withColumn("d", F.to_date("ts"))


def _steps(spark, wd, batches):
    """A stream over a landing folder, handed out after each batch landed."""
    for rows in batches:
        _timed(spark, rows).coalesce(1).write.mode("append").parquet(f"{wd}/landing")
        yield spark.readStream.schema(_timed(spark, []).schema).parquet(f"{wd}/landing")


HOUR, DAY = 3600, 86400


def test_sessions_extend_merge_and_leave_state(spark):
    from usagelens.streaming import stateful as ST
    wd = J.work_dir(spark, "t-keyed")
    batches = [[(1, 1, "a", 0), (2, 1, "a", 10 * HOUR), (3, 1, "b", HOUR), (30, 1, None, HOUR)],
               [(4, 1, "a", 5 * HOUR), (5, 1, "b", 2 * HOUR)],          # joins a's two sessions, extends b's
               [(6, 1, "c", 40 * DAY)],                                    # moves the watermark
               [(7, 1, "a", 41 * DAY)]]
    state = []
    for s in _steps(spark, wd, batches):
        q = ST.session_job(s, f"{wd}/out", f"{wd}/ckpt", "6 hours", "2 days", available_now=True)
        q.awaitTermination()
        state.append(q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress else None)
    got = sorted((r.device_id or "", int(r.session_start.timestamp()), r.launches) for r in ST.latest_sessions(spark, f"{wd}/out", "6 hours").collect())
    want = J.session_windows(J.event_time(_timed(spark, [r for b in batches for r in b])), "6 hours")
    assert got == sorted((r.device_id or "", int(r.session_start.timestamp()), r.launches) for r in want.collect())
    assert spark.read.parquet(f"{wd}/out").where("launches = 0").count() == 1
    assert state[-1] is None or state[-1] < state[1] + 2        # a, b of the first days are gone


def test_first_launch_state_corrects_and_ends(spark):
    from usagelens.operators.first_index import FirstLaunchIndex
    from usagelens.streaming import stateful as ST
    wd = J.work_dir(spark, "t-firstkeyed")
    index = FirstLaunchIndex(spark, f"{wd}/index", n_buckets=4)
    batches = [[(10, 1, "a", 5 * DAY), (11, 1, "b", 5 * DAY)],
               [(12, 1, "a", 4 * DAY), (13, 1, "b", 6 * DAY)],           # an older launch of a arrives later
               [(14, 1, "c", 30 * DAY)],                                   # closes a and b
               [(15, 1, "a", 31 * DAY), (16, 1, "c", 29 * DAY)]]
    for s in _steps(spark, wd, batches):
        ST.first_launch_job(s, index, f"{wd}/ckpt", "3 days", available_now=True).awaitTermination()
    assert {r.device_id: r.launch_id for r in index.read().collect()} == {"a": 12, "b": 11, "c": 16}
    moved = [(r.device_id, r.old.launch_id, r.launch_id) for r in index.corrections().where("old is not null").collect()]
    assert sorted(moved) == [("a", 10, 12), ("c", 14, 16)]


def test_hourly_actives_count_each_device_once(spark):
    from usagelens.streaming.increments import hourly_actives
    wd = J.work_dir(spark, "t-hours")
    batches = [[(1, 1, "a", 0), (2, 1, "a", 60), (3, 1, "b", 120), (4, 2, "a", 60)], [(5, 1, "a", 3000), (6, 1, "a", 3700)], [(7, 1, "z", 9 * HOUR)], [(8, 1, "z", 12 * HOUR)]]
    for s in _steps(spark, wd, batches):
        J.append_sink(hourly_actives(s, "2 hours"), f"{wd}/out", f"{wd}/ckpt", available_now=True).awaitTermination()
    got = sorted((int(r.window_start.timestamp()) - START, r.product_id, r.actives) for r in spark.read.parquet(f"{wd}/out").collect())
    assert got[:3] == [(0, 1, 2), (0, 2, 1), (HOUR, 1, 1)]
