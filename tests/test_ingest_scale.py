"""What an ingest does per payload and per landed span, on rows built here."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from usagelens.operators import ingest as IN
from usagelens.sources import registry as R
from usagelens.streaming import jobs as J

RAW = "payload_id long, payload string, ingest_ts timestamp_ntz"
NOW = dt.datetime(2024, 1, 2)
LAUNCH = {"appkey": "key-1-1", "platform": "android", "os_version": "1", "language": "en", "deviceid": "d1", "resolution": "r",
          "time": "2024-01-01 10:00:00", "version": "1.9"}
EVENT = {"appkey": "key-1-1", "event_identifier": "view", "time": "2024-01-01 10:00:00", "activity": "main", "version": "1.9"}
PAGE = {"appkey": "key-1-1", "session_id": "s", "start_millis": "2024-01-01 10:00:00", "end_millis": "2024-01-01T10:00:05",
        "duration": "5000", "activities": "main", "version": "1.9"}


def payloads(spark, *texts):
    return spark.createDataFrame([(k, t, NOW) for k, t in enumerate(texts)], RAW)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_launch_payloads_are_parsed_once_a_row(spark):
    """the checks on the fields don't bring a parse each."""
    rows, _ = IN.ingest_launch(payloads(spark, json.dumps(LAUNCH)), R.channels(spark), R.mccmnc(spark))
    assert physical(rows).count("from_json") == 1


def test_absent_and_broken_payloads_are_rejected(spark):
    """a text that is no object has no field, as before."""
    raw = payloads(spark, json.dumps(LAUNCH), None, "{not json", "", "{}")
    rows, rejects = IN.ingest_launch(raw, R.channels(spark), R.mccmnc(spark))
    assert [r.launch_id for r in rows.collect()] == [0]
    assert sorted((r.payload_id, r.reject_code, r.reject_reason) for r in rejects.collect()) == [
        (k, IN.REJECT_MISSING_FIELD, "appkey") for k in (1, 2, 3, 4)]


def test_a_landed_span_is_dealt_over_the_cores(spark):
    """events of one partition land in files for all tasks, none lost or doubled."""
    from usagelens.plans.catalog import Inputs
    from usagelens.plans.stream_queries import event_streams
    at = F.timestamp_seconds(F.col("id") + 1704067200).cast("timestamp_ntz")
    wd = J.work_dir(spark, "t-spread")
    spark.range(0, 4000, 1, 1).select(F.col("id").alias("event_id"), at.alias("ts")).write.parquet(f"{wd}/events.parquet")
    for n, _ in enumerate(event_streams(Inputs(spark, wd), wd), 1):
        assert len(spark.read.parquet(f"{wd}/landing").inputFiles()) == n * spark.sparkContext.defaultParallelism
    landed, rows = spark.read.parquet(f"{wd}/landing"), spark.read.parquet(f"{wd}/events.parquet")
    assert landed.exceptAll(rows).isEmpty() and rows.exceptAll(landed).isEmpty()


def test_page_times_try_their_formats_once_a_row(spark):
    """start and end are each parsed once, not at every mention."""
    rows, _ = IN.ingest_page(payloads(spark, json.dumps(PAGE)), R.channels(spark))
    plan = physical(rows)
    assert plan.count("from_json") == 1 and plan.count("yyyy/MM/dd HH:mm:ss") == 2
    assert [(r.start_ts, r.end_ts) for r in rows.collect()] == [(dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10, 0, 5))]


def test_a_batch_is_parsed_once_for_rows_and_rejects(spark):
    """the checks get parsed payloads that are kept; all kinds of rejects read those."""
    from usagelens.streaming import ingest as SI
    faults = [{}, {"time": None}, {"appkey": "none"}, {"event_identifier": "none"}, {"acc": "-1"}]
    wd = J.work_dir(spark, "t-once")
    payloads(spark, *[json.dumps(EVENT | f) for f in faults]).write.parquet(f"{wd}/in")
    stream = spark.readStream.schema(RAW).parquet(f"{wd}/in")
    seen = []

    def check(parsed):
        seen.append((parsed.storageLevel.useMemory, "payload" in parsed.columns, "event_identifier" in parsed.columns))
        return IN.check_event(parsed, R.channels(spark), R.event_defs(spark))

    SI.ingest_stream(stream, IN.parse_event, check, f"{wd}/out", f"{wd}/rejects", f"{wd}/ckpt", available_now=True).awaitTermination()
    assert seen == [(True, False, True)]
    assert [r.row_id for r in spark.read.parquet(f"{wd}/out").collect()] == [0]
    assert sorted((r.payload_id, r.reject_code) for r in spark.read.parquet(f"{wd}/rejects").collect()) == [
        (1, IN.REJECT_MISSING_FIELD), (2, IN.REJECT_UNKNOWN_KEY), (3, IN.REJECT_UNDEFINED_EVENT), (4, IN.REJECT_BAD_AMOUNT)]


def test_event_fact_and_its_rejects_read_the_rows_once(spark):
    """rows and rejects come from one join; payloads are parsed once for it, once for the dimension."""
    from usagelens.plans import catalog
    wd = J.work_dir(spark, "t-fact")
    days = [dt.datetime(2024, 1, d, 12) for d in (1, 1, 10, 15, 25, 25)]
    spark.createDataFrame([(10 + k, t, k, "view", 1.0, "{}") for k, t in enumerate(days)],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{wd}/events.parquet")
    fact = catalog.spark_callables()["event_fact_build"](spark, wd)
    plan = physical(fact)
    assert plan.count("from_json") == 2 and plan.count("FileScan parquet") == 2
    got = {r.row_id: (r.version, r.channel_id, r.state) for r in fact.collect()}
    assert got == {10: ("1.2", 2, "rejected"), 11: ("1.2", 3, "rejected"), 12: ("1.2", 1, "rejected"),
                   13: ("1.9", 3, "active"), 14: ("1.10", 2, "active"), 15: ("1.10", 3, "active")}


def test_rows_keep_an_unset_flag_and_null_keys_are_unknown(spark):
    """a known key without a flag is no reject; a NULL version matches none."""
    from usagelens.operators import facts as FA
    rows = spark.createDataFrame([(1, 1, 1, "1", NOW), (2, 1, 1, None, NOW), (3, 1, 2, "1", NOW)],
                                 "row_id int, product_id int, channel_id int, version string, ts timestamp_ntz")
    dim = spark.createDataFrame([(1, 1, "1", None, 1, 1), (1, 1, None, 1, 1, 1)], "product_id int, channel_id int, version string, "
                                "product_active int, channel_active int, version_active int")
    good, rejects = FA.build_event_fact(rows, dim)
    assert [(r.row_id, r.active) for r in good.collect()] == [(1, None)]
    assert sorted(r.row_id for r in rejects.collect()) == [2, 3]
    assert sorted((r.row_id, r.known) for r in FA.tag_day_rows(rows, dim).collect()) == [(1, True), (2, False), (3, False)]
