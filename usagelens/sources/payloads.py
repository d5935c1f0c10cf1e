"""Raw device payloads (JSON strings) derived from the driver's ``events``
table, with planted faults, to exercise the ingest path end to end.

Fault plan by ``event_id % 97``: 0 a required field missing, 1 unknown app
key, 2 undefined custom event, 3 unparsable time, 4 time before 1970,
5 negative amount, 6 a required field empty, 7 ISO time, 8 amount not a
number.  Each payload row carries ``payload_id`` (the arrival id)
and ``ingest_ts`` next to the JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.session import spread
from usagelens.sources import registry as R
from usagelens.sources.fixtures import _channel, _device, _product, _tagged, _version

FAULT_MOD = 97
MISSING, BAD_KEY, BAD_EVENT, BAD_TIME, OLD_TIME, BAD_AMOUNT, EMPTY, ISO_TIME, TEXT_AMOUNT = range(9)
OLD_TIME_TEXT = "1969-12-31 23:59:59"
UNKNOWN_MCCMNC = "99999"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _fault() -> Column:
    return F.col("event_id") % FAULT_MOD


def _appkey(uid: Column, eid: Column, ts: Column) -> Column:
    key = F.concat(F.lit("key-"), _product(eid).cast("string"), F.lit("-"), _channel(uid, ts).cast("string"))
    return F.when(_fault() == BAD_KEY, F.lit("key-unknown")).otherwise(key)


def _time_text(ts: Column) -> Column:
    txt = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return (F.when(_fault() == BAD_TIME, F.lit("not-a-time"))
            .when(_fault() == OLD_TIME, F.lit(OLD_TIME_TEXT))
            .when(_fault() == ISO_TIME, F.replace(txt, F.lit(" "), F.lit("T"))).otherwise(txt))


def _ingest_ts(eid: Column, ts: Column) -> Column:
    return F.when(eid % 50 == 0, ts + F.expr("INTERVAL 3 DAYS")).otherwise(ts)


def _mccmnc(uid: Column) -> Column:
    codes = F.array(*[F.lit(c) for c, _ in R.MCCMNC])
    idx = (uid % 7).cast("int")
    return F.when(idx < len(R.MCCMNC), F.element_at(codes, idx + 1)).otherwise(F.lit(UNKNOWN_MCCMNC))


def launch_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return launch_payloads_from(_events(spark, sf_dir))


def launch_payloads_from(e: DataFrame) -> DataFrame:
    """Launch payloads from an ``events`` DataFrame (batch or streaming)."""
    uid, eid, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    body = F.struct(
        _appkey(uid, eid, ts).alias("appkey"),
        F.lit("android").alias("platform"),
        F.when(_fault() == EMPTY, F.lit("")).otherwise(_tagged("os", uid % 5)).alias("os_version"),
        _tagged("lang", uid % 3).alias("language"),
        F.when(_fault() == MISSING, F.lit(None).cast("string")).otherwise(_device(uid)).alias("deviceid"),
        _tagged("res", uid % 6).alias("resolution"),
        _version(uid, ts).alias("version"),
        _tagged("net", eid % 4).alias("network"),
        _time_text(ts).alias("time"),
        _mccmnc(uid).alias("mccmnc"),
        uid.cast("string").alias("userid"),
    )
    return e.select(eid.alias("payload_id"), F.to_json(body).alias("payload"),
                    _ingest_ts(eid, ts).alias("ingest_ts"))


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_payloads_from(_events(spark, sf_dir))


def event_payloads_from(e: DataFrame) -> DataFrame:
    """Event payloads from an ``events`` DataFrame (batch or streaming)."""
    uid, eid, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    ident = F.when(_fault() == BAD_EVENT, F.lit("no-such-event")).otherwise(F.col("event_type"))
    acc = (F.lit(1) + eid % 3).cast("string")
    body = F.struct(
        _appkey(uid, eid, ts).alias("appkey"),
        ident.alias("event_identifier"),
        _time_text(ts).alias("time"),
        F.lit("main").alias("activity"),
        F.when(_fault() == MISSING, F.lit(None).cast("string")).otherwise(_version(uid, ts)).alias("version"),
        F.when(_fault() == BAD_AMOUNT, F.concat(F.lit("-"), acc)).when(_fault() == TEXT_AMOUNT, F.lit("many"))
         .otherwise(acc).alias("acc"),
        _device(uid).alias("deviceid"),
    )
    return e.select(eid.alias("payload_id"), F.to_json(body).alias("payload"),
                    _ingest_ts(eid, ts).alias("ingest_ts"))


def page_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_payloads_from(_events(spark, sf_dir))


def page_payloads_from(e: DataFrame) -> DataFrame:
    """Page payloads from an ``events`` DataFrame (batch or streaming)."""
    uid, eid, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    dur = F.round(F.col("value") * 1000).cast("bigint")
    end = F.timestamp_add("MILLISECOND", dur, ts)
    body = F.struct(
        _appkey(uid, eid, ts).alias("appkey"),
        F.concat(F.lit("s"), uid.cast("string"), F.lit("-"), _product(eid).cast("string")).alias("session_id"),
        _time_text(ts).alias("start_millis"),
        F.date_format(end, "yyyy-MM-dd HH:mm:ss").alias("end_millis"),
        dur.cast("string").alias("duration"),
        F.when(_fault() == MISSING, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("activities"),
        _version(uid, ts).alias("version"),
    )
    return e.select(eid.alias("payload_id"), F.to_json(body).alias("payload"),
                    _ingest_ts(eid, ts).alias("ingest_ts"))


def crash_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crash_payloads_from(_events(spark, sf_dir))


def crash_payloads_from(e: DataFrame) -> DataFrame:
    """Crash payloads from an ``events`` DataFrame (batch or streaming)."""
    e = e.where(F.col("event_type") == "error")
    uid, eid, ts = F.col("user_id"), F.col("event_id"), F.col("ts")
    nl = F.lit("\n")
    stack = F.concat(F.lit("E"), (eid % 9).cast("string"), nl, F.lit("at f"), (eid % 4).cast("string"),
                     nl, F.lit("at g"), nl, F.lit("at main"))
    body = F.struct(
        _appkey(uid, eid, ts).alias("appkey"),
        F.when(_fault() == MISSING, F.lit(None).cast("string")).otherwise(stack).alias("stacktrace"),
        _time_text(ts).alias("time"),
        F.lit("main").alias("activity"),
        _tagged("os", uid % 5).alias("os_version"),
        _device(uid).alias("deviceid"),
        _version(uid, ts).alias("version"),
    )
    return e.select(eid.alias("payload_id"), F.to_json(body).alias("payload"),
                    _ingest_ts(eid, ts).alias("ingest_ts"))


def batch_envelopes(spark: SparkSession, sf_dir: str, items_per_envelope: int = 64) -> DataFrame:
    """I5 input: one envelope per (app key, device, block of arrival ids)
    holding the launch, event, page and crash items of that block.  The block
    bound keeps every envelope small regardless of how active a device is (as
    device uploads are).  An envelope arrives with its last item."""
    lp = launch_payloads(spark, sf_dir).select("payload_id", F.col("payload").alias("launch"), "ingest_ts")
    ep, pp, cp = (f(spark, sf_dir).select("payload_id", F.col("payload").alias(name)) for f, name in (
        (event_payloads, "event"), (page_payloads, "page"), (crash_payloads, "crash")))
    e = _events(spark, sf_dir).select(
        F.col("event_id").alias("payload_id"),
        F.concat(F.lit("key-"), _product(F.col("event_id")).cast("string")).alias("envkey"),
        F.col("user_id"))
    j = e.join(lp, "payload_id").join(ep, "payload_id").join(pp, "payload_id").join(cp, "payload_id", "left")
    grp = j.groupBy("envkey", "user_id", F.floor(F.col("payload_id") / items_per_envelope).alias("blk"))
    env = grp.agg(F.collect_list(F.from_json("launch", "map<string,string>")).alias("clientData"),
                  F.collect_list(F.from_json("event", "map<string,string>")).alias("eventInfo"),
                  F.collect_list(F.from_json("page", "map<string,string>")).alias("activityInfo"),
                  F.collect_list(F.from_json("crash", "map<string,string>")).alias("errorInfo"),
                  F.min("payload_id").alias("payload_id"), F.max("ingest_ts").alias("ingest_ts"))
    return env.select("payload_id", "ingest_ts", F.to_json(F.struct(F.col("envkey").alias("appkey"), "clientData",
                                                                    "eventInfo", "activityInfo", "errorInfo")).alias("payload"))
