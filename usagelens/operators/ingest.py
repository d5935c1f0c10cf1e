"""Ingest-side transforms (I1-I13, I16): payload parsing, validation with
reject outputs, key resolution, time repair, enrichment, crash titles and
sessionization.

All of them are per-row column expressions or joins against registry-sized
tables, so an ingest batch is a map-only stage (no shuffle) except for
sessionization, which needs the device's own ordering and stages its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.operators import runs

# ---------------------------------------------------------------------------
# Payload fields (required ones per kind) and reject codes
# ---------------------------------------------------------------------------
LAUNCH_FIELDS = ["appkey", "platform", "os_version", "language", "deviceid", "resolution",
                 "ismobiledevice", "devicename", "defaultbrowser", "javasupport", "flashversion",
                 "modulename", "imei", "imsi", "havegps", "havebt", "havewifi", "havegravity",
                 "wifimac", "version", "network", "latitude", "longitude", "isjailbroken",
                 "userid", "time", "mccmnc"]
REQUIRED = {
    "launch": ["appkey", "platform", "os_version", "language", "deviceid", "resolution"],
    "event": ["appkey", "event_identifier", "time", "activity", "version"],
    "page": ["appkey", "session_id", "start_millis", "end_millis", "duration", "activities"],
    "crash": ["appkey", "stacktrace", "time", "activity", "os_version", "deviceid"],
}
EVENT_FIELDS = ["appkey", "event_identifier", "time", "activity", "version", "acc", "label"]
PAGE_FIELDS = ["appkey", "session_id", "start_millis", "end_millis", "duration", "activities", "version"]
CRASH_FIELDS = ["appkey", "stacktrace", "time", "activity", "os_version", "deviceid", "version"]
REJECT_MISSING_FIELD = -2
REJECT_UNKNOWN_KEY = -1
REJECT_UNDEFINED_EVENT = -5
REJECT_BAD_AMOUNT = -6
BATCH_ARRAYS = {"eventInfo": "event", "errorInfo": "crash", "clientData": "launch",
                "activityInfo": "page"}
# the first is the SDKs' own; the others are common spellings of the same
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm",
                "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd")
DEFAULT_SESSION_GAP_SECONDS = 30


def _schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def _parse(raw: DataFrame, col: str, fields: list[str]) -> DataFrame:
    """The fields as columns (all NULL where ``col`` is no object), from one
    parse a row.  As a generator's output they aren't put back into the filters
    on them: each such filter would parse the text again for every field it asks."""
    return raw.select("*", F.inline(F.array(F.from_json(F.col(col), _schema(fields)))))


def parse_launch(raw: DataFrame, col: str = "payload") -> DataFrame:
    """27 launch fields; absent optional fields become '' and
    ``isjailbroken`` defaults to '0'.  Required fields stay NULL when absent
    (``validate`` rejects them)."""
    df = _parse(raw, col, LAUNCH_FIELDS)
    req = set(REQUIRED["launch"])
    for f in LAUNCH_FIELDS:
        if f in req:
            continue
        default = "0" if f == "isjailbroken" else ""
        df = df.withColumn(f, F.coalesce(F.col(f), F.lit(default)))
    return df


def parse_event(raw: DataFrame, col: str = "payload") -> DataFrame:
    """Custom event; ``acc`` defaults to '1', ``label`` to ''."""
    df = _parse(raw, col, EVENT_FIELDS)
    return (df.withColumn("acc", F.coalesce("acc", F.lit("1")))
            .withColumn("label", F.coalesce("label", F.lit(""))))


def parse_page_view(raw: DataFrame, col: str = "payload") -> DataFrame:
    """Page view."""
    return _parse(raw, col, PAGE_FIELDS)


def parse_crash(raw: DataFrame, col: str = "payload") -> DataFrame:
    """I4: crash report."""
    return _parse(raw, col, CRASH_FIELDS)


def explode_batch(raw: DataFrame, col: str = "payload") -> dict[str, DataFrame]:
    """Split a batch envelope {appkey, eventInfo[], errorInfo[],
    clientData[], activityInfo[]} into four payload sets.  Each array element
    is re-serialised to JSON with the envelope's appkey filled in when the
    element lacks one; non-array members yield nothing.

    The envelope's other columns (payload id, ingest time) stay with every
    item, and ``item_no`` is its position in the array, so an item can be
    traced back and its time repaired."""
    env_schema = T.StructType([T.StructField("appkey", T.StringType())] +
                              [T.StructField(k, T.ArrayType(T.MapType(T.StringType(), T.StringType())))
                               for k in BATCH_ARRAYS])
    rest = [c for c in raw.columns if c != col]
    env = raw.select(*rest, F.from_json(F.col(col), env_schema).alias("_e"))
    out = {}
    for arr, kind in BATCH_ARRAYS.items():
        item = F.col("_i")
        with_key = F.map_concat(F.create_map(F.lit("appkey"), F.col("_e.appkey")),
                                F.map_filter(item, lambda k, v: k != "appkey"))
        fixed = F.when(item.getItem("appkey").isNull() & F.col("_e.appkey").isNotNull(), with_key) \
                 .otherwise(item)
        out[kind] = (env.select(*rest, "_e", F.posexplode_outer(F.col(f"_e.{arr}")).alias("item_no", "_i"))
                     .where(F.col("_i").isNotNull())
                     .select(*rest, "item_no", F.to_json(fixed).alias(col)))
    return out


def validate(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required field present, and the rejects with code
    -2 and the name of the first missing field.  A field that is there but
    empty is present; an absent or JSON-null one is missing."""
    missing = F.lit(None).cast("string")
    for f in reversed(required):
        missing = F.when(F.col(f).isNull(), F.lit(f)).otherwise(missing)
    tagged = df.withColumn("_missing", missing)
    good = tagged.where(F.col("_missing").isNull()).drop("_missing")
    bad = (tagged.where(F.col("_missing").isNotNull())
           .withColumn("reject_code", F.lit(REJECT_MISSING_FIELD))
           .withColumnRenamed("_missing", "reject_reason"))
    return good, bad


def check_app_key(df: DataFrame, registry: DataFrame, key_col: str = "appkey") -> tuple[DataFrame, DataFrame]:
    """Resolve the app key to (product_id, channel_id); unknown keys
    are rejected with -1.  The registry side is broadcast by measured size."""
    reg = registry.select(F.col("app_key").alias(key_col), "product_id", "channel_id")
    good = df.join(reg, key_col, "inner")
    bad = (df.join(reg, key_col, "left_anti")
           .withColumn("reject_code", F.lit(REJECT_UNKNOWN_KEY))
           .withColumn("reject_reason", F.concat(F.lit("unknown appkey "), F.col(key_col))))
    return good, bad


def resolve_event(df: DataFrame, event_defs: DataFrame,
                  ident_col: str = "event_identifier") -> tuple[DataFrame, DataFrame]:
    """I8: the event must be defined and active for the product, else -5."""
    defs = (event_defs.where("active = 1")
            .select("product_id", F.col("event_identifier").alias(ident_col), "event_id"))
    good = df.join(defs, ["product_id", ident_col], "inner")
    bad = (df.join(defs, ["product_id", ident_col], "left_anti")
           .withColumn("reject_code", F.lit(REJECT_UNDEFINED_EVENT))
           .withColumn("reject_reason", F.concat(F.lit("undefined event "), F.col(ident_col))))
    return good, bad


def repair_time(df: DataFrame, col: str, ingest_col: str = "ingest_ts", out: str | None = None,
                formats: tuple[str, ...] = TIME_FORMATS) -> DataFrame:
    """Parse ``col`` by the first format that fits; unparsable values or
    times before 1970 become the ingest time."""
    parsed = F.coalesce(*[F.try_to_timestamp(F.col(col), F.lit(f)) for f in formats]).cast("timestamp_ntz")
    good = F.when(F.col("_parsed") >= F.lit("1970-01-01").cast("timestamp_ntz"), F.col("_parsed"))
    # a column of its own: formats are tried once a row, not at each mention
    return (df.withColumn("_parsed", parsed)
            .withColumn(out or col, F.coalesce(good, F.col(ingest_col))).drop("_parsed"))


def enrich_carrier(df: DataFrame, mccmnc: DataFrame, code_col: str = "mccmnc") -> DataFrame:
    """Carrier name from the mcc+mnc code, ``Unknown`` when absent."""
    m = mccmnc.select(F.col("code").alias("_code"), F.col("carrier").alias("_carrier"))
    return (df.join(m, F.col(code_col) == F.col("_code"), "left")
            .withColumn("carrier", F.coalesce("_carrier", F.lit("Unknown")))
            .drop("_code", "_carrier"))


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 text -> bigint; NULL unless there are four parts from 0 to
    255 (payload text is untrusted: it may be IPv6 or anything else)."""
    byte = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    parts = F.split(ip, r"\.")
    v = F.lit(0).cast("bigint")
    for i in range(4):
        v = v * 256 + F.get(parts, F.lit(i)).try_cast("bigint")
    return F.when(ip.rlike(rf"^{byte}(\.{byte}){{3}}$"), v)


def enrich_location(df: DataFrame, ip_ranges: DataFrame, ip_col: str = "ip") -> DataFrame:
    """(country, region, city) from an IP-range table (lo, hi inclusive,
    as bigints), '' when no range matches or the address is malformed.

    Range join as an equi join on the /16 block: each range is exploded into
    the /16 blocks it covers (ranges are narrow in practice) and a block's
    ranges are gathered into one array, so every row joins at most one row.
    Of overlapping ranges the narrowest wins (then the lower one).
    """
    block = F.floor(F.col("_ip") / 65536)
    left = df.withColumn("_ip", ip_to_long(F.col(ip_col))).withColumn("_blk", block)
    rng = ip_ranges.select(
        F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
        F.col("country").alias("_country"), F.col("region").alias("_region"),
        F.col("city").alias("_city"),
        F.explode(F.sequence(F.floor(F.col("lo") / 65536), F.floor(F.col("hi") / 65536))).alias("_blk"))
    blocks = rng.groupBy("_blk").agg(F.collect_list(F.struct(
        (F.col("_hi") - F.col("_lo")).alias("width"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi"),
        F.col("_country").alias("country"), F.col("_region").alias("region"), F.col("_city").alias("city"))).alias("_ranges"))
    hit = F.array_min(F.filter("_ranges", lambda r: (r["lo"] <= F.col("_ip")) & (F.col("_ip") <= r["hi"])))
    joined = left.join(blocks, "_blk", "left").withColumn("_hit", hit)
    return (joined.withColumns({c: F.coalesce(F.col(f"_hit.{c}"), F.lit("")) for c in ("country", "region", "city")})
            .drop("_ip", "_blk", "_ranges", "_hit"))


def crash_title(df: DataFrame, stack_col: str = "stacktrace", out: str = "title") -> DataFrame:
    """The first three stack lines when there are at least three,
    otherwise the first line."""
    lines = F.split(F.col(stack_col), "\n")
    title = F.when(F.size(lines) >= 3, F.array_join(F.slice(lines, 1, 3), "\n")) \
             .otherwise(F.element_at(lines, 1))
    return df.withColumn(out, title)


# Fixed value: an amount as text.
AMOUNT = r"^\s*\+?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE]\+?[0-9]{1,2})?\s*$"


def validate_amount(df: DataFrame, col: str = "acc") -> tuple[DataFrame, DataFrame]:
    """An amount is refused when empty/NULL, when it contains '-' or when
    it is no number.  Only digits with a point or exponent count as one: what a
    cast takes besides (``NaN``, ``Infinity``, ``1d``) would spoil every sum."""
    bad_cond = ~F.coalesce(F.col(col).rlike(AMOUNT) & F.col(col).try_cast("double").isNotNull(), F.lit(False))
    good = df.where(~bad_cond)
    bad = (df.where(bad_cond).withColumn("reject_code", F.lit(REJECT_BAD_AMOUNT))
           .withColumn("reject_reason", F.lit("invalid amount")))
    return good, bad


def sessionize(df: DataFrame, gap_seconds: int = DEFAULT_SESSION_GAP_SECONDS,
               by: list[str] = ("product_id", "device_id"), ts: str = "ts",
               key_col: str = "app_key", order_id: str | None = None,
               bucket_seconds: int = 3600) -> DataFrame:
    """I16: a new session starts when the gap since the device's previous
    activity exceeds ``gap_seconds``; the id is md5(key + session start + the
    ``by`` columns), so two devices that start in the same second differ.

    Every row comes out.  Rows without a device are a device of their own per
    product; rows without a time are one session of their device, which has no
    start.

    Skew-proof batch form (``operators.runs``), one read and one shuffle of the
    rows, which are staged:

    1. in each (device, time bucket) a ``lag`` window marks local starts and
       carries the latest one forward;
    2. one summary row per (device, bucket) -- first and last time, latest start
       -- is windowed over the device's buckets: a bucket goes on with the
       session before it when its first row is within the gap of the last row
       before, however far apart they are;
    3. a row whose local start isn't a real one takes the start carried there.

    Streaming callers use ``streaming.stateful.session_job`` instead.
    """
    by = list(by)
    gap_us = gap_seconds * 1_000_000
    rows = runs.dealt(df, by, ts, bucket_seconds)
    local = Window.partitionBy("_g", "_b").orderBy("_us", *([order_id] if order_id else []))
    prev = F.lag("_us").over(local)
    rows = rows.withColumn("_new", prev.isNull() | (F.col("_us") - prev > gap_us))
    start = F.last(F.when(F.col("_new"), F.col("_us")), ignorenulls=True)
    rows = runs.staged(rows.withColumn("_start", start.over(local.rowsBetween(Window.unboundedPreceding, 0))).drop("_new"), "sessions")
    buckets = rows.where("_us is not null").groupBy("_g", "_b").agg(
        F.min("_us").alias("_first"), F.max("_us").alias("_last"), F.max("_start").alias("_latest"))
    over = Window.partitionBy("_g").orderBy("_b")
    before = F.lag("_last").over(over)
    buckets = buckets.withColumn("_opens", before.isNull() | (F.col("_first") - before > gap_us))
    # the latest start of a bucket, unless it only goes on with the session before
    own = F.when(F.col("_opens") | (F.col("_latest") > F.col("_first")), F.col("_latest"))
    carried = F.last(own, ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1))
    buckets = buckets.select("_g", "_b", "_first", F.when(~F.col("_opens"), carried).alias("_carried"))
    out = rows.join(buckets, ["_g", "_b"], "left").withColumn(
        "_start", F.when(F.col("_start") == F.col("_first"), F.coalesce("_carried", "_start")).otherwise(F.col("_start")))
    out = out.withColumn("session_start", F.timestamp_micros("_start").cast(df.schema[ts].dataType))
    sid = F.md5(F.concat_ws("|", F.col(key_col).cast("string"), F.coalesce(F.date_format("session_start", "yyyyMMddHHmmss"), F.lit("")),
                            *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by]))
    return out.withColumn("session_id", sid).select(*df.columns, "session_start", "session_id")


# ---------------------------------------------------------------------------
# end-to-end ingest chains: parse -> checks (with reject outputs) -> repair
# ---------------------------------------------------------------------------

REJECT_COLS = ["payload_id", "reject_code", "reject_reason"]


def _rejects(*dfs: DataFrame) -> DataFrame:
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), [d.select(*REJECT_COLS) for d in dfs])


def ingest_launch(raw: DataFrame, registry: DataFrame, mccmnc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """I1, I6, I7, I9, I10 on launch payloads -> (launch rows, rejects)."""
    return check_launch(parse_launch(raw), registry, mccmnc)


def check_launch(p: DataFrame, registry: DataFrame, mccmnc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The checks of ``ingest_launch`` on parsed payloads."""
    good, r1 = validate(p, REQUIRED["launch"])
    good, r2 = check_app_key(good, registry)
    good = repair_time(good, "time", "ingest_ts", out="ts")
    good = enrich_carrier(good, mccmnc)
    rows = good.select(F.col("payload_id").alias("launch_id"), "product_id", "channel_id",
                       F.col("deviceid").alias("device_id"), "version", "ts", "ingest_ts",
                       F.col("os_version").alias("os"), "language", "resolution", "network", "carrier",
                       "isjailbroken")
    return rows, _rejects(r1, r2)


def ingest_event(raw: DataFrame, registry: DataFrame, event_defs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """I2, I6, I7, I8, I13, I9 on custom-event payloads."""
    return check_event(parse_event(raw), registry, event_defs)


def check_event(p: DataFrame, registry: DataFrame, event_defs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The checks of ``ingest_event`` on parsed payloads."""
    good, r1 = validate(p, REQUIRED["event"])
    good, r2 = check_app_key(good, registry)
    good, r3 = resolve_event(good, event_defs)
    good, r4 = validate_amount(good)
    good = repair_time(good, "time", "ingest_ts", out="ts")
    rows = good.select(F.col("payload_id").alias("row_id"), "product_id", "channel_id", "event_id",
                       "event_identifier", "version", "label", F.col("acc").try_cast("double").alias("num"),
                       "ts", "ingest_ts")
    return rows, _rejects(r1, r2, r3, r4)


def ingest_page(raw: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """I3, I6, I7, I9 (start and end) on page-view payloads."""
    return check_page(parse_page_view(raw), registry)


def check_page(p: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The checks of ``ingest_page`` on parsed payloads."""
    good, r1 = validate(p, REQUIRED["page"])
    good, r2 = check_app_key(good, registry)
    good = repair_time(good, "start_millis", "ingest_ts", out="start_ts")
    good = repair_time(good, "end_millis", "ingest_ts", out="end_ts")
    rows = good.select(F.col("payload_id").alias("view_id"), "product_id", "channel_id", "version",
                       "session_id", F.col("activities").alias("activity"), "start_ts", "end_ts",
                       F.col("duration").try_cast("bigint").alias("duration_ms"), "ingest_ts")
    return rows, _rejects(r1, r2)


def ingest_crash(raw: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """I4, I6, I7, I9, I12 on crash payloads."""
    return check_crash(parse_crash(raw), registry)


def check_crash(p: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The checks of ``ingest_crash`` on parsed payloads."""
    good, r1 = validate(p, REQUIRED["crash"])
    good, r2 = check_app_key(good, registry)
    good = repair_time(good, "time", "ingest_ts", out="ts")
    good = crash_title(good, "stacktrace", "title")
    rows = good.select(F.col("payload_id").alias("crash_id"), "product_id", "channel_id", "version",
                       F.col("os_version").alias("os"), F.col("deviceid").alias("device_id"),
                       "activity", "stacktrace", "title", "ts", "ingest_ts")
    return rows, _rejects(r1, r2)


def reject_summary(rejects: DataFrame) -> DataFrame:
    """Counts of rejected payloads per code and reason."""
    return (rejects.groupBy("reject_code", "reject_reason")
            .agg(F.count(F.lit(1)).cast("bigint").alias("payloads")))


def read_increment(df: DataFrame, t0, t1, col: str = "ingest_ts") -> DataFrame:
    """Rows ingested in the half-open window [t0, t1) -- a plain range
    filter that reaches the scan (and prunes ingest-date partitions)."""
    return df.where((F.col(col) >= F.lit(t0).cast("timestamp_ntz")) &
                    (F.col(col) < F.lit(t1).cast("timestamp_ntz")))


def increments(df: DataFrame, unit: str = "hour", col: str = "ingest_ts") -> DataFrame:
    """I17 batch view: rows per half-open ingest window of one ``unit``."""
    return (df.groupBy(F.date_trunc(unit, F.col(col)).cast("timestamp_ntz").alias("window_start"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("rows")))


NO_RECORDS = "(0) Records Found!"  # fixed value: text of an empty export


def export_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8") -> None:
    """Header, '"'-quoting with doubled quotes, empty/NULL written as 0,
    any charset the JVM knows (e.g. GB2312).  Without records the export is
    one line that says so."""
    if df.isEmpty():
        df.sparkSession.range(1).select(F.lit(NO_RECORDS)).coalesce(1).write.mode("overwrite").text(path)
        return
    out = df.select(*[F.coalesce(F.when(F.col(c).cast("string") == "", F.lit("0"))
                                 .otherwise(F.col(c).cast("string")), F.lit("0")).alias(c)
                      for c in df.columns])
    (out.write.mode("overwrite").option("header", True).option("sep", sep).option("quote", '"')
     .option("escape", '"').option("encoding", encoding).csv(path))


def upsert(existing: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """ON DUPLICATE KEY UPDATE semantics -- rows of ``updates`` replace
    rows of ``existing`` with the same key, others are kept (latest wins).
    An anti join plus a union: no window and no pair expansion."""
    kept = existing.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates.select(*existing.columns))


def run_log(df: DataFrame, op: str) -> tuple[DataFrame, object]:
    """Attach an Observation counting the rows an operation produces;
    read ``obs.get`` after the action (plus wall time measured by the
    caller)."""
    from pyspark.sql import Observation
    obs = Observation(op)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
