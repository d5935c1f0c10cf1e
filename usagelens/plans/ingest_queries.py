"""Ingest chains (I*), dimension maintenance (D*), fact builds (L1-L4) and
the idempotent summary upsert (I19), all over payloads/rows derived from the
driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from usagelens.functions.densify import densify
from usagelens.operators import dims as DM
from usagelens.operators import events as EV
from usagelens.operators import facts as FA
from usagelens.operators import ingest as IN
from usagelens.operators import kpis as K
from usagelens.plans.catalog import Inputs, query
from usagelens.plans.kpi_queries import kpi_oracle
from usagelens.sources import payloads as PL
from usagelens.sources import registry as R

F97 = "(e.event_id % 97)"
PRODUCT = "CAST(1 + e.event_id % 3 AS INTEGER)"
CHANNEL = "CAST(1 + (e.user_id + day(e.ts)) % 4 AS INTEGER)"
VERSION = ("CASE WHEN day(e.ts) <= 8 + e.user_id % 7 THEN '1.2' WHEN day(e.ts) <= 20 THEN '1.9' "
           "ELSE '1.10' END")
INGEST = "CASE WHEN e.event_id % 50 = 0 THEN e.ts + INTERVAL 3 DAY ELSE e.ts END"
REPAIRED = f"CASE WHEN {F97} IN (3, 4) THEN {INGEST} ELSE date_trunc('second', e.ts) END"
CARRIER = ("CASE e.user_id % 7 " + " ".join(f"WHEN {i} THEN '{c}'" for i, (_, c) in enumerate(R.MCCMNC))
           + " ELSE 'Unknown' END")


def launch_rows(i: Inputs):
    return IN.ingest_launch(PL.launch_payloads(i.spark, i.sf_dir), i.channels, R.mccmnc(i.spark))


LAUNCH_SQL = f"""SELECT e.event_id AS launch_id, {PRODUCT} AS product_id, {CHANNEL} AS channel_id,
  'd' || CAST(e.user_id AS VARCHAR) AS device_id, {VERSION} AS version, {REPAIRED} AS ts, {INGEST} AS ingest_ts,
  CASE WHEN {F97} = 6 THEN '' ELSE 'os' || CAST(e.user_id % 5 AS VARCHAR) END AS os, 'lang' || CAST(e.user_id % 3 AS VARCHAR) AS language,
  'res' || CAST(e.user_id % 6 AS VARCHAR) AS resolution, 'net' || CAST(e.event_id % 4 AS VARCHAR) AS network,
  {CARRIER} AS carrier, '0' AS isjailbroken
FROM events e WHERE {F97} NOT IN (0, 1)"""


@query("ingest_launch", LAUNCH_SQL)
def ingest_launch(i: Inputs):
    """Launch payloads parsed, checked, time-repaired and
    enriched with the carrier."""
    return launch_rows(i)[0]


@query("ingest_launch_rejects", f"""
SELECT -2 AS reject_code, 'deviceid' AS reject_reason, CAST(count(*) AS BIGINT) AS payloads
FROM events e WHERE {F97} = 0 HAVING count(*) > 0
UNION ALL
SELECT -1, 'unknown appkey key-unknown', CAST(count(*) AS BIGINT) FROM events e WHERE {F97} = 1 HAVING count(*) > 0""")
def ingest_launch_rejects(i: Inputs):
    """Rejected launch payloads by code and reason."""
    return IN.reject_summary(launch_rows(i)[1])


def event_rows(i: Inputs):
    return IN.ingest_event(PL.event_payloads(i.spark, i.sf_dir), i.channels, i.event_defs)


EVENT_SQL = f"""SELECT e.event_id AS row_id, {PRODUCT} AS product_id, {CHANNEL} AS channel_id,
  CAST(CASE e.event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 END
       AS INTEGER) AS event_id,
  e.event_type AS event_identifier, {VERSION} AS version, '' AS label,
  CAST(1 + e.event_id % 3 AS DOUBLE) AS num, {REPAIRED} AS ts, {INGEST} AS ingest_ts
FROM events e WHERE {F97} NOT IN (0, 1, 2, 5, 8) AND e.event_type <> 'error'"""


@query("ingest_event", EVENT_SQL)
def ingest_event(i: Inputs):
    """Custom-event payloads through every check."""
    return event_rows(i)[0]


@query("ingest_event_rejects", f"""
WITH x AS (SELECT e.event_type, {F97} AS f FROM events e),
c AS (SELECT CASE WHEN f = 0 THEN -2 WHEN f = 1 THEN -1 WHEN f = 2 OR event_type = 'error' THEN -5
                  WHEN f IN (5, 8) THEN -6 END AS reject_code,
             CASE WHEN f = 0 THEN 'version' WHEN f = 1 THEN 'unknown appkey key-unknown'
                  WHEN f = 2 THEN 'undefined event no-such-event'
                  WHEN event_type = 'error' THEN 'undefined event error'
                  WHEN f IN (5, 8) THEN 'invalid amount' END AS reject_reason FROM x)
SELECT reject_code, reject_reason, CAST(count(*) AS BIGINT) AS payloads FROM c
WHERE reject_code IS NOT NULL GROUP BY ALL""")
def ingest_event_rejects(i: Inputs):
    """Rejected custom-event payloads."""
    return IN.reject_summary(event_rows(i)[1])


PAGE_SQL = f"""SELECT e.event_id AS view_id, {PRODUCT} AS product_id, {CHANNEL} AS channel_id,
  {VERSION} AS version, 's' || CAST(e.user_id AS VARCHAR) || '-' || CAST({PRODUCT} AS VARCHAR) AS session_id,
  e.event_type AS activity, {REPAIRED} AS start_ts,
  date_trunc('second', e.ts + to_milliseconds(CAST(round(e.value * 1000) AS BIGINT))) AS end_ts,
  CAST(round(e.value * 1000) AS BIGINT) AS duration_ms, {INGEST} AS ingest_ts
FROM events e WHERE {F97} NOT IN (0, 1)"""


@query("ingest_page", PAGE_SQL)
def ingest_page(i: Inputs):
    """Page-view payloads; start and end times repaired."""
    return IN.ingest_page(PL.page_payloads(i.spark, i.sf_dir), i.channels)[0]


CRASH_SQL = f"""SELECT e.event_id AS crash_id, {PRODUCT} AS product_id, {CHANNEL} AS channel_id,
  {VERSION} AS version, 'os' || CAST(e.user_id % 5 AS VARCHAR) AS os, 'd' || CAST(e.user_id AS VARCHAR) AS device_id,
  'main' AS activity,
  'E' || CAST(e.event_id % 9 AS VARCHAR) || chr(10) || 'at f' || CAST(e.event_id % 4 AS VARCHAR)
    || chr(10) || 'at g' || chr(10) || 'at main' AS stacktrace,
  'E' || CAST(e.event_id % 9 AS VARCHAR) || chr(10) || 'at f' || CAST(e.event_id % 4 AS VARCHAR)
    || chr(10) || 'at g' AS title, {REPAIRED} AS ts, {INGEST} AS ingest_ts
FROM events e WHERE e.event_type = 'error' AND {F97} NOT IN (0, 1)"""


@query("ingest_crash", CRASH_SQL)
def ingest_crash(i: Inputs):
    """Crash payloads with titles."""
    return IN.ingest_crash(PL.crash_payloads(i.spark, i.sf_dir), i.channels)[0]


@query("batch_split_counts", """
SELECT 'launch' AS kind, CAST(count(*) AS BIGINT) AS items FROM events
UNION ALL SELECT 'event', CAST(count(*) AS BIGINT) FROM events
UNION ALL SELECT 'crash', CAST(count(*) AS BIGINT) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'page', CAST(count(*) AS BIGINT) FROM events""")
def batch_split_counts(i: Inputs):
    """Items per kind after splitting the batch envelopes."""
    parts = IN.explode_batch(PL.batch_envelopes(i.spark, i.sf_dir))
    from functools import reduce
    counts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("items")).select(F.lit(k).alias("kind"), "items")
              for k, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query("batch_launch_valid", f"""
WITH x AS (SELECT e.*, {F97} AS f97, {PRODUCT} AS product_id, {INGEST} AS ingest FROM events e),
env AS (SELECT *, min(event_id) OVER w AS envelope, max(ingest) OVER w AS arrived FROM x
        WINDOW w AS (PARTITION BY product_id, user_id, event_id // 64))
SELECT product_id, envelope, CAST(count(*) AS BIGINT) AS launches,
  max(CASE WHEN f97 IN (3, 4) THEN arrived ELSE date_trunc('second', ts) END) AS last_ts
FROM env WHERE f97 NOT IN (0, 1) GROUP BY ALL""")
def batch_launch_valid(i: Inputs):
    """I5 -> I1/I6/I7/I9: launches per product and envelope that pass the
    checks after the split, with their last (repaired) time."""
    raw = IN.explode_batch(PL.batch_envelopes(i.spark, i.sf_dir))["launch"]
    rows, _ = IN.ingest_launch(raw, i.channels, R.mccmnc(i.spark))
    return rows.groupBy("product_id", F.col("launch_id").alias("envelope")).agg(
        F.count(F.lit(1)).cast("bigint").alias("launches"), F.max("ts").alias("last_ts"))


GAP_S = 6 * 3600


@query("session_assign", f"""
WITH l AS (SELECT launch_id, product_id, device_id, ts, 'key-' || CAST(product_id AS VARCHAR) AS app_key FROM launch),
g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {GAP_S * 1_000_000}
                 THEN 1 ELSE 0 END AS nw
      FROM l WINDOW w AS (PARTITION BY product_id, device_id ORDER BY ts, launch_id)),
s AS (SELECT *, sum(nw) OVER (PARTITION BY product_id, device_id ORDER BY ts, launch_id
                              ROWS UNBOUNDED PRECEDING) AS sn FROM g),
t AS (SELECT *, min(ts) OVER (PARTITION BY product_id, device_id, sn) AS session_start FROM s)
SELECT launch_id, product_id, device_id, session_start,
  md5(app_key || '|' || strftime(session_start, '%Y%m%d%H%M%S') || '|' || product_id || '|' || device_id) AS session_id FROM t""")
def session_assign(i: Inputs):
    """I16: session ids with a 6-hour inactivity gap (the 30 s SDK default
    would make every synthetic event its own session)."""
    l = i.launch.select("launch_id", "product_id", "device_id", "ts",
                        F.concat(F.lit("key-"), F.col("product_id").cast("string")).alias("app_key"))
    s = IN.sessionize(l, GAP_S, ["product_id", "device_id"], "ts", "app_key", order_id="launch_id")
    return s.select("launch_id", "product_id", "device_id", "session_start", "session_id")


@query("session_assign_gaps", f"""
WITH l AS (SELECT launch_id, product_id, CASE WHEN launch_id % 41 <> 0 THEN device_id END AS device_id,
             CASE WHEN launch_id % 43 <> 0 THEN ts END AS ts, 'key-' || CAST(product_id AS VARCHAR) AS app_key FROM launch),
g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {GAP_S * 1_000_000} THEN 1 ELSE 0 END AS nw
      FROM l WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY product_id, device_id ORDER BY ts, launch_id)),
s AS (SELECT *, sum(nw) OVER (PARTITION BY product_id, device_id ORDER BY ts, launch_id ROWS UNBOUNDED PRECEDING) AS sn FROM g),
t AS (SELECT launch_id, product_id, device_id, app_key, min(ts) OVER (PARTITION BY product_id, device_id, sn) AS session_start FROM s
      UNION ALL SELECT launch_id, product_id, device_id, app_key, NULL FROM l WHERE ts IS NULL)
SELECT launch_id, product_id, device_id, session_start,
  md5(app_key || '|' || coalesce(strftime(session_start, '%Y%m%d%H%M%S'), '') || '|' || product_id || '|' || coalesce(device_id, '')) AS session_id FROM t""")
def session_assign_gaps(i: Inputs):
    """I16 where devices and times are missing: every row keeps a session."""
    l = i.launch.select("launch_id", "product_id", F.when(F.col("launch_id") % 41 != 0, F.col("device_id")).alias("device_id"),
                        F.when(F.col("launch_id") % 43 != 0, F.col("ts")).alias("ts"),
                        F.concat(F.lit("key-"), F.col("product_id").cast("string")).alias("app_key"))
    s = IN.sessionize(l, GAP_S, ["product_id", "device_id"], "ts", "app_key", order_id="launch_id")
    return s.select("launch_id", "product_id", "device_id", "session_start", "session_id")


AMOUNTS = ("7", "23.3", "1e2", "NaN", "Infinity", "1d", "-4", "", " 5 ", ".5", "+2")


@query("event_amounts_text", f"""
WITH a AS (SELECT product_id, event_id, list_value({", ".join(f"'{x}'" for x in AMOUNTS)})[CAST(row_id % {len(AMOUNTS)} AS INTEGER) + 1] AS acc FROM app_event),
s AS (SELECT product_id, event_id, sum(CAST(trim(acc) AS DOUBLE)) AS amount FROM a
      WHERE regexp_full_match(acc, '\\s*\\+?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE]\\+?[0-9]{{1,2}})?\\s*') GROUP BY ALL)
SELECT d.product_id, d.event_id, d.event_identifier, round(coalesce(s.amount, 0), 6) AS amount FROM event_defs d
LEFT JOIN s ON s.product_id = d.product_id AND s.event_id = d.event_id""")
def event_amounts_text(i: Inputs):
    """I13 -> E5: amounts as text, with fractions and what is no number; the sum keeps fractions."""
    acc = F.element_at(F.array(*map(F.lit, AMOUNTS)), (F.col("row_id") % len(AMOUNTS) + 1).cast("int"))
    good, _ = IN.validate_amount(i.app_event.withColumn("acc", acc))
    sums = EV.event_amounts(good.withColumn("num", F.trim("acc").cast("double")), i.event_defs)
    return sums.withColumn("amount", F.round("amount", 6))


@query("version_grid_gaps", """
WITH v AS (SELECT product_id, CASE WHEN launch_id % 37 <> 0 THEN version END AS version, d FROM launch),
k AS (SELECT DISTINCT product_id, version FROM v), s AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM v)
SELECT k.product_id, k.version, s.d, CAST(count(v.d) AS BIGINT) AS sessions FROM k CROSS JOIN s
LEFT JOIN v ON v.product_id = k.product_id AND v.version IS NOT DISTINCT FROM k.version AND v.d = s.d GROUP BY ALL""")
def version_grid_gaps(i: Inputs):
    """Dense version series where some launches have no version: null is a version of its own."""
    rows = i.launch.select("product_id", F.when(F.col("launch_id") % 37 != 0, F.col("version")).alias("version"), "d")
    counts = rows.groupBy("product_id", "version", "d").agg(F.count(F.lit(1)).cast("bigint").alias("sessions"))
    return densify(counts, ["product_id", "version"], ["sessions"], span_src=rows)


@query("ingest_increments", """
SELECT date_trunc('hour', ingest_ts) AS window_start, CAST(count(*) AS BIGINT) AS rows FROM launch GROUP BY ALL""")
def ingest_increments(i: Inputs):
    """Rows per hourly half-open ingest window."""
    return IN.increments(i.launch)


WINDOW_STARTS = [f"2024-01-{d:02d}" for d in (1, 8, 15, 22, 29)] + ["2024-02-05"]  # fixed values: weekly ingest windows


@query("ingest_window_parts", "\nUNION ALL\n".join(
    f"SELECT DATE '{a}' AS window_start, CAST(count(*) AS BIGINT) AS rows FROM launch "
    f"WHERE ingest_ts >= TIMESTAMP '{a}' AND ingest_ts < TIMESTAMP '{b}'"
    for a, b in zip(WINDOW_STARTS, WINDOW_STARTS[1:])) + "\nUNION ALL SELECT NULL, CAST(count(*) AS BIGINT) FROM launch")
def ingest_window_parts(i: Inputs):
    """Rows of consecutive half-open ingest windows, and of the whole
    (window_start NULL), which they add up to."""
    from functools import reduce
    count = lambda df, start: df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")) \
        .select(F.lit(start).cast("date").alias("window_start"), "rows")
    parts = [count(IN.read_increment(i.launch, a, b), a) for a, b in zip(WINDOW_STARTS, WINDOW_STARTS[1:])]
    return reduce(lambda x, y: x.unionAll(y), [*parts, count(i.launch, None)])


@query("export_csv_rows", """
SELECT CAST(product_id AS VARCHAR) AS product_id, 'a "quoted", ' || event_type AS label,
  CASE WHEN event_type = 'error' THEN '0' ELSE CAST(count(*) AS VARCHAR) END AS n
FROM (SELECT l.product_id, e.event_type FROM launch l JOIN events e ON e.event_id = l.launch_id) GROUP BY product_id, event_type
UNION ALL SELECT NULL, '(0) Records Found!', NULL""")
def export_csv_rows(i: Inputs):
    """An export read back (quotes, separators, NULL as 0), and the text
    of an export without records."""
    from usagelens.streaming.jobs import work_dir
    e = i.spark.read.parquet(f"{i.sf_dir}/events.parquet").select(F.col("event_id").alias("launch_id"), "event_type")
    rows = i.launch.join(e, "launch_id").groupBy("product_id", "event_type").agg(F.count(F.lit(1)).alias("n")).select(
        "product_id", F.concat(F.lit('a "quoted", '), F.col("event_type")).alias("label"),
        F.when(F.col("event_type") != "error", F.col("n")).alias("n"))
    wd = work_dir(i.spark, "export")
    IN.export_csv(rows, f"{wd}/full")
    IN.export_csv(rows.where("false"), f"{wd}/empty")
    back = i.spark.read.schema("product_id string, label string, n string").option("header", True).option("escape", '"').csv(f"{wd}/full")
    none = F.lit(None).cast("string")
    return back.unionAll(i.spark.read.text(f"{wd}/empty").select(none, "value", none))


# ---------------------------------------------------------------------------
# D*: dimension maintenance (known = ingested before the cut, new = after)
# ---------------------------------------------------------------------------

# after the first minutes of the log almost every value is still to come
CUT = "2024-01-01 00:15:00"


@query("dim_location_new", f"""
SELECT DISTINCT country, region FROM launch WHERE ingest_ts >= TIMESTAMP '{CUT}'
EXCEPT SELECT DISTINCT country, region FROM launch WHERE ingest_ts < TIMESTAMP '{CUT}'""")
def dim_location_new(i: Inputs):
    """(country, region) pairs first seen after the cut."""
    known = i.launch.where(F.col("ingest_ts") < F.lit(CUT).cast("timestamp_ntz"))
    inc = i.launch.where(F.col("ingest_ts") >= F.lit(CUT).cast("timestamp_ntz"))
    return DM.extend_dim(known, inc, ["country", "region"])


ATTRS = ["brand", "os", "language", "resolution", "carrier", "network"]


@query("dim_values_new", "\nUNION ALL\n".join(
    f"(SELECT '{a}' AS attribute, CAST({a} AS VARCHAR) AS value FROM launch WHERE ts >= TIMESTAMP '{CUT}' "
    f"EXCEPT SELECT '{a}', CAST({a} AS VARCHAR) FROM launch WHERE ts < TIMESTAMP '{CUT}')" for a in ATTRS))
def dim_values_new(i: Inputs):
    """Unseen brand/OS/language/resolution/carrier/network values."""
    known = i.launch.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    inc = i.launch.where(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"))
    return DM.new_attribute_values(known, inc, ATTRS)


@query("dim_activity_new", f"""
SELECT DISTINCT product_id, activity FROM page WHERE start_ts >= TIMESTAMP '{CUT}'
EXCEPT SELECT DISTINCT product_id, activity FROM page WHERE start_ts < TIMESTAMP '{CUT}'""")
def dim_activity_new(i: Inputs):
    """(product, activity) pairs first seen after the first days."""
    known = i.page.where(F.col("start_ts") < F.lit(CUT).cast("timestamp_ntz"))
    inc = i.page.where(F.col("start_ts") >= F.lit(CUT).cast("timestamp_ntz"))
    return DM.extend_dim(known, inc, ["product_id", "activity"])


@query("dim_errortitle_new", f"""
SELECT product_id, title, false AS is_fixed FROM (
  SELECT DISTINCT product_id, title FROM crash WHERE ts >= TIMESTAMP '{CUT}'
  EXCEPT SELECT DISTINCT product_id, title FROM crash WHERE ts < TIMESTAMP '{CUT}')""")
def dim_errortitle_new(i: Inputs):
    """Crash titles first seen after the first days, inserted unfixed."""
    known = i.crash.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    inc = i.crash.where(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"))
    return DM.extend_dim(known, inc, ["product_id", "title"]).withColumn("is_fixed", F.lit(False))


@query("product_dim", """
SELECT DISTINCT l.product_id, p.product_name, l.channel_id, c.channel_name, l.version, p.owner_id, p.platform,
  c.product_active, c.channel_active, 1 AS version_active
FROM launch l JOIN channels c ON c.product_id = l.product_id AND c.channel_id = l.channel_id
JOIN products p ON p.product_id = l.product_id""")
def product_dim(i: Inputs):
    """Product dimension = registry x observed versions."""
    return DM.sync_product_dim(i.channels, i.products, i.launch)


DISABLED = [(1, "1.2"), (2, "1.10"), (3, "9.9")]  # fixed values: test list of disabled versions


@query("product_dim_versions", """
WITH x AS (SELECT * FROM (VALUES (1, '1.2'), (2, '1.10'), (3, '9.9')) v(product_id, version))
SELECT DISTINCT l.product_id, p.product_name, l.channel_id, c.channel_name, l.version, p.owner_id, p.platform,
  c.product_active, c.channel_active, CASE WHEN EXISTS (SELECT 1 FROM x WHERE x.product_id = l.product_id AND x.version = l.version) THEN 0 ELSE 1 END AS version_active
FROM launch l JOIN channels c ON c.product_id = l.product_id AND c.channel_id = l.channel_id
JOIN products p ON p.product_id = l.product_id""")
def product_dim_versions(i: Inputs):
    """The same with some versions disabled."""
    off = R.local_table(i.spark, DISABLED, "product_id int, version string")
    return DM.sync_product_dim(i.channels, i.products, i.launch, off)


FIX_OVERLAY = [(1, "E2\nat f2\nat g", True), (2, "E0\nat f0\nat g", False)]  # fixed values: test overlay


@query("error_title_dim", """
WITH t AS (SELECT product_id, title, bool_or(is_fixed) AS is_fixed FROM crash GROUP BY ALL),
o AS (SELECT * FROM (VALUES (1, 'E2' || chr(10) || 'at f2' || chr(10) || 'at g', true),
                            (2, 'E0' || chr(10) || 'at f0' || chr(10) || 'at g', false)) v(product_id, title, fix))
SELECT t.product_id, t.title, coalesce(o.fix, t.is_fixed) AS is_fixed
FROM t LEFT JOIN o ON o.product_id = t.product_id AND o.title = t.title""")
def error_title_dim(i: Inputs):
    """Error-title dimension with a fixed/unfixed overlay applied."""
    titles = i.crash.groupBy("product_id", "title").agg(F.bool_or("is_fixed").alias("is_fixed"))
    overlay = R.local_table(i.spark, FIX_OVERLAY, "product_id int, title string, is_fixed boolean")
    return DM.set_fixed(titles, overlay)


@query("distinct_versions", "SELECT DISTINCT product_id, version FROM launch")
def distinct_versions(i: Inputs):
    """Versions of each product."""
    return DM.distinct_values(i.launch, "version")


@query("distinct_regions", "SELECT DISTINCT country, region FROM launch")
def distinct_regions(i: Inputs):
    """Regions per country."""
    return DM.distinct_values(i.launch, "region", ["country"])


# ---------------------------------------------------------------------------
# L1/L2: fact builds from ingested rows
# ---------------------------------------------------------------------------

@query("launch_fact_build", f"""
WITH r AS ({LAUNCH_SQL})
SELECT r.launch_id, r.product_id, r.channel_id, r.version, r.device_id, CAST(r.ts AS DATE) AS d,
  CAST(hour(r.ts) AS INTEGER) AS h, c.channel_active = 1 AND c.product_active = 1 AS active
FROM r JOIN channels c ON c.product_id = r.product_id AND c.channel_id = r.channel_id""")
def launch_fact_build(i: Inputs):
    """L1: launch fact from ingested rows joined to the product dimension."""
    rows, _ = launch_rows(i)
    dim = DM.sync_product_dim(i.channels, i.products, rows)
    fact, _rej = FA.build_launch_fact(rows, dim)
    return fact.select("launch_id", "product_id", "channel_id", "version", "device_id", "d", "h", "active")


@query("page_fact_build", f"""
SELECT e.event_id AS view_id, {PRODUCT} AS product_id, {CHANNEL} AS channel_id, {VERSION} AS version,
  e.event_type AS activity, CAST({REPAIRED} AS DATE) AS d, CAST(round(e.value * 1000) AS BIGINT) AS duration_ms,
  {CHANNEL} <> 4 AS active
FROM events e WHERE {F97} NOT IN (0, 1)""")
def page_fact_build(i: Inputs):
    """L2: page-view fact from ingested rows (dimension from the launches)."""
    rows, _ = IN.ingest_page(PL.page_payloads(i.spark, i.sf_dir), i.channels)
    dim = DM.sync_product_dim(i.channels, i.products, launch_rows(i)[0])
    fact, _rej = FA.build_page_fact(rows, dim)
    return fact.select("view_id", "product_id", "channel_id", "version", "activity", "d", "duration_ms", "active")


@query("crash_fact_build", f"""
SELECT e.event_id AS crash_id, {PRODUCT} AS product_id, {CHANNEL} AS channel_id, {VERSION} AS version,
  'd' || CAST(e.user_id AS VARCHAR) AS device_id, CAST({REPAIRED} AS DATE) AS d,
  CASE WHEN {VERSION} = '1.2' THEN 'rejected' WHEN {CHANNEL} <> 4 THEN 'active' ELSE 'inactive' END AS state
FROM events e WHERE e.event_type = 'error' AND {F97} NOT IN (0, 1)""")
def crash_fact_build(i: Inputs):
    """L3: crash fact from ingested rows; rows whose version the dimension
    doesn't know come out as rejects."""
    rows, _ = IN.ingest_crash(PL.crash_payloads(i.spark, i.sf_dir), i.channels)
    return _fact_states(FA.tag_day_rows(rows, _known_versions(i)), "crash_id", "device_id")


@query("event_fact_build", f"""
SELECT e.event_id AS row_id, {PRODUCT} AS product_id, {CHANNEL} AS channel_id, {VERSION} AS version,
  CAST(1 + e.event_id % 3 AS DOUBLE) AS num, CAST({REPAIRED} AS DATE) AS d,
  CASE WHEN {VERSION} = '1.2' THEN 'rejected' WHEN {CHANNEL} <> 4 THEN 'active' ELSE 'inactive' END AS state
FROM events e WHERE {F97} NOT IN (0, 1, 2, 5, 8) AND e.event_type <> 'error'""")
def event_fact_build(i: Inputs):
    """L4: custom-event fact from ingested rows, with rejects as for L3."""
    return _fact_states(FA.tag_day_rows(event_rows(i)[0], _known_versions(i)), "row_id", "num")


def _known_versions(i: Inputs):
    """A product dimension that has not seen version 1.2 yet."""
    return DM.sync_product_dim(i.channels, i.products, launch_rows(i)[0].where("version <> '1.2'"))


def _fact_states(tagged, *cols: str):
    state = F.when(~F.col("known"), "rejected").when(F.col("active"), "active").otherwise("inactive")
    return tagged.select(cols[0], "product_id", "channel_id", "version", *cols[1:], "d", state.alias("state"))


EVENT_DIM = [(1, 1, "signup", "Old name", 1), (1, 2, "view", "View", 1), (1, 9, "gone", "Gone", 1)]  # fixed values: an earlier dimension


@query("event_dim_sync", """
SELECT product_id, event_id, event_identifier, CASE WHEN event_id = 2 THEN NULL ELSE event_name END AS event_name, active FROM event_defs
UNION ALL SELECT 1, 9, 'gone', 'Gone', 1""")
def event_dim_sync(i: Inputs):
    """Refresh of the event dimension; a name set to NULL is taken
    over, new definitions come in and a dropped one stays."""
    dim = R.local_table(i.spark, EVENT_DIM, "product_id int, event_id int, event_identifier string, event_name string, active int")
    defs = i.event_defs.withColumn("event_name", F.when(F.col("event_id") != 2, F.col("event_name")))
    return DM.sync_event_dim(dim, defs)


# ---------------------------------------------------------------------------
# Idempotent upsert of a summary after late data
# ---------------------------------------------------------------------------

UPSERT_CUT = "2024-01-20"


@query("kpi_upsert", kpi_oracle("product"))
def kpi_upsert(i: Inputs):
    """The daily summary computed from rows ingested before the
    cut, upserted with a recompute of every day touched by later arrivals;
    equal to a full recompute."""
    cut = F.lit(UPSERT_CUT).cast("timestamp_ntz")
    before = i.launch.where(F.col("ingest_ts") < cut)
    existing = K.daily_kpis(before, i.page, i.active, "product")
    first_affected = i.launch.where(F.col("ingest_ts") >= cut).select(F.min("d")).scalar()
    recomputed = i.kpis("product").where(F.col("d") >= first_affected)
    return IN.upsert(existing, recomputed, ["product_id", "d"])


# ---------------------------------------------------------------------------
# Location from IP by range join (ranges and IPs both from the tables)
# ---------------------------------------------------------------------------

@query("ip_location", """
WITH l AS (SELECT e.event_id AS launch_id, e.user_id % 25 AS nk, e.user_id % 256 AS b3, e.event_id % 256 AS b4,
  e.event_id % 41 AS kind FROM events e)
SELECT l.launch_id,
  CASE WHEN bad THEN '' ELSE r.r_name END AS country, CASE WHEN bad THEN '' ELSE n.n_name END AS region,
  CASE WHEN bad THEN '' WHEN b3 BETWEEN 3 AND 5 AND b4 < 128 THEN 'centre' WHEN b3 < 64 THEN 'south' ELSE '' END AS city
FROM (SELECT *, nk = 24 OR kind < 4 AS bad FROM l) l
JOIN nation n ON n.n_nationkey = l.nk JOIN region r ON r.r_regionkey = n.n_regionkey""")
def ip_location(i: Inputs):
    """(country, region, city) of every launch from its IP via the
    IP-range table.  Each nation but the last owns the block
    10.<nation>.0.0/16, with a narrower range in it and narrower ones in that;
    a device's address lies in its nation's block.  Some are malformed."""
    e = i.spark.read.parquet(f"{i.sf_dir}/events.parquet")
    part = lambda c, n: (F.col(c) % n).cast("string")
    whole = F.concat_ws(".", F.lit("10"), part("user_id", 25), part("user_id", 256), part("event_id", 256))
    kind = F.col("event_id") % 41
    ips = e.select(F.col("event_id").alias("launch_id"),
                   F.when(kind == 0, F.lit("::1")).when(kind == 1, F.concat(whole, F.lit(".7")))
                    .when(kind == 2, F.lit("10.0.300.1")).when(kind == 3, F.lit(None).cast("string")).otherwise(whole).alias("ip"))
    nation = i.spark.read.parquet(f"{i.sf_dir}/nation.parquet")
    region = i.spark.read.parquet(f"{i.sf_dir}/region.parquet")
    lo = IN.ip_to_long(F.concat_ws(".", F.lit("10"), F.col("n_nationkey").cast("string"), F.lit("0"), F.lit("0")))
    own = nation.where("n_nationkey <> 24").join(region, nation.n_regionkey == region.r_regionkey)
    # (from, to, city) inside a block: the whole, its lower quarter, and parts of three /24s
    spans = [(0, 65535, ""), (0, 64 * 256 - 1, "south"), *[(k * 256, k * 256 + 127, "centre") for k in (3, 4, 5)]]
    ranges = own.select(lo.alias("base"), F.col("r_name").alias("country"), F.col("n_name").alias("region"),
                        F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("city")) for a, b, c in spans])).alias("s")) \
        .select((F.col("base") + F.col("s.a")).alias("lo"), (F.col("base") + F.col("s.b")).alias("hi"), "country", "region", "s.city")
    return IN.enrich_location(ips, ranges).select("launch_id", "country", "region", "city")
