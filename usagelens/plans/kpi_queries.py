"""Calendar, new-user flags, daily/hourly KPIs and the KPI series reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from usagelens.functions.calendar import calendar_from_span, date_span
from usagelens.functions.densify import densify
from usagelens.operators import first_index as FI
from usagelens.operators import kpis as K
from usagelens.plans.catalog import Inputs, query
from usagelens.sources import registry as R
from usagelens.streaming.jobs import work_dir

# ---------------------------------------------------------------------------
# oracle fragments (DuckDB), reference form
# ---------------------------------------------------------------------------

# The summary's metric names (sessions, startusers, newusers,
# upgradeusers, allusers, allsessions, usingtime) and what makes a launch new or
# an upgrade must be the reference's for right results.
FLAGGED = """
fl AS (
  SELECT l.*,
    CASE WHEN EXISTS (SELECT 1 FROM launch b WHERE b.product_id = l.product_id
         AND b.device_id = l.device_id AND (b.d < l.d OR (b.d = l.d AND b.launch_id < l.launch_id)))
         THEN 0 ELSE 1 END AS isnew,
    CASE WHEN EXISTS (SELECT 1 FROM launch b WHERE b.product_id = l.product_id
         AND b.channel_id = l.channel_id AND b.device_id = l.device_id
         AND (b.d < l.d OR (b.d = l.d AND b.launch_id < l.launch_id)))
         THEN 0 ELSE 1 END AS isnew_channel
  FROM launch l),
fa AS (SELECT fl.* FROM fl JOIN active_channels a
       ON a.product_id = fl.product_id AND a.channel_id = fl.channel_id)"""


def kpi_oracle_ctes(grain: str) -> str:
    keys = {"product": ["product_id"], "channel": ["product_id", "channel_id"],
            "version": ["product_id", "version"]}[grain]
    k = ", ".join(keys)
    newcol = "isnew_channel" if grain == "channel" else "isnew"
    scope_eq = " AND x.channel_id = t.channel_id" if grain == "channel" else ""
    tk = ", ".join(f"t.{c}" for c in keys)
    corr = " AND ".join(f"x.{c} = kp.{c}" for c in keys)
    return f"""{FLAGGED},
kk AS (SELECT DISTINCT {k}, d FROM launch UNION SELECT DISTINCT {k}, d FROM page),
s AS (SELECT {k}, d, count(device_id) AS sessions, count(DISTINCT device_id) AS startusers
      FROM launch GROUP BY {k}, d),
n AS (SELECT {k}, d, sum({newcol}) AS newusers FROM fa GROUP BY {k}, d),
u AS (SELECT {tk}, t.d, count(DISTINCT t.device_id) AS upgradeusers FROM fa t
      WHERE EXISTS (SELECT 1 FROM fa x WHERE x.product_id = t.product_id{scope_eq}
                    AND x.device_id = t.device_id AND x.d < t.d AND x.version < t.version)
      GROUP BY {tk}, t.d),
ut AS (SELECT {k}, d, sum(duration_ms) AS usingtime FROM page GROUP BY {k}, d),
kp0 AS (SELECT kk.*, CAST(coalesce(s.sessions, 0) AS BIGINT) AS sessions,
          CAST(coalesce(s.startusers, 0) AS BIGINT) AS startusers,
          CAST(coalesce(n.newusers, 0) AS BIGINT) AS newusers,
          CAST(coalesce(u.upgradeusers, 0) AS BIGINT) AS upgradeusers,
          CAST(coalesce(ut.usingtime, 0) AS BIGINT) AS usingtime
        FROM kk LEFT JOIN s USING ({k}, d) LEFT JOIN n USING ({k}, d)
        LEFT JOIN u USING ({k}, d) LEFT JOIN ut USING ({k}, d)),
kp AS (SELECT kp.*,
  CAST((SELECT sum(x.newusers) FROM kp0 x WHERE {corr} AND x.d <= kp.d) AS BIGINT) AS allusers,
  CAST((SELECT sum(x.sessions) FROM kp0 x WHERE {corr} AND x.d <= kp.d) AS BIGINT) AS allsessions
  FROM kp0 kp)"""


def kpi_oracle(grain: str) -> str:
    keys = {"product": "product_id", "channel": "product_id, channel_id",
            "version": "product_id, version"}[grain]
    return (f"WITH {kpi_oracle_ctes(grain)}\nSELECT {keys}, d, sessions, startusers, newusers, "
            "upgradeusers, allusers, allsessions, usingtime FROM kp")


# ---------------------------------------------------------------------------
# D14 calendar
# ---------------------------------------------------------------------------

@query("calendar_span", """
SELECT CAST(g.d AS DATE) AS d, CAST(year(g.d) AS INTEGER) AS year,
  CAST(quarter(g.d) AS INTEGER) AS quarter, CAST(month(g.d) AS INTEGER) AS month,
  CAST(strftime(g.d, '%U') AS INTEGER) AS week, CAST(dayofweek(g.d) AS INTEGER) AS dayofweek,
  CAST(day(g.d) AS INTEGER) AS day
FROM (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM launch_long) g""")
def calendar_span(i: Inputs):
    """Calendar over the whole span of the long launch history."""
    return calendar_from_span(date_span(i.launch_long))


# ---------------------------------------------------------------------------
# L5/L6 new-user flags
# ---------------------------------------------------------------------------

@query("flag_new", f"""
WITH {FLAGGED.strip().rstrip(',')}
SELECT launch_id, product_id, channel_id, device_id, d, isnew AS is_new,
  isnew_channel AS is_new_channel FROM fl""")
def flag_new(i: Inputs):
    """First-launch flags per product and per product+channel."""
    f = K.flag_new(i.launch, ["product_id"], "is_new")
    f = K.flag_new(f, ["product_id", "channel_id"], "is_new_channel")
    return f.select("launch_id", "product_id", "channel_id", "device_id", "d", "is_new", "is_new_channel")


# ---------------------------------------------------------------------------
# K1-K8 daily KPIs at three grains, K4 hourly
# ---------------------------------------------------------------------------

@query("kpi_daily_product", kpi_oracle("product"))
def kpi_daily_product(i: Inputs):
    """K1-K3, K5-K8 per product and day."""
    return i.kpis("product")


@query("kpi_daily_channel", kpi_oracle("channel"))
def kpi_daily_channel(i: Inputs):
    """K1-K3, K5-K8 per product, channel and day (new = first in channel)."""
    return i.kpis("channel")


@query("kpi_daily_version", kpi_oracle("version"))
def kpi_daily_version(i: Inputs):
    """K1-K3, K5-K8 per product, version and day."""
    return i.kpis("version")


@query("kpi_hourly", """
WITH fa AS (SELECT l.* FROM launch l JOIN active_channels a
            ON a.product_id = l.product_id AND a.channel_id = l.channel_id),
s AS (SELECT product_id, channel_id, version, d, h, count(device_id) AS sessions,
        count(DISTINCT device_id) AS startusers FROM launch GROUP BY ALL),
n AS (SELECT f.product_id, f.channel_id, f.version, f.d, f.h, count(DISTINCT f.device_id) AS newusers
      FROM fa f WHERE NOT EXISTS (SELECT 1 FROM fa x WHERE x.product_id = f.product_id
                                  AND x.device_id = f.device_id AND x.d < f.d)
      GROUP BY ALL)
SELECT s.product_id, s.channel_id, s.version, s.d, s.h, CAST(s.sessions AS BIGINT) AS sessions,
  CAST(s.startusers AS BIGINT) AS startusers, CAST(coalesce(n.newusers, 0) AS BIGINT) AS newusers
FROM s LEFT JOIN n USING (product_id, channel_id, version, d, h)""")
def kpi_hourly(i: Inputs):
    """K1, K2, K4 per product entry, day and hour."""
    return K.hourly_kpis(i.launch, i.active, rollup=i.rollup)


@query("session_daily", """
SELECT product_id, channel_id, version, d, session_id, CAST(sum(duration_ms) AS BIGINT) AS duration_ms
FROM page GROUP BY ALL""")
def session_daily(i: Inputs):
    """Session totals per day."""
    return K.session_daily(i.page)


@query("usage_bucketize", """
SELECT s.product_id, s.d, s.session_id, s.duration_ms, b.bucket_id, b.bucket
FROM (SELECT product_id, d, session_id, CAST(sum(duration_ms) AS BIGINT) AS duration_ms
      FROM page GROUP BY ALL) s
JOIN usage_buckets b ON s.duration_ms >= b.lo AND (b.hi IS NULL OR s.duration_ms < b.hi)""")
def usage_bucketize(i: Inputs):
    """Usage bucket ([lo, hi) in ms) of every daily session total."""
    from usagelens.functions.buckets import bucketize
    sd = i.page.groupBy("product_id", "d", "session_id").agg(F.sum("duration_ms").alias("duration_ms"))
    return bucketize(sd, "duration_ms", R.USAGE_BUCKETS, closed="left")


@query("launch_histogram", """
WITH t AS (SELECT product_id, channel_id, version, d, device_id, count(*) AS times
           FROM launch GROUP BY ALL),
c AS (SELECT t.product_id, t.channel_id, t.version, t.d, b.bucket_id, count(*) AS devices
      FROM t JOIN launch_buckets b ON t.times BETWEEN b.lo AND coalesce(b.hi, 9223372036854775807)
      GROUP BY ALL),
g AS (SELECT DISTINCT t.product_id, t.channel_id, t.version, t.d, b.bucket_id, b.bucket
      FROM t CROSS JOIN launch_buckets b)
SELECT g.product_id, g.channel_id, g.version, g.d, g.bucket_id, g.bucket,
  CAST(coalesce(c.devices, 0) AS BIGINT) AS devices
FROM g LEFT JOIN c USING (product_id, channel_id, version, d, bucket_id)""")
def launch_histogram(i: Inputs):
    """Launch-count histogram per product entry and day, zero filled."""
    return K.launch_histogram(i.launch, R.LAUNCH_BUCKETS, rollup=i.rollup)


# ---------------------------------------------------------------------------
# R1/R2 dense KPI series with as-of totals
# ---------------------------------------------------------------------------

@query("kpi_series", f"""
WITH {kpi_oracle_ctes("product")},
grid AS (SELECT p.product_id, CAST(g.d AS DATE) AS d
         FROM (SELECT DISTINCT product_id FROM kp) p,
              (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM kp) g)
SELECT g.product_id, g.d,
  CAST(coalesce(k.sessions, 0) AS BIGINT) AS sessions,
  CAST(coalesce(k.startusers, 0) AS BIGINT) AS startusers,
  CAST(coalesce(k.newusers, 0) AS BIGINT) AS newusers,
  CAST(coalesce(k.upgradeusers, 0) AS BIGINT) AS upgradeusers,
  CAST(coalesce(k.usingtime, 0) AS BIGINT) AS usingtime,
  CAST(coalesce((SELECT max(x.allusers) FROM kp x WHERE x.product_id = g.product_id
                 AND x.d <= g.d), 0) AS BIGINT) AS allusers,
  CAST(coalesce((SELECT max(x.allsessions) FROM kp x WHERE x.product_id = g.product_id
                 AND x.d <= g.d), 0) AS BIGINT) AS allsessions
FROM grid g LEFT JOIN kp k USING (product_id, d)""")
def kpi_series(i: Inputs):
    """Dense daily KPI series per product over the whole data span;
    cumulative users/sessions read as-of each day."""
    kp = i.kpis("product")
    return densify(kp, ["product_id"],
                   ["sessions", "startusers", "newusers", "upgradeusers", "usingtime"],
                   ["allusers", "allsessions"], key_rows=i.kpi_keys("product_id"), span_src=i.kpi_days)


# ---------------------------------------------------------------------------
# Flags after late arrival, from the kept first-launch index
# ---------------------------------------------------------------------------

def _reflag_sql(scope: str) -> str:
    same = " AND ".join(f"p.{c} = l.{c}" for c in [*scope.split(", "), "device_id"])
    return f"""SELECT l.launch_id, l.product_id, l.channel_id, l.device_id, l.d, CASE WHEN EXISTS (
  SELECT 1 FROM launch p WHERE {same} AND (p.d < l.d OR (p.d = l.d AND p.launch_id < l.launch_id))) THEN 0 ELSE 1 END AS is_new
FROM launch l"""


def _reflag(i: Inputs, scope: list[str]):
    """The rows on time are flagged and indexed; those three and ten days late then come as two batches."""
    wd = work_dir(i.spark, "reflag")
    rows = i.launch.select("launch_id", "product_id", "channel_id", "device_id", "d")
    index = FI.FirstLaunchIndex(i.spark, f"{wd}/index", scope, ["channel_id"], n_buckets=16)
    came = F.when(F.col("launch_id") % 50 == 0, 1).when(F.col("launch_id") % 50 == 7, 2).otherwise(0)
    on_time = rows.where(came == 0)
    index.update(on_time, 0)
    K.flag_new(on_time, scope).write.partitionBy("d").parquet(f"{wd}/fact")
    for epoch in (1, 2):
        FI.take_late_rows(index, f"{wd}/fact", rows.where(came == epoch), epoch)
    return i.spark.read.parquet(f"{wd}/fact").select("launch_id", "product_id", "channel_id", "device_id", "d", "is_new")


@query("reflag_late_product", _reflag_sql("product_id"))
def reflag_late_product(i: Inputs):
    """New-user flags after late rows, per product; equal to a full recompute."""
    return _reflag(i, ["product_id"])


@query("reflag_late_channel", _reflag_sql("product_id, channel_id"))
def reflag_late_channel(i: Inputs):
    """The same within product and channel."""
    return _reflag(i, ["product_id", "channel_id"])


@query("reflag_newuser_counts", """
SELECT product_id, channel_id, d, CAST(count(*) AS BIGINT) AS newusers FROM launch l WHERE NOT EXISTS (
  SELECT 1 FROM launch p WHERE p.product_id = l.product_id AND p.device_id = l.device_id
  AND (p.d < l.d OR (p.d = l.d AND p.launch_id < l.launch_id))) GROUP BY ALL""")
def reflag_newuser_counts(i: Inputs):
    """Daily new users per entry kept by the corrections' deltas alone."""
    index = FI.FirstLaunchIndex(i.spark, work_dir(i.spark, "reflag"), ["product_id"], ["channel_id"], n_buckets=16)
    rows = i.launch.select("launch_id", "product_id", "channel_id", "device_id", "d")
    for epoch, part in enumerate((rows.where("launch_id % 3 = 0"), rows.where("launch_id % 3 > 0"))):
        index.update(part, epoch)
    return FI.new_user_deltas(index.corrections(), ["product_id", "channel_id"])
