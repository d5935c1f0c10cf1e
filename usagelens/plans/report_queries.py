"""KPI report queries (R*), trend/alerts/markers/segments (A*) and
real-time counts (T*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from usagelens.operators import kpis as K
from usagelens.operators import realtime as RT
from usagelens.operators import reports as RP
from usagelens.operators import trend as TR
from usagelens.plans.catalog import Inputs, query
from usagelens.plans.kpi_queries import kpi_oracle_ctes
from usagelens.sources import registry as R

SPAN_KP = "(SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM kp)"
MET = ["sessions", "startusers", "newusers", "upgradeusers", "usingtime"]


def dense_sql(grain: str, key_rows: str | None = None) -> str:
    """CTE ``dk``: dense (keys x day) KPI grid with as-of totals."""
    keys = {"product": ["product_id"], "channel": ["product_id", "channel_id"],
            "version": ["product_id", "version"]}[grain]
    kc = ", ".join(keys)
    kr = key_rows or f"(SELECT DISTINCT {kc} FROM kp)"
    corr = " AND ".join(f"x.{c} = g.{c}" for c in keys)
    zero = ", ".join(f"CAST(coalesce(k.{m}, 0) AS BIGINT) AS {m}" for m in MET)
    asof = ", ".join(f"CAST(coalesce((SELECT max(x.{m}) FROM kp x WHERE {corr} AND x.d <= g.d), 0) "
                     f"AS BIGINT) AS {m}" for m in ("allusers", "allsessions"))
    return f"""{kpi_oracle_ctes(grain)},
grid AS (SELECT kr.*, CAST(s.d AS DATE) AS d FROM {kr} kr, {SPAN_KP} s),
dk AS (SELECT {', '.join('g.' + c for c in keys)}, g.d, {zero}, {asof}
       FROM grid g LEFT JOIN kp k USING ({kc}, d))"""


def kp(i: Inputs, grain: str = "product"):
    return i.kpis(grain)


PCT1 = "CASE WHEN {den} > 0 THEN floor(CAST({num} * 2000 + {den} AS DOUBLE) / CAST(2 * {den} AS DOUBLE)) / 10 END"


@query("kpi_detail", f"""WITH {dense_sql("product")}
SELECT dk.*, coalesce({PCT1.format(num="newusers", den="startusers")}, 0.0) AS new_pct,
  coalesce(usingtime / nullif(sessions * 1000, 0), 0.0) AS avg_session_s FROM dk""")
def kpi_detail(i: Inputs):
    """Dense KPI series with derived ratios, newest first."""
    return RP.kpi_detail(kp(i), span_src=i.kpi_days, key_rows=i.kpi_keys("product_id"))


@query("owner_series", f"""WITH {dense_sql("product")}
SELECT p.owner_id, dk.d, CAST(sum(newusers) AS BIGINT) AS newusers, CAST(sum(startusers) AS BIGINT) AS startusers,
  CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(usingtime) AS BIGINT) AS usingtime,
  CAST(sum(allusers) AS BIGINT) AS allusers
FROM dk JOIN products p USING (product_id) GROUP BY p.owner_id, dk.d""")
def owner_series(i: Inputs):
    """KPI trend over all apps of each owner."""
    return RP.owner_series(kp(i), i.products, span_src=i.kpi_days, key_rows=i.kpi_keys("product_id"))


def _snap_sql(grain: str, key_rows: str | None = None) -> str:
    keys = {"product": ["product_id"], "channel": ["product_id", "channel_id"],
            "version": ["product_id", "version"]}[grain]
    kc = ", ".join(keys)
    kr = key_rows or f"(SELECT DISTINCT {kc} FROM kp)"
    zero = ", ".join(f"CAST(coalesce(t.{m}, 0) AS BIGINT) AS {m}" for m in MET)
    return f"""WITH {kpi_oracle_ctes(grain)},
day AS (SELECT max(d) AS d FROM kp),
t AS (SELECT kp.* FROM kp, day WHERE kp.d = day.d),
a AS (SELECT {kc}, max(allusers) AS allusers FROM kp, day WHERE kp.d <= day.d GROUP BY {kc})
SELECT {', '.join('kr.' + c for c in keys)}, (SELECT d FROM day) AS d, {zero},
  CAST(coalesce(a.allusers, 0) AS BIGINT) AS allusers
FROM {kr} kr LEFT JOIN t USING ({kc}) LEFT JOIN a USING ({kc})"""


@query("kpi_snapshot", _snap_sql("product"))
def kpi_snapshot(i: Inputs):
    """Last-day snapshot per product with as-of total users."""
    return RP.snapshot(kp(i), ["product_id"], i.kpi_keys("product_id"), day=RP.last_day(i.kpi_days))


@query("channel_snapshot", _snap_sql("channel", "(SELECT product_id, channel_id FROM active_channels)"))
def channel_snapshot(i: Inputs):
    """Last-day snapshot per active channel."""
    return RP.snapshot(kp(i, "channel"), ["product_id", "channel_id"],
                       i.active, day=RP.last_day(i.kpi_days))


@query("version_snapshot", _snap_sql("version"))
def version_snapshot(i: Inputs):
    """Last-day snapshot per version."""
    return RP.snapshot(kp(i, "version"), ["product_id", "version"], i.kpi_keys("product_id", "version"), day=RP.last_day(i.kpi_days))


@query("channel_series", f"""WITH {dense_sql("channel", "(SELECT product_id, channel_id FROM active_channels)")}
SELECT * FROM dk""")
def channel_series(i: Inputs):
    """Dense date x active-channel KPI grid with as-of users."""
    return RP.channel_series(kp(i, "channel"), i.active, span_src=i.kpi_days)


@query("version_series", f"""WITH {dense_sql("version")}
SELECT product_id, version, d, startusers, newusers FROM dk""")
def version_series(i: Inputs):
    """Dense date x version grid of active and new devices."""
    return RP.version_series(kp(i, "version"), span_src=i.kpi_days, key_rows=i.kpi_keys("product_id", "version"))


@query("channel_active_sum", f"""WITH {kpi_oracle_ctes("channel")},
cs AS (SELECT product_id, channel_id, sum(startusers) AS n FROM kp GROUP BY ALL)
SELECT c.product_id, c.channel_id, c.channel_name, CAST(coalesce(cs.n, 0) AS BIGINT) AS active_sum
FROM channels c LEFT JOIN cs USING (product_id, channel_id) WHERE c.product_active = 1 AND c.channel_active = 1""")
def channel_active_sum(i: Inputs):
    """Sum of daily actives per active channel (zero filled)."""
    return RP.channel_active_sum(kp(i, "channel"), i.channels.where("product_active = 1 AND channel_active = 1"))


def _rolling_sql(days: int) -> str:
    return f"""WITH {dense_sql("channel", "(SELECT product_id, channel_id FROM active_channels)")}
SELECT g.product_id, g.channel_id, g.d,
  CAST((SELECT sum(x.startusers) FROM dk x WHERE x.product_id = g.product_id AND x.channel_id = g.channel_id
        AND x.d BETWEEN g.d - {days - 1} AND g.d) AS BIGINT) AS active_{days}d, g.allusers
FROM dk g"""


@query("rolling_actives_7d", _rolling_sql(7))
def rolling_actives_7d(i: Inputs):
    """Trailing 7-day sum of daily actives per channel."""
    return RP.rolling_actives(kp(i, "channel"), i.active, 7, span_src=i.kpi_days)


@query("rolling_actives_31d", _rolling_sql(31))
def rolling_actives_31d(i: Inputs):
    """Trailing 31-day sum of daily actives per channel."""
    return RP.rolling_actives(kp(i, "channel"), i.active, 31, span_src=i.kpi_days)


@query("portfolio", f"""WITH {kpi_oracle_ctes("product")},
day AS (SELECT max(d) AS d FROM kp),
t AS (SELECT kp.product_id,
  sum(CASE WHEN kp.d = day.d THEN newusers END) AS newusers_today,
  sum(CASE WHEN kp.d = day.d THEN sessions END) AS sessions_today,
  sum(CASE WHEN kp.d = day.d THEN startusers END) AS startusers_today,
  sum(CASE WHEN kp.d = day.d - 1 THEN newusers END) AS newusers_yesterday,
  sum(CASE WHEN kp.d = day.d - 1 THEN sessions END) AS sessions_yesterday,
  sum(CASE WHEN kp.d = day.d - 1 THEN startusers END) AS startusers_yesterday,
  max(allusers) AS allusers
  FROM kp, day WHERE kp.d <= day.d GROUP BY kp.product_id)
SELECT p.product_id, p.product_name, p.platform,
  CAST(coalesce(newusers_today, 0) AS BIGINT) AS newusers_today,
  CAST(coalesce(sessions_today, 0) AS BIGINT) AS sessions_today,
  CAST(coalesce(startusers_today, 0) AS BIGINT) AS startusers_today,
  CAST(coalesce(newusers_yesterday, 0) AS BIGINT) AS newusers_yesterday,
  CAST(coalesce(sessions_yesterday, 0) AS BIGINT) AS sessions_yesterday,
  CAST(coalesce(startusers_yesterday, 0) AS BIGINT) AS startusers_yesterday,
  CAST(coalesce(allusers, 0) AS BIGINT) AS allusers
FROM products p LEFT JOIN t USING (product_id)""")
def portfolio(i: Inputs):
    """Every app with today/yesterday new, launches, actives, total."""
    return RP.portfolio(kp(i), i.products, day=RP.last_day(i.kpi_days))


HOURLY_SQL = """fa AS (SELECT l.* FROM launch l JOIN active_channels a
            ON a.product_id = l.product_id AND a.channel_id = l.channel_id),
s AS (SELECT product_id, channel_id, version, d, h, count(device_id) AS sessions,
        count(DISTINCT device_id) AS startusers FROM launch GROUP BY ALL),
n AS (SELECT f.product_id, f.channel_id, f.version, f.d, f.h, count(DISTINCT f.device_id) AS newusers
      FROM fa f WHERE NOT EXISTS (SELECT 1 FROM fa x WHERE x.product_id = f.product_id
                                  AND x.device_id = f.device_id AND x.d < f.d) GROUP BY ALL),
hk AS (SELECT s.*, coalesce(n.newusers, 0) AS newusers FROM s LEFT JOIN n
       USING (product_id, channel_id, version, d, h))"""


def _hour_sql(by: str) -> str:
    return f"""WITH {HOURLY_SQL},
x AS (SELECT {by}, h, sum(startusers) AS startusers, sum(newusers) AS newusers, sum(sessions) AS sessions
      FROM hk GROUP BY ALL),
g AS (SELECT k.*, CAST(r.h AS INTEGER) AS h FROM (SELECT DISTINCT {by} FROM hk) k, range(24) r(h))
SELECT g.*, CAST(coalesce(x.startusers, 0) AS BIGINT) AS startusers,
  CAST(coalesce(x.newusers, 0) AS BIGINT) AS newusers, CAST(coalesce(x.sessions, 0) AS BIGINT) AS sessions
FROM g LEFT JOIN x USING ({by}, h)"""


@query("hour_profile", _hour_sql("product_id"))
def hour_profile(i: Inputs):
    """24-hour profile per product (zero filled)."""
    return RP.hour_profile(K.hourly_kpis(i.launch, i.active, rollup=i.rollup), ["product_id"])


@query("hour_profile_channel", _hour_sql("product_id, channel_id"))
def hour_profile_channel(i: Inputs):
    """24-hour profile per channel."""
    return RP.hour_profile(K.hourly_kpis(i.launch, i.active, rollup=i.rollup), ["product_id", "channel_id"])


R1_RANGE = ("2024-01-01", "2024-01-15")
R2_RANGE = ("2024-01-16", "2024-01-31")


def _contrast_sql() -> str:
    parts = []
    for tag, (a, b) in (("r1", R1_RANGE), ("r2", R2_RANGE)):
        parts.append(f"""SELECT product_id, '{tag}' AS range_id, version, CAST(active AS BIGINT) AS active,
  CAST(new AS BIGINT) AS new, active / sum(active) OVER (PARTITION BY product_id) AS active_share,
  new / nullif(sum(new) OVER (PARTITION BY product_id), 0) AS new_share,
  CAST(row_number() OVER (PARTITION BY product_id ORDER BY active DESC, new DESC, version) AS INTEGER) AS rank
FROM (SELECT product_id, version, sum(startusers) AS active, sum(newusers) AS new FROM kp
      WHERE d BETWEEN DATE '{a}' AND DATE '{b}' GROUP BY ALL) QUALIFY rank <= 10""")
    return f"WITH {kpi_oracle_ctes('version')}\n" + "\nUNION ALL\n".join(f"({p})" for p in parts)


@query("version_contrast", _contrast_sql())
def version_contrast(i: Inputs):
    """Top-10 versions of two report ranges with shares."""
    return RP.version_contrast(kp(i, "version"), R1_RANGE, R2_RANGE, 10)


def _endpoint_sql(grain: str) -> str:
    keys = {"product": "product_id", "channel": "product_id, channel_id", "version": "product_id, version"}[grain]
    return f"""WITH {kpi_oracle_ctes(grain)},
b AS (SELECT min(d) AS lo, max(d) AS hi FROM kp)
SELECT {keys}, CASE WHEN d = b.lo THEN 'first' ELSE 'last' END AS endpoint, d, startusers, newusers, sessions
FROM kp, b WHERE d = b.lo OR d = b.hi"""


@query("endpoint_values_channel", _endpoint_sql("channel"))
def endpoint_values_channel(i: Inputs):
    """First- and last-day values per channel."""
    return RP.endpoint_values(kp(i, "channel"), ["product_id", "channel_id"], span_src=i.kpi_days)


@query("endpoint_values_version", _endpoint_sql("version"))
def endpoint_values_version(i: Inputs):
    """First- and last-day values per version."""
    return RP.endpoint_values(kp(i, "version"), ["product_id", "version"], span_src=i.kpi_days)


@query("endpoint_values_product", _endpoint_sql("product"))
def endpoint_values_product(i: Inputs):
    """First- and last-day values per product (both ends)."""
    return RP.endpoint_values(kp(i), ["product_id"], span_src=i.kpi_days)


@query("product_list", """
WITH s AS (SELECT product_id, min(d) AS first_day, max(d) AS last_day, count(*) AS launches FROM launch GROUP BY ALL)
SELECT p.owner_id, p.product_id, p.product_name, p.platform, s.first_day, s.last_day,
  CAST(coalesce(s.launches, 0) AS BIGINT) AS launches
FROM products p LEFT JOIN s USING (product_id)""")
def product_list(i: Inputs):
    """owners' apps with platform, first/last day seen and launches."""
    return RP.product_list(i.launch, i.products)


@query("active_sum_to", f"""WITH {kpi_oracle_ctes("product")}
SELECT product_id, d, CAST((SELECT sum(x.startusers) FROM kp x WHERE x.product_id = kp.product_id
  AND x.d <= kp.d) AS BIGINT) AS active_sum FROM kp""")
def active_sum_to(i: Inputs):
    """Cumulative sum of daily actives."""
    return RP.active_sum_to(kp(i))


@query("active_devices_channel", """
SELECT product_id, channel_id, CAST(count(DISTINCT device_id) AS BIGINT) AS devices,
  CAST(count(*) AS BIGINT) AS launches FROM launch GROUP BY ALL""")
def active_devices_channel(i: Inputs):
    """Distinct devices (and launches) per channel over the range."""
    return RP.active_devices(i.launch, ["product_id", "channel_id"])


@query("all_time_product", """
SELECT product_id, CAST(count(DISTINCT device_id) AS BIGINT) AS devices,
  CAST(count(*) AS BIGINT) AS launches FROM launch_long GROUP BY ALL""")
def all_time_product(i: Inputs):
    """All-time devices and launches per product (long history)."""
    return RP.active_devices(i.launch_long, ["product_id"])


@query("day_counts", """
SELECT product_id, channel_id, d, CAST(count(*) AS BIGINT) AS launches,
  CAST(count(DISTINCT device_id) AS BIGINT) AS devices FROM launch GROUP BY ALL
UNION ALL
SELECT product_id, -1, d, CAST(count(*) AS BIGINT), CAST(count(DISTINCT device_id) AS BIGINT)
FROM launch GROUP BY product_id, d""")
def day_counts(i: Inputs):
    """Day values from the fact per channel and per product."""
    return RP.day_counts(i.launch)


@query("avg_session_daily", """
SELECT product_id, d, CAST(count(DISTINCT session_id) AS BIGINT) AS sessions,
  CAST(sum(duration_ms) AS BIGINT) AS duration_ms, sum(duration_ms) / count(DISTINCT session_id) AS avg_ms
FROM page GROUP BY ALL""")
def avg_session_daily(i: Inputs):
    """Average session time per product and day."""
    return RP.avg_session(i.page, ["product_id"], daily=True)


@query("avg_session_range", """
SELECT product_id, CAST(count(DISTINCT session_id) AS BIGINT) AS sessions,
  CAST(sum(duration_ms) AS BIGINT) AS duration_ms, sum(duration_ms) / count(DISTINCT session_id) AS avg_ms
FROM page GROUP BY ALL""")
def avg_session_range(i: Inputs):
    """Average session time per product over the range."""
    return RP.avg_session(i.page, ["product_id"], daily=False)


PIDS = [p[0] for p in R.PRODUCTS]


@query("compare_products", f"""WITH {dense_sql("product")}
SELECT d, {', '.join(f"CAST(coalesce(max(CASE WHEN product_id = {p} THEN startusers END), 0) AS BIGINT) AS p{p}" for p in PIDS)}
FROM dk GROUP BY d""")
def compare_products(i: Inputs):
    """Daily actives of all products side by side."""
    return RP.compare(kp(i), "startusers", PIDS, span_src=i.kpi_days, key_rows=i.kpi_keys("product_id"))


CW_METRICS = ["newusers", "startusers", "sessions"]


@query("compare_wide", f"""WITH {dense_sql("product")},
long AS ({' UNION ALL '.join(f"SELECT product_id, d, '{m}' AS metric, {m} AS value FROM dk" for m in CW_METRICS)})
SELECT metric, d, {', '.join(f"CAST(coalesce(max(CASE WHEN product_id = {p} THEN value END), 0) AS BIGINT) AS p{p}" for p in PIDS)}
FROM long GROUP BY metric, d""")
def compare_wide(i: Inputs):
    """Metric block x date x products (unpivot + pivot)."""
    return RP.compare_wide(kp(i), CW_METRICS, PIDS, span_src=i.kpi_days, key_rows=i.kpi_keys("product_id"))


@query("kpi_page", f"""WITH {dense_sql("product")}
SELECT * FROM dk ORDER BY product_id, d LIMIT 10 OFFSET 10""")
def kpi_page(i: Inputs):
    """Second page (10 rows) of the dense KPI series."""
    from usagelens.functions.densify import densify
    dense = densify(kp(i), ["product_id"], RP.KPI_METRICS, RP.ASOF, key_rows=i.kpi_keys("product_id"), span_src=i.kpi_days)
    return RP.page(dense, ["product_id", "d"], 1, 10)


@query("channel_allusers_ffill", f"""WITH {kpi_oracle_ctes("channel")},
grid AS (SELECT c.product_id, c.channel_id, CAST(s.d AS DATE) AS d FROM channels c, {SPAN_KP} s)
SELECT g.product_id, g.channel_id, g.d,
  CAST(coalesce((SELECT x.allusers FROM kp x WHERE x.product_id = g.product_id AND x.channel_id = g.channel_id
    AND x.d <= g.d ORDER BY x.d DESC LIMIT 1), 0) AS BIGINT) AS allusers
FROM grid g""")
def channel_allusers_ffill(i: Inputs):
    """Carry the last known cumulative users forward over gaps."""
    from usagelens.functions.densify import date_grid, ffill, span_bounds
    k = kp(i, "channel")
    lo, hi = span_bounds(i.kpi_days)
    grid = date_grid(i.channels.select("product_id", "channel_id"), lo, hi)
    g = grid.join(k.select("product_id", "channel_id", "d", "allusers"), ["product_id", "channel_id", "d"], "left")
    f = ffill(g, ["product_id", "channel_id"], "allusers")
    return f.select("product_id", "channel_id", "d", F.coalesce("allusers", F.lit(0)).cast("bigint").alias("allusers"))


def _cal_share_sql(kind: str) -> str:
    per = "CAST(strftime(d, '%U') AS INTEGER)" if kind == "week" else "CAST(month(d) AS INTEGER)"
    return f"""WITH fa AS (SELECT l.*, CAST(year(l.d) AS INTEGER) AS year, {per} AS {kind}
            FROM launch l JOIN active_channels a ON a.product_id = l.product_id AND a.channel_id = l.channel_id),
p AS (SELECT product_id, channel_id, year, {kind}, count(DISTINCT device_id) AS activeusers FROM fa GROUP BY ALL)
SELECT p.product_id, p.channel_id, p.year, p.{kind}, CAST(p.activeusers AS BIGINT) AS activeusers,
  CAST((SELECT count(DISTINCT y.device_id) FROM fa y WHERE y.product_id = p.product_id
        AND y.channel_id = p.channel_id AND y.year = p.year AND y.{kind} <= p.{kind}) AS BIGINT) AS year_users,
  p.activeusers / (SELECT count(DISTINCT y.device_id) FROM fa y WHERE y.product_id = p.product_id
        AND y.channel_id = p.channel_id AND y.year = p.year AND y.{kind} <= p.{kind}) AS share
FROM p"""


@query("calendar_active_share_week", _cal_share_sql("week"))
def calendar_active_share_week(i: Inputs):
    """Weekly active share of the year's users to date, per channel."""
    return RP.calendar_active_share(i.rollup, i.active, "week")


@query("calendar_active_share_month", _cal_share_sql("month"))
def calendar_active_share_month(i: Inputs):
    """Monthly active share of the year's users to date, per channel."""
    return RP.calendar_active_share(i.rollup, i.active, "month")


@query("channel_share_active", """
WITH den AS (SELECT product_id, channel_id, count(DISTINCT device_id) AS all_devices FROM launch GROUP BY ALL),
num AS (SELECT product_id, channel_id, count(DISTINCT device_id) AS devices FROM launch
        WHERE d BETWEEN DATE '2024-01-16' AND DATE '2024-01-31' GROUP BY ALL)
SELECT den.product_id, den.channel_id, CAST(coalesce(num.devices, 0) AS BIGINT) AS devices,
  CAST(den.all_devices AS BIGINT) AS all_devices, coalesce(num.devices, 0) / den.all_devices AS share
FROM den LEFT JOIN num USING (product_id, channel_id)""")
def channel_share_active(i: Inputs):
    """Per channel, devices active in the second half of the month over
    the channel's devices of all time."""
    return RP.channel_share(i.launch, *R2_RANGE)


@query("channel_share_new", """
WITH den AS (SELECT product_id, channel_id, count(DISTINCT device_id) AS all_devices FROM launch GROUP BY ALL),
f AS (SELECT product_id, channel_id, device_id, min(d) AS d FROM launch GROUP BY ALL),
num AS (SELECT product_id, channel_id, count(*) AS devices FROM f
        WHERE d BETWEEN DATE '2024-01-16' AND DATE '2024-01-31' GROUP BY ALL)
SELECT den.product_id, den.channel_id, CAST(coalesce(num.devices, 0) AS BIGINT) AS devices,
  CAST(den.all_devices AS BIGINT) AS all_devices, coalesce(num.devices, 0) / den.all_devices AS share
FROM den LEFT JOIN num USING (product_id, channel_id)""")
def channel_share_new(i: Inputs):
    """Per channel, devices new in the second half over all-time devices."""
    return RP.channel_share(i.launch, *R2_RANGE, new_only=True)


@query("channel_vector", """
WITH day AS (SELECT max(d) AS d FROM launch),
dev AS (SELECT product_id, channel_id, device_id, min(d) AS first_d,
          max(CASE WHEN d = (SELECT d FROM day) THEN 1 END) AS seen FROM launch GROUP BY ALL)
SELECT product_id, channel_id,
  CAST(count(CASE WHEN first_d = (SELECT d FROM day) THEN 1 END) AS BIGINT) AS new_today,
  CAST(count(CASE WHEN first_d = (SELECT d FROM day) - 1 THEN 1 END) AS BIGINT) AS new_yesterday,
  CAST(count(seen) AS BIGINT) AS active_today, CAST(count(*) AS BIGINT) AS all_users
FROM dev GROUP BY ALL""")
def channel_vector(i: Inputs):
    """Per channel new today/yesterday, active today, all-time users."""
    return RP.channel_vector(i.launch)


# ---------------------------------------------------------------------------
# A*: forecast, smoothing, alerts, markers, segments
# ---------------------------------------------------------------------------

FC = ["newusers", "startusers", "sessions", "allusers", "usingtime"]


def _forecast_sql() -> str:
    cols = ", ".join(FC)
    fc = ", ".join(f"avg({c}) OVER w AS {c}_forecast" for c in FC)
    sm = ", ".join(f"CAST(sum({c}) OVER w AS BIGINT) AS {c}_sum" for c in FC)
    return f"""WITH {dense_sql("product")},
f AS (SELECT product_id, d, {cols}, {fc}, {sm}, count(*) OVER w AS k FROM dk
      WINDOW w AS (PARTITION BY product_id ORDER BY d ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
SELECT product_id, d, {cols}, {', '.join(c + '_forecast' for c in FC)}, {', '.join(c + '_sum' for c in FC)}
FROM f WHERE k = 5"""


@query("kpi_forecast", _forecast_sql())
def kpi_forecast(i: Inputs):
    """A1: 5-day mean forecast of the KPI series."""
    from usagelens.functions.densify import densify
    dense = densify(kp(i), ["product_id"], RP.KPI_METRICS, RP.ASOF, key_rows=i.kpi_keys("product_id"), span_src=i.kpi_days)
    return TR.forecast(dense, FC)


@query("kpi_alerts", f"""WITH f AS ({_forecast_sql()}),
long AS ({' UNION ALL '.join(f"SELECT product_id, d, '{m}' AS metric, CAST({m} AS BIGINT) AS fact, {m}_forecast AS forecast, {m}_sum AS fsum FROM f" for m in FC)}),
j AS (SELECT long.*, r.condition,
        CASE WHEN fsum > 0 THEN floor(CAST(abs(fsum - fact * 5) * 200 + fsum AS DOUBLE) / CAST(2 * fsum AS DOUBLE)) END AS dev
      FROM long JOIN alert_rules r ON r.product_id = long.product_id AND r.metric = long.metric WHERE r.active = 1)
SELECT product_id, d, metric, fact, forecast, dev AS deviation_pct, condition FROM j
WHERE (fsum <> 0 AND dev >= condition) OR (fsum = 0 AND fact <> 0)""")
def kpi_alerts(i: Inputs):
    """A3/A4/A5: deviation alerts of every product day against its rules."""
    from usagelens.functions.densify import densify
    from usagelens.sources import registry
    dense = densify(kp(i), ["product_id"], RP.KPI_METRICS, RP.ASOF, key_rows=i.kpi_keys("product_id"), span_src=i.kpi_days)
    return TR.alerts(dense, registry.alert_rules(i.spark), FC)


@query("event_trend", """
WITH ef AS (SELECT e.* FROM app_event e JOIN event_defs x ON x.product_id = e.product_id
            AND x.event_id = e.event_id WHERE x.active = 1),
c AS (SELECT product_id, event_id, d, count(*) AS n FROM ef GROUP BY ALL),
k AS (SELECT product_id, d, count(DISTINCT device_id) AS startusers, count(*) AS sessions FROM launch GROUP BY ALL),
g AS (SELECT x.product_id, x.event_id, CAST(s.d AS DATE) AS d FROM event_defs x,
        (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM ef) s),
es AS (SELECT g.product_id, g.event_id, g.d, coalesce(c.n, 0) AS count,
         coalesce(c.n, 0) / nullif(k.startusers, 0) AS per_user, coalesce(c.n, 0) / nullif(k.sessions, 0) AS per_session
       FROM g LEFT JOIN c USING (product_id, event_id, d) LEFT JOIN k USING (product_id, d)),
sm AS (SELECT product_id, event_id, d, round(avg(count) OVER w, 9) AS count,
         round(avg(per_user) OVER w, 9) AS per_user, round(avg(per_session) OVER w, 9) AS per_session,
         row_number() OVER (PARTITION BY product_id, event_id ORDER BY d) AS pos
       FROM es WINDOW w AS (PARTITION BY product_id, event_id ORDER BY d ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT product_id, event_id, d, count, per_user, per_session FROM sm WHERE pos > 5""")
def event_trend(i: Inputs):
    """A2: 5-day smoothing of the event series (current day included)."""
    from usagelens.operators import events as EV
    kpd = i.kpis("product", with_pages=False)
    es = EV.event_series(EV.event_fact(i.app_event, i.event_defs), kpd, i.event_defs)
    return TR.smooth(es.withColumnRenamed("count", "count"), ["count", "per_user", "per_session"],
                     ["product_id", "event_id"])


@query("kpi_markers", f"""WITH {dense_sql("product")},
m AS (SELECT * FROM markers WHERE (user_id = 1 AND d BETWEEN DATE '2024-01-01' AND DATE '2024-01-31')
      OR (user_id <> 1 AND private = 1 AND d BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'))
SELECT m.marker_id, m.user_id, m.product_id, m.d, m.title, dk.startusers, dk.newusers
FROM m JOIN dk ON dk.product_id = m.product_id AND dk.d = m.d""")
def kpi_markers(i: Inputs):
    """Markers visible to user 1 on the KPI chart, with the day's values."""
    from usagelens.functions.densify import densify
    from usagelens.sources import registry
    dense = densify(kp(i), ["product_id"], RP.KPI_METRICS, RP.ASOF, key_rows=i.kpi_keys("product_id"), span_src=i.kpi_days)
    m = TR.visible_markers(registry.markers(i.spark), 1, None, "2024-01-01", "2024-01-31")
    return (m.join(dense, ["product_id", "d"])
            .select("marker_id", "user_id", "product_id", "d", "title", "startusers", "newusers"))


SEGMENT_TAGS = ('[{"type":"version","value":["1.9","1.10"]},{"type":"channel","value":["ch1","ch2"]},'
                '{"type":"region","value":["NATION_1","NATION_2","NATION_3","NATION_5","NATION_8","NATION_13","NATION_21"]},'
                '{"type":"region","value":[]},{"type":"version","value":null}]')
SEG_WHERE = ("version IN ('1.9', '1.10') AND CAST(channel_id AS VARCHAR) IN ('1', '2') AND region IN "
             "('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8', 'NATION_13', 'NATION_21')")


@query("segment_devices", f"SELECT DISTINCT product_id, device_id FROM launch WHERE {SEG_WHERE}")
def segment_devices(i: Inputs):
    """Devices matching a tag group (version AND channel AND region)."""
    return TR.segment(i.launch, SEGMENT_TAGS, i.channels)


@query("segment_size", f"""
WITH t AS (SELECT product_id, count(DISTINCT device_id) AS all_devices FROM launch GROUP BY ALL),
m AS (SELECT product_id, count(DISTINCT device_id) AS devices FROM launch WHERE {SEG_WHERE} GROUP BY ALL)
SELECT t.product_id, CAST(coalesce(m.devices, 0) AS BIGINT) AS devices, CAST(t.all_devices AS BIGINT) AS all_devices,
  coalesce(m.devices, 0) / t.all_devices AS percent FROM t LEFT JOIN m USING (product_id)""")
def segment_size(i: Inputs):
    """Size and share of the segment."""
    return TR.segment_size(i.launch, SEGMENT_TAGS, i.channels)


# ---------------------------------------------------------------------------
# T*: real-time counts on the raw log
# ---------------------------------------------------------------------------

TODAY = "2024-01-03"  # fixed value: a day on which new devices still arrive


def _today_sql(keys: str, src: str = "launch l", day: str = "SELECT max(d) AS d FROM r") -> str:
    own = "JOIN products p ON p.product_id = l.product_id" if "owner_id" in keys else ""
    return f"""WITH r AS (SELECT l.*{', p.owner_id' if own else ''} FROM {src}
           JOIN channels c ON c.product_id = l.product_id AND c.channel_id = l.channel_id {own}),
day AS ({day}),
t AS (SELECT r.* FROM r, day WHERE r.d = day.d),
c AS (SELECT {keys}, count(*) AS launches, count(DISTINCT device_id) AS devices FROM t GROUP BY ALL),
n AS (SELECT {keys}, count(DISTINCT device_id) AS new_devices FROM t
      WHERE NOT EXISTS (SELECT 1 FROM r y, day WHERE y.d < day.d AND y.device_id = t.device_id
        AND {' AND '.join(f'y.{k} = t.{k}' for k in keys.split(', '))}) GROUP BY ALL)
SELECT {', '.join('c.' + k for k in keys.split(', '))}, (SELECT d FROM day) AS d,
  CAST(c.launches AS BIGINT) AS launches, CAST(c.devices AS BIGINT) AS devices,
  CAST(coalesce(n.new_devices, 0) AS BIGINT) AS new_devices
FROM c LEFT JOIN n USING ({keys})"""


@query("today_counts_product", _today_sql("product_id"))
def today_counts_product(i: Inputs):
    """today's launches, devices and new devices per product."""
    last = K.only_active(i.rollup, i.channels, ["product_id", "channel_id"]).select(F.max("d")).first()[0]
    return RT.today_counts(i.launch, i.channels, "product", day=last, index=i.first_days)


@query("today_counts_channel", _today_sql("product_id, channel_id", day=f"SELECT DATE '{TODAY}' AS d"))
def today_counts_channel(i: Inputs):
    """Counts of one day per channel."""
    return RT.today_counts(i.launch, i.channels, "channel", day=TODAY, index=i.first_days)


@query("today_counts_owner", _today_sql("owner_id", day=f"SELECT DATE '{TODAY}' AS d"))
def today_counts_owner(i: Inputs):
    """Counts of one day per owner over all their apps."""
    return RT.today_counts(i.launch, i.channels, "owner", i.products, day=TODAY, index=i.first_days)


def _today_avg_sql(keys: str) -> str:
    return f"""WITH r AS (SELECT l.* FROM page l JOIN channels c ON c.product_id = l.product_id
           AND c.channel_id = l.channel_id),
day AS (SELECT max(d) AS d FROM r)
SELECT {keys}, (SELECT d FROM day) AS d, CAST(count(DISTINCT session_id) AS BIGINT) AS sessions,
  sum(duration_ms) / count(DISTINCT session_id) AS avg_ms
FROM r WHERE d = (SELECT d FROM day) GROUP BY {keys}"""


@query("today_avg_session_product", _today_avg_sql("product_id"))
def today_avg_session_product(i: Inputs):
    """T4: today's average session time per product."""
    return RT.today_avg_session(i.page, i.channels, "product")


@query("today_avg_session_channel", _today_avg_sql("product_id, channel_id"))
def today_avg_session_channel(i: Inputs):
    """T4: today's average session time per channel."""
    return RT.today_avg_session(i.page, i.channels, "channel")


SERIES_FROM, SERIES_TO = "2024-01-08", "2024-02-03"        # report parameters; the log ends before


def _fact_series_sql(keys: str, key_rows: str, owner: bool) -> str:
    src = "SELECT l.*, p.owner_id FROM launch l JOIN products p ON p.product_id = l.product_id" if owner else "SELECT * FROM launch"
    on = " AND ".join(f"{{0}}.{c} = g.{c}" for c in keys.split(", "))
    first = "SELECT * FROM s l WHERE NOT EXISTS (SELECT 1 FROM launch b WHERE b.product_id = l.product_id AND b.device_id = l.device_id " \
            "AND (b.d < l.d OR (b.d = l.d AND b.launch_id < l.launch_id)))"
    return f"""WITH s AS ({src}),
g AS (SELECT k.*, CAST(x.d AS DATE) AS d FROM ({key_rows}) k CROSS JOIN (SELECT unnest(generate_series(DATE '{SERIES_FROM}', DATE '{SERIES_TO}', INTERVAL 1 DAY)) AS d) x),
c AS (SELECT {keys}, d, count(DISTINCT device_id) AS actives, count(*) AS starts FROM s GROUP BY ALL),
f AS (SELECT {keys}, d, count(*) AS newusers FROM ({first}) GROUP BY ALL)
SELECT {", ".join("g." + c for c in keys.split(", "))}, g.d, CAST(coalesce(c.actives, 0) AS BIGINT) AS actives, CAST(coalesce(c.starts, 0) AS BIGINT) AS starts,
  CAST(coalesce(f.newusers, 0) AS BIGINT) AS newusers
FROM g LEFT JOIN c ON {on.format("c")} AND c.d = g.d LEFT JOIN f ON {on.format("f")} AND f.d = g.d"""


@query("fact_series_owner", _fact_series_sql("owner_id", "SELECT DISTINCT owner_id FROM products", True))
def fact_series_owner(i: Inputs):
    """Actives, starts and new users per owner and day, over all apps of the owner."""
    owners = i.products.select("product_id", "owner_id")
    new = K.first_launch(i.rollup, ["product_id"]).join(owners, "product_id")
    return RP.fact_series(i.rollup.join(owners, "product_id"), ["owner_id"], SERIES_FROM, SERIES_TO, owners.select("owner_id").distinct(), new)


@query("fact_series_channel", _fact_series_sql("product_id, channel_id", "SELECT product_id, channel_id FROM channels", False))
def fact_series_channel(i: Inputs):
    """The same per product and channel; a device is new in the channel of its first launch."""
    return RP.fact_series(i.rollup, ["product_id", "channel_id"], SERIES_FROM, SERIES_TO, i.channels.select("product_id", "channel_id"),
                          K.first_launch(i.rollup, ["product_id"]))
