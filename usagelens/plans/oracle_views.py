"""DuckDB SQL for the fixture views and registry tables.

Every oracle statement is ``WITH <the views it names> <body>``.  The views
are written independently of the Spark builders in ``sources/fixtures.py``
(same column meaning, separate text) so a typo on one side shows up as an
oracle mismatch instead of silently agreeing.
"""

from __future__ import annotations

import re

from usagelens.sources import registry as R

_VERSION = ("CASE WHEN day(e.ts) <= 8 + e.user_id % 7 THEN '1.2' "
            "WHEN day(e.ts) <= 20 THEN '1.9' ELSE '1.10' END")
_CHANNEL = "CAST(1 + (e.user_id + day(e.ts)) % 4 AS INTEGER)"
_PRODUCT = "CAST(1 + e.event_id % 3 AS INTEGER)"
_DEVICE = "'d' || CAST(e.user_id AS VARCHAR)"


def _values(rows, cols: str) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({cols})"


VIEWS: dict[str, str] = {
    "launch": f"""
SELECT e.event_id AS launch_id, {_PRODUCT} AS product_id, {_CHANNEL} AS channel_id,
  {_VERSION} AS version, {_DEVICE} AS device_id, e.ts AS ts, CAST(e.ts AS DATE) AS d,
  CAST(hour(e.ts) AS INTEGER) AS h,
  CASE WHEN e.event_id % 50 = 0 THEN e.ts + INTERVAL 3 DAY ELSE e.ts END AS ingest_ts,
  'os' || CAST(e.user_id % 5 AS VARCHAR) AS os,
  'brand' || CAST(e.user_id % 12 AS VARCHAR) AS brand,
  'net' || CAST(e.event_id % 4 AS VARCHAR) AS network,
  'res' || CAST(e.user_id % 6 AS VARCHAR) AS resolution,
  'lang' || CAST(e.user_id % 3 AS VARCHAR) AS language,
  'car' || CAST(e.user_id % 7 AS VARCHAR) AS carrier,
  r.r_name AS country, n.n_name AS region
FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "page": f"""
SELECT e.event_id AS view_id, {_PRODUCT} AS product_id, {_CHANNEL} AS channel_id,
  {_VERSION} AS version, {_DEVICE} AS device_id,
  's' || CAST(e.user_id AS VARCHAR) || '-' || CAST({_PRODUCT} AS VARCHAR) || '-' ||
    CAST(CAST(date_trunc('week', e.ts) AS DATE) AS VARCHAR) AS session_id,
  e.event_type AS activity, e.ts AS start_ts,
  e.ts + to_milliseconds(CAST(round(e.value * 1000) AS BIGINT)) AS end_ts,
  CAST(round(e.value * 1000) AS BIGINT) AS duration_ms, CAST(e.ts AS DATE) AS d
FROM events e""",
    "app_event": f"""
SELECT e.event_id AS row_id, {_PRODUCT} AS product_id, {_CHANNEL} AS channel_id,
  {_VERSION} AS version, {_DEVICE} AS device_id,
  CAST(CASE e.event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
       WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS INTEGER) AS event_id,
  '' AS label, CAST(1 + e.event_id % 3 AS INTEGER) AS num, e.ts AS ts, CAST(e.ts AS DATE) AS d
FROM events e""",
    "crash": f"""
SELECT e.event_id AS crash_id, {_PRODUCT} AS product_id, {_CHANNEL} AS channel_id,
  {_VERSION} AS version, {_DEVICE} AS device_id,
  'os' || CAST(e.user_id % 5 AS VARCHAR) AS os,
  'brand' || CAST(e.user_id % 12 AS VARCHAR) AS brand, 'main' AS activity,
  'E' || CAST(e.event_id % 9 AS VARCHAR) || chr(10) || 'at f' || CAST(e.event_id % 4 AS VARCHAR)
    || chr(10) || 'at g' || chr(10) || 'at main' AS stacktrace,
  'E' || CAST(e.event_id % 9 AS VARCHAR) || chr(10) || 'at f' || CAST(e.event_id % 4 AS VARCHAR)
    || chr(10) || 'at g' AS title,
  e.ts AS ts, CAST(e.ts AS DATE) AS d, e.event_id % 9 < 2 AS is_fixed
FROM events e WHERE e.event_type = 'error'""",
    "launch_long": """
SELECT o.o_orderkey AS launch_id, CAST(1 + o.o_orderkey % 3 AS INTEGER) AS product_id,
  CAST(1 + o.o_custkey % 4 AS INTEGER) AS channel_id,
  'v' || CAST(year(o.o_orderdate) % 3 AS VARCHAR) AS version,
  'd' || CAST(o.o_custkey AS VARCHAR) AS device_id, CAST(o.o_orderdate AS DATE) AS d
FROM orders o""",
    "products": _values(R.PRODUCTS, "product_id, product_name, owner_id, platform, product_active"),
    "channels": _values(
        [(p[0], c, f"ch{c}", f"key-{p[0]}-{c}", p[4], 0 if c in R.INACTIVE_CHANNELS else 1)
         for p in R.PRODUCTS for c in R.CHANNEL_IDS],
        "product_id, channel_id, channel_name, app_key, product_active, channel_active"),
    "active_channels": "SELECT product_id, channel_id FROM channels "
                       "WHERE product_active = 1 AND channel_active = 1",
    "event_defs": _values([(p[0], *e) for p in R.PRODUCTS for e in R.EVENT_DEFS],
                          "product_id, event_id, event_identifier, event_name, active"),
    "funnels": ("SELECT product_id, funnel_id, funnel_name, CAST(unit_price AS DECIMAL(12,2)) "
                "AS unit_price, seq, event_id, alias FROM (" + _values(
                    [(p[0], f[0], f[1], f[2], *s) for p in R.PRODUCTS for f in R.FUNNELS for s in f[3]],
                    "product_id, funnel_id, funnel_name, unit_price, seq, event_id, alias") + ")"),
    "alert_rules": ("SELECT product_id, metric, CAST(condition AS DOUBLE) AS condition, active FROM ("
                    + _values([(p[0], m, R.ALERT_CONDITIONS[(i + p[0]) % 3], 1)
                               for p in R.PRODUCTS for i, m in enumerate(R.ALERT_METRICS)],
                              "product_id, metric, condition, active") + ")"),
    "markers": ("SELECT marker_id, user_id, product_id, CAST(d AS DATE) AS d, title, private FROM ("
                + _values(R.MARKERS, "marker_id, user_id, product_id, d, title, private") + ")"),
    "mccmnc": _values(R.MCCMNC, "code, carrier"),
    "launch_buckets": ("SELECT bucket_id, bucket, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi FROM ("
                       + _values(R.LAUNCH_BUCKETS, "bucket_id, bucket, lo, hi") + ")"),
    "usage_buckets": ("SELECT bucket_id, bucket, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi FROM ("
                      + _values(R.USAGE_BUCKETS, "bucket_id, bucket, lo, hi") + ")"),
}

# views that reference other views
_DEPS = {"active_channels": ["channels"]}


def with_views(body: str) -> str:
    """Prefix ``body`` with the CTEs of every view it mentions."""
    needed: list[str] = []

    def add(name: str):
        for dep in _DEPS.get(name, []):
            add(dep)
        if name not in needed:
            needed.append(name)

    for name in VIEWS:
        if re.search(rf"\b{name}\b", body):
            add(name)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    stripped = body.lstrip()
    if stripped[:4].upper() == "WITH":
        return f"WITH {ctes},\n{stripped[4:]}"
    return f"WITH {ctes}\n{body}"
