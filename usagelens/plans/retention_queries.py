"""Cohort sizes, retention (day/week/month), retention reports and period
active ratios."""

from __future__ import annotations

from usagelens.operators import reports as RP
from usagelens.operators import retention as RT
from usagelens.plans.catalog import Inputs, query
from usagelens.plans.kpi_queries import FLAGGED

# ---------------------------------------------------------------------------
# oracle: the reference's form -- EXISTS on the new-launch row inside the
# shifted period, two rollups united, one statement per offset folded into a
# cross product with the offsets 1..8.
# ---------------------------------------------------------------------------


def _flagged_for(src: str) -> str:
    return FLAGGED.replace("FROM launch b", f"FROM {src} b").replace("FROM launch l", f"FROM {src} l")


def _pstart(col: str, kind: str) -> str:
    if kind == "day":
        return col
    if kind == "week":
        return f"({col} - CAST(dayofweek({col}) AS INTEGER))"
    return f"CAST(date_trunc('month', {col}) AS DATE)"


def _cohort_bounds(ps: str, n: str, kind: str) -> tuple[str, str]:
    if kind == "day":
        lo = f"({ps} - CAST({n} AS INTEGER))"
        return lo, lo
    if kind == "week":
        lo = f"({ps} - CAST(7 * {n} AS INTEGER))"
        return lo, f"({lo} + 6)"
    lo = f"CAST({ps} - to_months(CAST({n} AS INTEGER)) AS DATE)"
    return lo, f"last_day({lo})"


def _rollups(select_keys: str, src: str, extra: str, agg: str) -> str:
    outs = ("CAST(coalesce(product_id, -1) AS INTEGER) AS product_id, "
            "coalesce(version, 'all') AS version, coalesce(channel, 'all') AS channel")
    return (f"SELECT {select_keys}, {outs}, {agg} FROM {src} GROUP BY {extra}, "
            f"ROLLUP (product_id, version, channel)\nUNION\n"
            f"SELECT {select_keys}, {outs}, {agg} FROM {src} GROUP BY {extra}, "
            f"ROLLUP (product_id, channel, version)")


def retention_oracle(kind: str, src: str = "launch", depth: int = 8) -> str:
    ps = _pstart("d", kind)
    lo, hi = _cohort_bounds("a.ps", "o.n", kind)
    pivot = ",\n".join(
        f"  CAST(coalesce(max(CASE WHEN r.ofs = {k} THEN r.n END), 0) AS BIGINT) AS {kind}{k}"
        for k in range(1, depth + 1))
    cols = ", ".join(f"CAST(coalesce(w.{kind}{k}, 0) AS BIGINT) AS {kind}{k}" for k in range(1, depth + 1))
    return f"""WITH {_flagged_for(src)},
nw AS (SELECT product_id, version, CAST(channel_id AS VARCHAR) AS channel, device_id, d,
         {ps} AS ps FROM fa WHERE isnew = 1),
act AS (SELECT DISTINCT product_id, version, CAST(channel_id AS VARCHAR) AS channel, device_id,
          {ps} AS ps FROM fa),
ret AS (SELECT a.product_id, a.version, a.channel, a.device_id, CAST(o.n AS INTEGER) AS ofs,
          {lo} AS cohort_start
        FROM act a, range(1, {depth + 1}) o(n)
        WHERE EXISTS (SELECT 1 FROM nw WHERE nw.product_id = a.product_id
                      AND nw.device_id = a.device_id AND nw.d BETWEEN {lo} AND {hi})),
r AS ({_rollups("cohort_start, ofs", "ret", "cohort_start, ofs", "count(DISTINCT device_id) AS n")}),
w AS (SELECT r.cohort_start, r.product_id, r.version, r.channel,
{pivot}
      FROM r GROUP BY ALL),
cs AS ({_rollups("ps AS cohort_start", "nw", "ps", "count(DISTINCT device_id) AS usercount")})
SELECT coalesce(cs.cohort_start, w.cohort_start) AS cohort_start,
  coalesce(cs.product_id, w.product_id) AS product_id, coalesce(cs.version, w.version) AS version,
  coalesce(cs.channel, w.channel) AS channel, CAST(coalesce(cs.usercount, 0) AS BIGINT) AS usercount,
  {cols}
FROM cs FULL OUTER JOIN w ON cs.cohort_start = w.cohort_start AND cs.product_id = w.product_id
  AND cs.version = w.version AND cs.channel = w.channel"""


def cohort_oracle(kind: str, src: str = "launch") -> str:
    ps = _pstart("d", kind)
    return f"""WITH {_flagged_for(src)},
nw AS (SELECT product_id, version, CAST(channel_id AS VARCHAR) AS channel, device_id, {ps} AS ps
       FROM fa WHERE isnew = 1)
{_rollups("ps AS cohort_start", "nw", "ps", "CAST(count(DISTINCT device_id) AS BIGINT) AS usercount")}"""


@query("cohort_size_day", cohort_oracle("day"))
def cohort_size_day(i: Inputs):
    """Daily cohort sizes by the five grouping sets."""
    return RT.cohort_size(i.launch, i.active, "day", RT.keys_from_rollup(i.rollup))


@query("cohort_size_week", cohort_oracle("week"))
def cohort_size_week(i: Inputs):
    """Weekly (Sunday-Saturday) cohort sizes."""
    return RT.cohort_size(i.launch, i.active, "week", RT.keys_from_rollup(i.rollup))


@query("cohort_size_month", cohort_oracle("month", "launch_long"))
def cohort_size_month(i: Inputs):
    """Monthly cohort sizes over the long launch history."""
    return RT.cohort_size(i.launch_long, i.active, "month", keys=i.long_keys)


@query("retention_day", retention_oracle("day"))
def retention_day(i: Inputs):
    """Day 1-8 retention, grouped by the return visit's version/channel."""
    return RT.retention(i.launch, i.active, "day", keys=RT.keys_from_rollup(i.rollup))


@query("retention_week", retention_oracle("week"))
def retention_week(i: Inputs):
    """P5: week 1-8 retention."""
    return RT.retention(i.launch, i.active, "week", keys=RT.keys_from_rollup(i.rollup))


@query("retention_month", retention_oracle("month", "launch_long"))
def retention_month(i: Inputs):
    """Month 1-8 retention over the long launch history."""
    return RT.retention(i.launch_long, i.active, "month", keys=i.long_keys)


@query("retention_report_day", f"""
WITH x AS ({retention_oracle("day")})
SELECT * FROM x WHERE version = 'all' AND channel = 'all' AND product_id <> -1""")
def retention_report_day(i: Inputs):
    """G1: daily retention rows over all versions and channels, per product,
    newest first."""
    from pyspark.sql import functions as F
    return RT.retention_report(RT.retention(i.launch, i.active, "day", keys=RT.keys_from_rollup(i.rollup))).where(F.col("product_id") != -1)


@query("retention_report_week", f"""
WITH x AS ({retention_oracle("week")})
SELECT * FROM x WHERE version = '1.9' AND channel = 'all' AND cohort_start >= DATE '2024-01-05'
  AND cohort_start + 6 <= DATE '2024-01-24'""")
def retention_report_week(i: Inputs):
    """Weekly retention of one version over all channels; the range cuts
    a week at either end, and cut weeks are left out."""
    return RT.retention_report(RT.retention(i.launch, i.active, "week", keys=RT.keys_from_rollup(i.rollup)), version="1.9",
                               a="2024-01-05", b="2024-01-24", kind="week")


@query("retention_report_month", f"""
WITH x AS ({retention_oracle("month", "launch_long")})
SELECT * FROM x WHERE version = 'all' AND channel = '2' AND cohort_start >= DATE '1993-02-10'
  AND last_day(cohort_start) <= DATE '1997-06-15'""")
def retention_report_month(i: Inputs):
    """Monthly retention of one channel over all versions; the range
    cuts a month at either end."""
    return RT.retention_report(RT.retention(i.launch_long, i.active, "month", keys=i.long_keys), channel="2", a="1993-02-10",
                               b="1997-06-15", kind="month")


_PCT = ", ".join(
    f"CASE WHEN usercount > 0 THEN floor(CAST(day{k} * 2000 + usercount AS DOUBLE) / CAST(2 * usercount AS DOUBLE)) / 10 END "
    f"AS day{k}_pct" for k in range(1, 9))


@query("retention_pct", f"""
WITH x AS ({retention_oracle("day")})
SELECT cohort_start, product_id, version, channel, usercount, {_PCT} FROM x""")
def retention_pct(i: Inputs):
    """Retention percentages (one decimal, half up)."""
    return RT.retention_pct(RT.retention(i.launch, i.active, "day", keys=RT.keys_from_rollup(i.rollup)), "day")


def _ratio_oracle(kind: str, by: str) -> str:
    ps = _pstart("d", kind)
    pe = {"week": "(p.ps + 6)", "month": "last_day(p.ps)"}[kind]
    corr = " AND ".join(f"y.{c} = p.{c}" for c in by.split(", "))
    return f"""WITH fa AS (SELECT l.*, {ps} AS ps FROM launch l JOIN active_channels a
                 ON a.product_id = l.product_id AND a.channel_id = l.channel_id),
p AS (SELECT {by}, ps, count(DISTINCT device_id) AS activeusers FROM fa GROUP BY ALL)
SELECT {', '.join('p.' + c for c in by.split(', '))}, p.ps AS period_start,
  CAST(p.activeusers AS BIGINT) AS activeusers,
  CAST((SELECT count(DISTINCT y.device_id) FROM fa y WHERE {corr} AND y.d <= {pe}) AS BIGINT) AS allusers,
  p.activeusers / (SELECT count(DISTINCT y.device_id) FROM fa y WHERE {corr} AND y.d <= {pe}) AS percent
FROM p"""


@query("active_ratio_week", _ratio_oracle("week", "product_id"))
def active_ratio_week(i: Inputs):
    """Weekly active devices and share of all devices to date."""
    return RT.active_ratio(i.launch, i.active, "week", ["product_id"], keys=RT.keys_from_rollup(i.rollup))


@query("active_ratio_month", _ratio_oracle("month", "product_id"))
def active_ratio_month(i: Inputs):
    """Monthly active devices and share."""
    return RT.active_ratio(i.launch, i.active, "month", ["product_id"], keys=RT.keys_from_rollup(i.rollup))


@query("channel_active_ratio_week", _ratio_oracle("week", "product_id, channel_id"))
def channel_active_ratio_week(i: Inputs):
    """Weekly active share per channel."""
    return RT.active_ratio(i.launch, i.active, "week", ["product_id", "channel_id"], keys=RT.keys_from_rollup(i.rollup))


@query("channel_active_ratio_month", _ratio_oracle("month", "product_id, channel_id"))
def channel_active_ratio_month(i: Inputs):
    """Monthly active share per channel."""
    return RT.active_ratio(i.launch, i.active, "month", ["product_id", "channel_id"], keys=RT.keys_from_rollup(i.rollup))


def _ratio_series_sql(kind: str, step: str) -> str:
    return f"""WITH r AS ({_ratio_oracle(kind, "product_id, channel_id")}),
g AS (SELECT c.product_id, c.channel_id, CAST(s.ps AS DATE) AS period_start FROM active_channels c,
        (SELECT unnest(generate_series(min(period_start), max(period_start), INTERVAL {step})) AS ps FROM r) s)
SELECT g.product_id, g.channel_id, g.period_start, CAST(coalesce(r.activeusers, 0) AS BIGINT) AS activeusers,
  coalesce(r.percent, 0.0) AS percent
FROM g LEFT JOIN r USING (product_id, channel_id, period_start)"""


def _ratio_series(i: Inputs, kind: str):
    from usagelens.operators.reports import channel_ratio_series
    ratios = RT.active_ratio(i.launch, i.active, kind, ["product_id", "channel_id"], keys=RT.keys_from_rollup(i.rollup))
    return channel_ratio_series(ratios, i.active, kind)


@query("channel_ratio_series_week", _ratio_series_sql("week", "7 DAY"))
def channel_ratio_series_week(i: Inputs):
    """Weekly channel active ratio, dense over active channels and
    week starts."""
    return _ratio_series(i, "week")


@query("channel_ratio_series_month", _ratio_series_sql("month", "1 MONTH"))
def channel_ratio_series_month(i: Inputs):
    """The same by calendar month."""
    return _ratio_series(i, "month")


# ---------------------------------------------------------------------------
# ratios at one period, over a shifted window, and their keys
# ---------------------------------------------------------------------------

RATIO_RANGE = {"week": ("2024-01-15", "2024-01-28"), "month": ("2024-02-01", "2024-02-29")}        # report parameters
_SHIFTED = {"week": ("- INTERVAL 13 DAY", "- INTERVAL 7 DAY"), "month": ("- INTERVAL 2 MONTH + INTERVAL 1 DAY", "- INTERVAL 1 MONTH")}


ON = "product_active = 1 AND channel_active = 1"


def _channel_ratios(i: Inputs, kind: str):
    return RT.active_ratio(i.launch, i.active, kind, ["product_id", "channel_id"], keys=RT.keys_from_rollup(i.rollup))


@query("channel_ratio_at", f"""WITH r AS ({_ratio_oracle("week", "product_id, channel_id")})
SELECT c.product_id, c.channel_id, coalesce(r.percent, 0.0) AS percent FROM (SELECT * FROM channels WHERE {ON}) c
LEFT JOIN r ON r.product_id = c.product_id AND r.channel_id = c.channel_id AND r.period_start = DATE '2024-01-15'""")
def channel_ratio_at(i: Inputs):
    """Every active channel's active ratio in one week, 0 without any."""
    return RP.channel_ratio_at(_channel_ratios(i, "week"), i.channels.where(ON), "2024-01-15")


def _ratio_window(kind: str):
    a, b = RATIO_RANGE[kind]
    lo, hi = _SHIFTED[kind]

    @query(f"channel_ratio_window_{kind}", f"""WITH r AS ({_ratio_oracle(kind, "product_id, channel_id")}),
w AS (SELECT * FROM r WHERE period_start BETWEEN CAST(DATE '{a}' {lo} AS DATE) AND CAST(DATE '{b}' {hi} AS DATE)),
g AS (SELECT c.product_id, c.channel_id, c.channel_name, p.period_start FROM (SELECT * FROM channels WHERE {ON}) c
      JOIN (SELECT DISTINCT product_id, period_start FROM w) p ON p.product_id = c.product_id)
SELECT g.product_id, g.channel_id, g.channel_name, g.period_start, coalesce(w.percent, 0.0) AS percent
FROM g LEFT JOIN w ON w.product_id = g.product_id AND w.channel_id = g.channel_id AND w.period_start = g.period_start""")
    def window_form(i: Inputs):
        return RP.channel_ratio_window(_channel_ratios(i, kind), i.channels.where(ON), kind, a, b)
    window_form.__doc__ = f"R10/R21: {kind}ly channel ratios of a report range, shifted to periods that have ended."


for _kind in RATIO_RANGE:
    _ratio_window(_kind)


@query("channel_ratio_keys", f"""WITH r AS ({_ratio_oracle("week", "product_id, channel_id")})
SELECT DISTINCT r.product_id, r.period_start, c.channel_name FROM r JOIN (SELECT * FROM channels WHERE {ON}) c ON c.product_id = r.product_id AND c.channel_id = r.channel_id
WHERE r.period_start BETWEEN CAST(DATE '2024-01-15' - INTERVAL 7 DAY AS DATE) AND DATE '2024-01-28'""")
def channel_ratio_keys(i: Inputs):
    """Period starts and channel names that have ratios in a report range."""
    return RP.ratio_keys(_channel_ratios(i, "week"), i.channels.where(ON), "week", *RATIO_RANGE["week"])
