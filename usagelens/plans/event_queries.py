"""Custom-event and funnel queries."""

from __future__ import annotations

from usagelens.operators import events as EV
from usagelens.plans.catalog import Inputs, query
from usagelens.sources import registry as R

EF = """ef AS (SELECT e.*, x.event_identifier, x.event_name FROM app_event e JOIN event_defs x
       ON x.product_id = e.product_id AND x.event_id = e.event_id WHERE x.active = 1)"""
ENDS = """en AS (SELECT product_id, funnel_id, funnel_name, unit_price,
         arg_min(event_id, seq) AS start_event, arg_max(event_id, seq) AS end_event
       FROM funnels GROUP BY ALL)"""
SPAN = "(SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM ef)"


def fact(i: Inputs):
    return EV.event_fact(i.app_event, i.event_defs)


@query("event_fact", f"""WITH {EF}
SELECT row_id, product_id, channel_id, version, device_id, event_id, event_identifier, num, d FROM ef""")
def event_fact(i: Inputs):
    """L4: custom-event fact (defined, active events only)."""
    return fact(i).select("row_id", "product_id", "channel_id", "version", "device_id", "event_id",
                          "event_identifier", "num", "d")


@query("event_counts", f"""WITH {EF},
c AS (SELECT product_id, event_id, count(*) AS n FROM ef GROUP BY ALL)
SELECT x.product_id, x.event_id, x.event_identifier, x.event_name,
  CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM event_defs x LEFT JOIN c ON c.product_id = x.product_id AND c.event_id = x.event_id
WHERE x.active = 1""")
def event_counts(i: Inputs):
    """Every active event with its count (0 without data)."""
    return EV.event_counts(fact(i), i.event_defs)


@query("event_counts_by_version", f"""WITH {EF}
SELECT product_id, version, event_id, event_identifier, CAST(count(*) AS BIGINT) AS count
FROM ef GROUP BY ALL""")
def event_counts_by_version(i: Inputs):
    """Per version, the active events seen in it with counts."""
    return EV.event_counts(fact(i), i.event_defs, by_version=True)


@query("event_amounts", """
WITH a AS (SELECT product_id, event_id, sum(num) AS amount FROM app_event GROUP BY ALL)
SELECT x.product_id, x.event_id, x.event_identifier, CAST(coalesce(a.amount, 0) AS BIGINT) AS amount
FROM event_defs x LEFT JOIN a ON a.product_id = x.product_id AND a.event_id = x.event_id""")
def event_amounts(i: Inputs):
    """E5: total amount per defined event over the raw events."""
    return EV.event_amounts(i.app_event, i.event_defs)


@query("event_daily", f"""WITH {EF}
SELECT product_id, event_id, d, CAST(count(*) AS BIGINT) AS count FROM ef GROUP BY ALL""")
def event_daily(i: Inputs):
    """Event counts per day."""
    return EV.event_daily(fact(i))


@query("event_grid", f"""WITH {EF},
c AS (SELECT product_id, event_id, d, count(*) AS n FROM ef GROUP BY ALL)
SELECT x.product_id, x.event_id, x.event_identifier, CAST(g.d AS DATE) AS d,
  CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM event_defs x CROSS JOIN {SPAN} g
LEFT JOIN c ON c.product_id = x.product_id AND c.event_id = x.event_id AND c.d = CAST(g.d AS DATE)""")
def event_grid(i: Inputs):
    """Dense defined-event x day grid of counts."""
    return EV.event_grid(fact(i), i.event_defs)


@query("event_series", f"""WITH {EF},
c AS (SELECT product_id, event_id, d, count(*) AS n FROM ef GROUP BY ALL),
k AS (SELECT product_id, d, count(DISTINCT device_id) AS startusers, count(*) AS sessions
      FROM launch GROUP BY ALL),
g AS (SELECT x.product_id, x.event_id, CAST(g.d AS DATE) AS d FROM event_defs x CROSS JOIN {SPAN} g)
SELECT g.product_id, g.event_id, g.d, CAST(coalesce(c.n, 0) AS BIGINT) AS count,
  coalesce(coalesce(c.n, 0) / nullif(k.startusers, 0), 0) AS per_user,
  coalesce(coalesce(c.n, 0) / nullif(k.sessions, 0), 0) AS per_session
FROM g LEFT JOIN c USING (product_id, event_id, d) LEFT JOIN k USING (product_id, d)""")
def event_series(i: Inputs):
    """Dense daily event counts per device and per session."""
    kp = i.kpis("product", with_pages=False)
    return EV.event_series(fact(i), kp, i.event_defs)


@query("funnel_steps", f"""WITH {EF},
c AS (SELECT product_id, event_id, count(*) AS n FROM ef GROUP BY ALL),
s AS (SELECT f.product_id, f.funnel_id,
        CAST(row_number() OVER (PARTITION BY f.product_id, f.funnel_id ORDER BY f.seq) AS INTEGER) AS step,
        f.event_id, f.alias, CAST(coalesce(c.n, 0) AS BIGINT) AS count
      FROM funnels f LEFT JOIN c ON c.product_id = f.product_id AND c.event_id = f.event_id),
s1 AS (SELECT s.*, (SELECT y.count FROM s y WHERE y.product_id = s.product_id
                    AND y.funnel_id = s.funnel_id AND y.step = 1) AS first FROM s)
SELECT product_id, funnel_id, step, event_id, alias, count,
  CASE WHEN first > 0 THEN floor(CAST(count * 2000 + first AS DOUBLE) / CAST(2 * first AS DOUBLE)) / 10 END
    AS pct_of_first,
  CASE WHEN first > 0 THEN printf('%.1f%%',
    floor(CAST(count * 2000 + first AS DOUBLE) / CAST(2 * first AS DOUBLE)) / 10) ELSE '--' END AS pct_label
FROM s1""")
def funnel_steps(i: Inputs):
    """Funnel steps with counts and percent of the first step."""
    return EV.funnel_steps(fact(i), i.funnels)


@query("funnel_summary", f"""WITH {EF}, {ENDS},
c AS (SELECT product_id, event_id, count(*) AS n FROM ef GROUP BY ALL)
SELECT en.product_id, en.funnel_id, en.funnel_name,
  CAST(coalesce(cs.n, 0) AS BIGINT) AS start_count, CAST(coalesce(ce.n, 0) AS BIGINT) AS end_count,
  coalesce(ce.n, 0) / nullif(coalesce(cs.n, 0), 0) AS conversion_rate,
  CAST(coalesce(ce.n, 0) * en.unit_price AS DOUBLE) AS value
FROM en LEFT JOIN c cs ON cs.product_id = en.product_id AND cs.event_id = en.start_event
LEFT JOIN c ce ON ce.product_id = en.product_id AND ce.event_id = en.end_event""")
def funnel_summary(i: Inputs):
    """start/end counts, conversion (end/start) and value."""
    return EV.funnel_summary(fact(i), i.funnels)


@query("funnel_daily", f"""WITH {EF}, {ENDS},
c AS (SELECT product_id, event_id, d, count(*) AS n FROM ef GROUP BY ALL),
s AS (SELECT en.product_id, c.d, sum(c.n) AS start_count FROM en JOIN c
      ON c.product_id = en.product_id AND c.event_id = en.start_event GROUP BY ALL),
e AS (SELECT en.product_id, c.d, sum(c.n) AS end_count, sum(c.n * en.unit_price) AS value FROM en JOIN c
      ON c.product_id = en.product_id AND c.event_id = en.end_event GROUP BY ALL),
g AS (SELECT p.product_id, CAST(g.d AS DATE) AS d FROM (SELECT DISTINCT product_id FROM en) p CROSS JOIN {SPAN} g)
SELECT g.product_id, g.d, CAST(coalesce(e.end_count, 0) AS BIGINT) AS end_count,
  CAST(coalesce(s.start_count, 0) AS BIGINT) AS start_count, coalesce(CAST(e.value AS DOUBLE), 0.0) AS value
FROM g LEFT JOIN s USING (product_id, d) LEFT JOIN e USING (product_id, d)""")
def funnel_daily(i: Inputs):
    """Per day over all funnels: end count, start count and value."""
    return EV.funnel_daily(fact(i), i.funnels)


@query("funnel_target_series", f"""WITH {EF}, {ENDS},
c AS (SELECT product_id, event_id, d, count(*) AS n FROM ef GROUP BY ALL)
SELECT en.product_id, en.funnel_id, en.end_event AS event_id, CAST(g.d AS DATE) AS d,
  CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM en CROSS JOIN {SPAN} g LEFT JOIN c ON c.product_id = en.product_id AND c.event_id = en.end_event
  AND c.d = CAST(g.d AS DATE)""")
def funnel_target_series(i: Inputs):
    """Dense daily count of each funnel's target event."""
    return EV.funnel_target_series(fact(i), i.funnels)


MAX_STEPS = max(len(f[3]) for f in R.FUNNELS)


def _ordered_oracle(window_seconds: int = 7 * 86400) -> str:
    parts = [f"""WITH {EF},
st AS (SELECT product_id, funnel_id, event_id,
         row_number() OVER (PARTITION BY product_id, funnel_id ORDER BY seq) AS step FROM funnels),
ev AS (SELECT ef.product_id, ef.device_id, ef.ts, st.funnel_id, st.step FROM ef JOIN st
       ON st.product_id = ef.product_id AND st.event_id = ef.event_id),
r1 AS (SELECT product_id, funnel_id, device_id, min(ts) AS t, min(ts) AS t0 FROM ev WHERE step = 1 GROUP BY ALL)"""]
    for k in range(2, MAX_STEPS + 1):
        parts.append(f"""r{k} AS (SELECT ev.product_id, ev.funnel_id, ev.device_id, min(ev.ts) AS t, min(r.t0) AS t0
  FROM ev JOIN r{k - 1} r ON r.product_id = ev.product_id AND r.funnel_id = ev.funnel_id
    AND r.device_id = ev.device_id
  WHERE ev.step = {k} AND ev.ts >= r.t AND ev.ts <= r.t0 + INTERVAL {window_seconds} SECOND GROUP BY ALL)""")
    union = "\nUNION ALL ".join(f"SELECT product_id, funnel_id, {k} AS step FROM r{k}"
                                for k in range(1, MAX_STEPS + 1))
    return ",\n".join(parts) + f""",
u AS ({union}),
c AS (SELECT product_id, funnel_id, step, count(*) AS n FROM u GROUP BY ALL)
SELECT st.product_id, st.funnel_id, CAST(st.step AS INTEGER) AS step, CAST(coalesce(c.n, 0) AS BIGINT) AS devices
FROM st LEFT JOIN c USING (product_id, funnel_id, step)"""


@query("ordered_funnel", _ordered_oracle())
def ordered_funnel(i: Inputs):
    """E15 (extension): devices completing each funnel step in order within
    7 days of entering."""
    return EV.ordered_funnel(fact(i), i.funnels, MAX_STEPS)


# ---------------------------------------------------------------------------
# one version, a range of days
# ---------------------------------------------------------------------------

VERSION, FROM, TO = "1.9", "2024-01-06", "2024-01-22"        # report parameters


@query("event_series_version", f"""WITH {EF},
c AS (SELECT product_id, event_id, d, count(*) AS n FROM ef WHERE version = '{VERSION}' GROUP BY ALL),
k AS (SELECT product_id, d, count(DISTINCT device_id) AS startusers, count(*) AS sessions FROM launch WHERE version = '{VERSION}' GROUP BY ALL),
g AS (SELECT x.product_id, x.event_id, CAST(s.d AS DATE) AS d FROM event_defs x
      CROSS JOIN (SELECT unnest(generate_series(DATE '{FROM}', DATE '{TO}', INTERVAL 1 DAY)) AS d) s)
SELECT g.product_id, g.event_id, g.d, CAST(coalesce(c.n, 0) AS BIGINT) AS count,
  coalesce(coalesce(c.n, 0) / nullif(k.startusers, 0), 0) AS per_user, coalesce(coalesce(c.n, 0) / nullif(k.sessions, 0), 0) AS per_session
FROM g LEFT JOIN c USING (product_id, event_id, d) LEFT JOIN k USING (product_id, d)""")
def event_series_version(i: Inputs):
    """Event counts per device and per session of one version, over a range of days."""
    return EV.event_series(fact(i), i.kpis("version", with_pages=False), i.event_defs, VERSION, FROM, TO)


@query("event_counts_range", f"""WITH {EF},
c AS (SELECT product_id, event_id, sum(num) AS n FROM ef WHERE d BETWEEN DATE '{FROM}' AND DATE '{TO}' GROUP BY ALL)
SELECT x.product_id, x.event_id, x.event_identifier, x.event_name, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM event_defs x LEFT JOIN c ON c.product_id = x.product_id AND c.event_id = x.event_id WHERE x.active = 1""")
def event_counts_range(i: Inputs):
    """Summed amounts of every active event over a range of days."""
    return EV.event_counts(fact(i), i.event_defs, measure="sum", a=FROM, b=TO)


@query("funnel_steps_version", f"""WITH {EF},
c AS (SELECT product_id, event_id, count(*) AS n FROM ef WHERE version = '{VERSION}' AND d BETWEEN DATE '{FROM}' AND DATE '{TO}' GROUP BY ALL),
s AS (SELECT f.product_id, f.funnel_id, CAST(row_number() OVER (PARTITION BY f.product_id, f.funnel_id ORDER BY f.seq) AS INTEGER) AS step,
        f.event_id, f.alias, CAST(coalesce(c.n, 0) AS BIGINT) AS count
      FROM funnels f LEFT JOIN c ON c.product_id = f.product_id AND c.event_id = f.event_id),
s1 AS (SELECT s.*, (SELECT y.count FROM s y WHERE y.product_id = s.product_id AND y.funnel_id = s.funnel_id AND y.step = 1) AS first FROM s)
SELECT product_id, funnel_id, step, event_id, alias, count,
  CASE WHEN first > 0 THEN floor(CAST(count * 2000 + first AS DOUBLE) / CAST(2 * first AS DOUBLE)) / 10 END AS pct_of_first,
  CASE WHEN first > 0 THEN printf('%.1f%%', floor(CAST(count * 2000 + first AS DOUBLE) / CAST(2 * first AS DOUBLE)) / 10) ELSE '--' END AS pct_label
FROM s1""")
def funnel_steps_version(i: Inputs):
    """Funnel steps of one version over a range of days."""
    return EV.funnel_steps(fact(i), i.funnels, FROM, TO, VERSION)
