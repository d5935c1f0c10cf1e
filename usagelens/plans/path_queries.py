"""Page statistics, transitions, levels and the page/path reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from usagelens.operators import paths as PT
from usagelens.plans.catalog import Inputs, query

K = "product_id, channel_id, version, d, activity"

STATS_SQL = f"""
v AS (SELECT p.product_id, p.channel_id, p.version, p.d, p.activity, count(*) AS accesscount,
        sum(p.duration_ms) AS totaltime
      FROM page p JOIN active_channels a ON a.product_id = p.product_id AND a.channel_id = p.channel_id
      GROUP BY ALL),
ex AS (SELECT p.product_id, p.channel_id, p.version, p.d, p.activity, count(*) AS exitcount
       FROM page p WHERE NOT EXISTS (
         SELECT 1 FROM page q WHERE q.product_id = p.product_id AND q.session_id = p.session_id
           AND q.d = p.d AND (q.end_ts > p.end_ts OR (q.end_ts = p.end_ts AND q.view_id > p.view_id)))
       GROUP BY ALL),
kk AS (SELECT {K} FROM v UNION SELECT {K} FROM ex),
ps AS (SELECT kk.*, CAST(coalesce(v.accesscount, 0) AS BIGINT) AS accesscount,
         CAST(coalesce(v.totaltime, 0) AS BIGINT) AS totaltime,
         CAST(coalesce(ex.exitcount, 0) AS BIGINT) AS exitcount
       FROM kk LEFT JOIN v USING ({K}) LEFT JOIN ex USING ({K}))"""

TRANS_SQL = """
tr0 AS (SELECT product_id, channel_id, version, d, activity AS from_activity,
          coalesce(lead(activity) OVER w, 'Exit') AS to_activity,
          CAST(row_number() OVER w AS INTEGER) AS jump
        FROM page WINDOW w AS (PARTITION BY product_id, session_id, d ORDER BY start_ts, view_id)),
tr AS (SELECT product_id, channel_id, version, d, from_activity, to_activity, jump,
         CAST(count(*) AS BIGINT) AS count FROM tr0 GROUP BY ALL)"""

LEVELS_PV_SQL = """
lv AS (SELECT product_id, version, from_activity, to_activity, min(jump) AS level,
         CAST(sum(count) AS BIGINT) AS count FROM tr GROUP BY ALL)"""

ENTRY_SQL = """
en AS (SELECT product_id, version, from_activity, CAST(sum(count) AS BIGINT) AS count,
         sum(count) / sum(sum(count)) OVER (PARTITION BY product_id, version) AS percentage,
         row_number() OVER (PARTITION BY product_id, version
                            ORDER BY sum(count) DESC, from_activity) AS rank
       FROM lv WHERE level = 1 GROUP BY product_id, version, from_activity),
fe AS (SELECT product_id, version, from_activity, to_activity, level,
         CAST(sum(count) AS BIGINT) AS count,
         sum(count) / sum(sum(count)) OVER (PARTITION BY product_id, version, from_activity, level)
           AS percentage
       FROM lv GROUP BY product_id, version, from_activity, to_activity, level)"""


@query("page_stats", f"WITH {STATS_SQL}\nSELECT * FROM ps")
def page_stats(i: Inputs):
    """Views and time (active entries) and exits per page and day."""
    return PT.page_stats(i.page, i.active)


@query("page_transitions", f"WITH {TRANS_SQL}\nSELECT * FROM tr")
def page_transitions(i: Inputs):
    """Page-to-page transitions with jump number; session end -> Exit."""
    return PT.transitions(i.page)


PAGE_GAPS_SQL = """
pg AS (SELECT product_id, channel_id, version, d, view_id, CASE WHEN view_id % 41 = 0 THEN NULL ELSE session_id END AS session_id,
         CASE WHEN view_id % 43 = 0 THEN NULL ELSE start_ts END AS start_ts, CASE WHEN view_id % 47 = 0 THEN NULL ELSE activity END AS activity FROM page)"""


@query("page_transitions_gaps", f"""WITH {PAGE_GAPS_SQL},
t AS (SELECT product_id, channel_id, version, d, activity AS from_activity,
        CASE WHEN lead(view_id) OVER w IS NULL THEN 'Exit' ELSE lead(activity) OVER w END AS to_activity,
        CAST(row_number() OVER w AS INTEGER) AS jump
      FROM pg WINDOW w AS (PARTITION BY product_id, session_id, d ORDER BY start_ts NULLS FIRST, view_id))
SELECT product_id, channel_id, version, d, from_activity, to_activity, jump, CAST(count(*) AS BIGINT) AS count FROM t GROUP BY ALL""")
def page_transitions_gaps(i: Inputs):
    """P11 where sessions, start times and page names are missing: every view still counts once."""
    gap = lambda c, n: F.when(F.col("view_id") % n != 0, F.col(c)).alias(c)
    return PT.transitions(i.page.select("product_id", "channel_id", "version", "d", "view_id", gap("session_id", 41), gap("start_ts", 43), gap("activity", 47)))


@query("page_levels", """WITH {0},
lv AS (SELECT product_id, channel_id, version, from_activity, to_activity, min(jump) AS level,
         CAST(sum(count) AS BIGINT) AS count FROM tr GROUP BY ALL)
SELECT * FROM lv""".format(TRANS_SQL))
def page_levels(i: Inputs):
    """Transitions collapsed to levels (min jump, total count)."""
    return PT.page_levels(i.transitions)


@query("page_report", f"""WITH {STATS_SQL}
SELECT product_id, version, activity, CAST(sum(accesscount) AS BIGINT) AS views,
  CAST(sum(totaltime) AS BIGINT) AS totaltime, sum(totaltime) / nullif(sum(accesscount), 0) AS avg_time_ms,
  CAST(sum(exitcount) AS BIGINT) AS exits FROM ps GROUP BY product_id, version, activity
UNION ALL
SELECT product_id, 'all', activity, CAST(sum(accesscount) AS BIGINT),
  CAST(sum(totaltime) AS BIGINT), sum(totaltime) / nullif(sum(accesscount), 0),
  CAST(sum(exitcount) AS BIGINT) FROM ps GROUP BY product_id, activity""")
def page_report(i: Inputs):
    """Per page, by version and over all versions: views, time, exits."""
    return PT.page_report(PT.page_stats(i.page, i.active))


@query("page_share", f"""WITH {STATS_SQL},
r AS (SELECT product_id, version, activity, sum(accesscount) AS views, sum(totaltime) AS totaltime,
        sum(exitcount) AS exits FROM ps GROUP BY ALL)
SELECT product_id, version, activity,
  views / nullif(sum(views) OVER (PARTITION BY product_id, version), 0) AS views_share,
  totaltime / nullif(sum(totaltime) OVER (PARTITION BY product_id, version), 0) AS time_share,
  exits / nullif(sum(exits) OVER (PARTITION BY product_id, version), 0) AS exits_share
FROM r""")
def page_share(i: Inputs):
    """Each page's share of its version's views, time and exits."""
    rep = PT.page_report(PT.page_stats(i.page, i.active))
    from pyspark.sql import functions as F
    return PT.page_share(rep.where(F.col("version") != "all"))


@query("entry_pages", f"""WITH {TRANS_SQL}, {LEVELS_PV_SQL}, {ENTRY_SQL}
SELECT product_id, version, from_activity, count, percentage, CAST(rank AS INTEGER) AS rank
FROM en WHERE rank <= 5""")
def entry_pages(i: Inputs):
    """Top-5 entry pages per product and version with level-1 share."""
    lv = PT.page_levels(i.transitions, ["product_id", "version"])
    return PT.entry_pages(lv, ["product_id", "version"], 5)


@query("flow_edges", f"""WITH {TRANS_SQL}, {LEVELS_PV_SQL}, {ENTRY_SQL}
SELECT * FROM fe""")
def flow_edges(i: Inputs):
    """Flow edges with share of the (page, level) outflow."""
    lv = PT.page_levels(i.transitions, ["product_id", "version"])
    return PT.flow_edges(lv, ["product_id", "version"])


@query("path_tree", f"""WITH {TRANS_SQL}, {LEVELS_PV_SQL}, {ENTRY_SQL},
e0 AS (SELECT product_id, version, from_activity AS entry, count AS size, percentage AS probability
       FROM en WHERE rank <= 5),
fr AS (SELECT *, row_number() OVER (PARTITION BY product_id, version, from_activity, level
                                    ORDER BY count DESC, to_activity) AS r FROM fe),
f5 AS (SELECT * FROM fr WHERE r <= 5),
n1 AS (SELECT e0.product_id, e0.version, e0.entry, f.to_activity AS step1, f.count AS size,
         e0.probability * f.percentage AS probability
       FROM e0 JOIN f5 f ON f.product_id = e0.product_id AND f.version = e0.version
         AND f.from_activity = e0.entry AND f.level = 1),
n2 AS (SELECT n1.product_id, n1.version, n1.entry, n1.step1, f.to_activity AS step2, f.count AS size,
         n1.probability * f.percentage AS probability
       FROM n1 JOIN f5 f ON f.product_id = n1.product_id AND f.version = n1.version
         AND f.from_activity = n1.step1 AND f.level = 2),
n3 AS (SELECT n2.product_id, n2.version, n2.entry, n2.step1, n2.step2, f.to_activity AS step3,
         f.count AS size, n2.probability * f.percentage AS probability
       FROM n2 JOIN f5 f ON f.product_id = n2.product_id AND f.version = n2.version
         AND f.from_activity = n2.step2 AND f.level = 3)
SELECT product_id, version, 0 AS node_level, entry, NULL::VARCHAR AS step1, NULL::VARCHAR AS step2,
  NULL::VARCHAR AS step3, size, probability FROM e0
UNION ALL SELECT product_id, version, 1, entry, step1, NULL, NULL, size, probability FROM n1
UNION ALL SELECT product_id, version, 2, entry, step1, step2, NULL, size, probability FROM n2
UNION ALL SELECT product_id, version, 3, entry, step1, step2, step3, size, probability FROM n3""")
def path_tree(i: Inputs):
    """Path tree (5 entries x 5 children x 3 levels) with path
    probabilities, flattened to one row per node."""
    lv = PT.page_levels(i.transitions, ["product_id", "version"])
    return PT.path_tree(lv, ["product_id", "version"], 3, 5)
