"""Page statistics, transitions and path reports.

Sessions are (product, session, day).  Page exits use ``max_by`` (a partial
aggregate).  Everything after the transitions works on small summary tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.ratios import ratio
from usagelens.operators import runs
from usagelens.operators.kpis import only_active

ENTRY_KEYS = ["product_id", "channel_id", "version"]
EXIT = "Exit"  # fixed value: target of a session's last page


def page_exits(pages: DataFrame) -> DataFrame:
    """Last page of each (product, session, day) by end time, ties to the
    greater view id: (entry keys, d, activity) rows."""
    last = (pages.groupBy("product_id", "session_id", "d")
            .agg(F.max_by(F.struct("channel_id", "version", "activity"),
                          F.struct("end_ts", "view_id")).alias("_l")))
    return last.select("product_id", F.col("_l.channel_id").alias("channel_id"),
                       F.col("_l.version").alias("version"), "d",
                       F.col("_l.activity").alias("activity"))


def page_stats(pages: DataFrame, active: DataFrame | None) -> DataFrame:
    """K9 + K10 per (entry, day, activity): accesscount and totaltime over
    active entries, exitcount over all sessions."""
    keys = [*ENTRY_KEYS, "d", "activity"]
    views = (only_active(pages, active).groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("accesscount"), F.sum("duration_ms").alias("totaltime")))
    exits = page_exits(pages).groupBy(*keys).agg(F.count(F.lit(1)).alias("exitcount"))
    u = views.unionByName(exits, allowMissingColumns=True)
    return u.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
          for c in ("accesscount", "totaltime", "exitcount")])


def transitions(pages: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """(entry, d, from, to, jump, count).  Within a session-day ordered
    by (start, id), the k-th view leads to the next one with jump k; the last
    view leads to ``Exit``.

    Every view counts once.  Views without a session (or day) are one session
    of their product and day; views without a start come first in theirs.

    Skew-proof (``operators.runs``), one read and one shuffle of the views,
    which are staged: ``lead``/``row_number`` run inside (session, day, time
    bucket); one summary row per bucket (row count, first page) carries the
    order across buckets -- jump = rows in earlier buckets + local position,
    and a bucket's last page leads to the next bucket's first page -- so even a
    runaway session is spread over its buckets instead of one task.
    """
    need = list(dict.fromkeys([*ENTRY_KEYS, "session_id", "d", "start_ts", "view_id", "activity"]))
    rows = runs.dealt(pages.select(*need), ["product_id", "session_id", "d"], "start_ts", bucket_seconds)
    local = Window.partitionBy("_g", "_b").orderBy("start_ts", "view_id")
    # a page without a name is a page: its struct is there where the row is
    page = F.struct("activity")
    rows = rows.withColumns({"_rn": F.row_number().over(local), "_next": F.lead(page).over(local)})
    rows = runs.staged(rows.drop("session_id", "start_ts", "view_id", "_us"), "views")
    buckets = rows.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_cnt"), F.min_by(page, "_rn").alias("_first"))
    over = Window.partitionBy("_g").orderBy("_b")
    buckets = buckets.select("_g", "_b", F.coalesce(F.sum("_cnt").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                             F.lead("_first").over(over).alias("_next_first"))
    to = F.coalesce("_next", "_next_first")
    edges = rows.join(buckets, ["_g", "_b"]).select(
        *ENTRY_KEYS, "d", F.col("activity").alias("from_activity"),
        F.when(to.isNull(), F.lit(EXIT)).otherwise(to["activity"]).alias("to_activity"),
        (F.col("_before") + F.col("_rn")).cast("int").alias("jump"))
    return (edges.groupBy(*ENTRY_KEYS, "d", "from_activity", "to_activity", "jump")
            .agg(F.count(F.lit(1)).alias("count")))


def page_levels(trans: DataFrame, by: list[str] = ENTRY_KEYS) -> DataFrame:
    """level = smallest jump of an edge, count summed, over the range
    the transitions cover."""
    return (trans.groupBy(*by, "from_activity", "to_activity")
            .agg(F.min("jump").alias("level"), F.sum("count").cast("bigint").alias("count")))


def page_report(stats: DataFrame, by_version: bool = True) -> DataFrame:
    """Per product and activity, by version and over all versions
    ('all'): views, average time (ms), exits."""
    g = stats.groupingSets([["product_id", "version", "activity"], ["product_id", "activity"]],
                           "product_id", "version", "activity")
    agg = g.agg(F.sum("accesscount").alias("views"), F.sum("totaltime").alias("totaltime"),
                F.sum("exitcount").alias("exits"), F.grouping("version").alias("_gv"))
    return agg.select("product_id",
                      F.when(F.col("_gv") == 1, F.lit("all")).otherwise(F.col("version")).alias("version"),
                      "activity", F.col("views").cast("bigint").alias("views"),
                      F.col("totaltime").cast("bigint").alias("totaltime"),
                      ratio(F.col("totaltime"), F.col("views")).alias("avg_time_ms"),
                      F.col("exits").cast("bigint").alias("exits"))


def page_share(report: DataFrame) -> DataFrame:
    """Share of each page in its (product, version) total of views, time
    and exits."""
    w = Window.partitionBy("product_id", "version")
    return report.select(
        "product_id", "version", "activity",
        ratio(F.col("views"), F.sum("views").over(w)).alias("views_share"),
        ratio(F.col("totaltime"), F.sum("totaltime").over(w)).alias("time_share"),
        ratio(F.col("exits"), F.sum("exits").over(w)).alias("exits_share"))


def entry_pages(levels: DataFrame, by: list[str] = ("product_id", "version"), n: int = 5) -> DataFrame:
    """Level-1 sources ranked by count (ties by name), top ``n`` per key,
    with their share of the level-1 total."""
    by = list(by)
    e = (levels.where(F.col("level") == 1).groupBy(*by, "from_activity")
         .agg(F.sum("count").alias("count")))
    tot = Window.partitionBy(*by)
    rk = Window.partitionBy(*by).orderBy(F.col("count").desc(), "from_activity")
    return (e.select(*by, "from_activity", F.col("count").cast("bigint").alias("count"),
                     ratio(F.col("count"), F.sum("count").over(tot)).alias("percentage"),
                     F.row_number().over(rk).alias("rank"))
            .where(F.col("rank") <= n))


def flow_edges(levels: DataFrame, by: list[str] = ("product_id", "version")) -> DataFrame:
    """(from, to, level, count, share of the (from, level) outflow)."""
    by = list(by)
    e = levels.groupBy(*by, "from_activity", "to_activity", "level").agg(F.sum("count").alias("count"))
    w = Window.partitionBy(*by, "from_activity", "level")
    return e.select(*by, "from_activity", "to_activity", "level",
                    F.col("count").cast("bigint").alias("count"),
                    ratio(F.col("count"), F.sum("count").over(w)).alias("percentage"))


def path_tree(levels: DataFrame, by: list[str] = ("product_id", "version"), depth: int = 3,
              width: int = 5) -> DataFrame:
    """Top ``width`` entries, then up to ``width`` children per node on
    ``depth`` levels (a level-k child is a level-k edge leaving the parent's
    page).  One row per node: (keys, node_level, entry, step1..step<depth>,
    size, probability = product of shares along the path)."""
    by = list(by)
    entries = entry_pages(levels, by, width).select(
        *by, F.col("from_activity").alias("entry"), F.col("count").alias("size"),
        F.col("percentage").alias("probability"))
    edges = flow_edges(levels, by)
    rk = Window.partitionBy(*by, "from_activity", "level").orderBy(F.col("count").desc(), "to_activity")
    edges = edges.withColumn("_r", F.row_number().over(rk)).where(F.col("_r") <= width)
    steps = [f"step{k}" for k in range(1, depth + 1)]
    nodes = [entries.select(*by, F.lit(0).alias("node_level"), "entry",
                            *[F.lit(None).cast("string").alias(s) for s in steps],
                            "size", "probability")]
    frontier = entries.select(*by, "entry", F.col("entry").alias("_at"), "probability")
    prev_steps: list[str] = []
    for k in range(1, depth + 1):
        lvl = edges.where(F.col("level") == k).select(
            *by, F.col("from_activity").alias("_at"), F.col("to_activity").alias(f"step{k}"),
            F.col("count").alias("size"), F.col("percentage").alias("_p"))
        nxt = (frontier.join(lvl, [*by, "_at"])
               .withColumn("probability", F.col("probability") * F.col("_p")))
        nodes.append(nxt.select(*by, F.lit(k).alias("node_level"), "entry",
                                *[F.col(s) if s in prev_steps + [f"step{k}"] else
                                  F.lit(None).cast("string").alias(s) for s in steps],
                                "size", "probability"))
        prev_steps.append(f"step{k}")
        frontier = nxt.select(*by, "entry", *prev_steps, F.col(f"step{k}").alias("_at"), "probability")
    return reduce(lambda a, b: a.unionByName(b), nodes)
