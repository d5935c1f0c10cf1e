"""New-user flags and daily/hourly KPIs.

Plan shape (see README "Scale notes"):

* ``launch_rollup`` aggregates the raw launch log once to one row per
  (product, channel, version, device, day, hour) with the launch count and
  the smallest launch id.  It is a partial (map-side) aggregate, so a hot
  product or device shrinks to one row per task before the shuffle.  Every
  KPI below reads the rollup; when several branches of one plan read it the
  exchange is reused, so the raw fact is scanned once.
* first launch per (product[, channel], device) is ``min(struct(day, id,
  ...))`` -- another partial aggregate, instead of a row_number window over
  the raw fact (a window cannot pre-aggregate and would put a hot device in
  one task).
* the upgrade test needs "smallest version on an earlier day": a range-frame
  window over the per-device-day rows (at most days x versions rows per
  device).
* KPI components are unioned and summed in one final aggregate (no chain of
  outer joins), then running totals are a window per grain key over the
  small daily summary.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.calendar import day_number

GRAIN_KEYS = {
    "product": ["product_id"],
    "channel": ["product_id", "channel_id"],
    "version": ["product_id", "version"],
}
# scope of "new" and "upgrade": the channel grain counts new per channel
GRAIN_SCOPE = {
    "product": ["product_id"],
    "channel": ["product_id", "channel_id"],
    "version": ["product_id"],
}


def normalize_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """F9 switch: compare text keys case- and trailing-space-insensitively
    (the reference's collation) by normalising them once at load time.  Off
    by default; ``spark.sql`` users can use the UTF8_LCASE collation instead."""
    return df.withColumns({c: F.lower(F.rtrim(F.col(c))) for c in cols})


def only_active(df: DataFrame, active: DataFrame | None, keys: list[str] | None = None) -> DataFrame:
    """Keep rows whose ``keys`` (default: all columns of ``active``) are active
    in the registry (semi join against a registry-sized table: broadcast by
    measured size).  Rows that lack a key can't be judged, so that raises."""
    if active is None:
        return df
    keys = list(active.columns) if keys is None else list(keys)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"rows have no {', '.join(missing)} to test against the active registry")
    return df.join(active, keys, "left_semi")


def launch_rollup(launch: DataFrame) -> DataFrame:
    """Device-hour rollup of the launch log (partial aggregate)."""
    return (launch.groupBy("product_id", "channel_id", "version", "device_id", "d", "h")
            .agg(F.count(F.lit(1)).alias("n"), F.min("launch_id").alias("first_id")))


def device_partitioned(launch: DataFrame) -> DataFrame:
    """The rollup, hash-partitioned by (product, device).

    The rollup already bounds a device to one row per hour, version and
    channel, so this second shuffle moves little data even for a hot device,
    and every per-device step after it (first launch, the upgrade window,
    device-day sums, the first-day join) finds its input clustered and needs
    no further exchange.  The partition count is explicit (the session's
    shuffle partitions) so adaptive coalescing leaves the hash partitioning
    intact and a checkpoint of it keeps it."""
    n = int(launch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return launch_rollup(launch).repartition(n, "product_id", "device_id")


def first_launch(rollup: DataFrame, scope: list[str]) -> DataFrame:
    """First launch of each device within ``scope`` ordered by (day, id).

    Returns scope + device_id + d, first_id, channel_id, version, h of that
    launch.
    """
    keep = [c for c in ("d", "first_id", "channel_id", "version", "h")
            if c not in scope and c in rollup.columns]
    f = (rollup.groupBy(*scope, "device_id")
         .agg(F.min(F.struct(*keep)).alias("_f")))
    return f.select(*scope, "device_id", *[F.col(f"_f.{c}").alias(c) for c in keep])


def flag_new(launch: DataFrame, scope: list[str] = ("product_id",), flag: str = "is_new") -> DataFrame:
    """1 on the first launch row of a device within ``scope`` ordered by
    (day, launch id), else 0.

    Join-back form: the first-launch table is a partial aggregate keyed by
    (scope, device); the join to the fact is a sort-merge join on the same key
    that AQE can split when one device is hot.
    """
    scope = list(scope)
    firsts = (launch.groupBy(*scope, "device_id")
              .agg(F.min(F.struct("d", "launch_id")).getField("launch_id").alias("_first")))
    return (launch.join(firsts, [*scope, "device_id"], "left")
            .withColumn(flag, (F.col("launch_id") == F.col("_first")).cast("int"))
            .drop("_first"))


def _running(df: DataFrame, keys: list[str], src: str, dst: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(dst, F.sum(src).over(w))


def version_key(v, order: str = "lexicographic"):
    """Comparable form of a version string: the string itself (the
    reference's STRCMP: '1.10' < '1.9'), or with ``order='natural'`` the
    array of its numeric parts ('1.10' > '1.9'; non-numeric parts compare as
    NULL, i.e. lowest)."""
    if order == "lexicographic":
        return v
    if order == "natural":
        return F.transform(F.split(v, r"\."), lambda p: p.try_cast("int"))
    raise ValueError(order)


def upgrade_rows(rollup_active: DataFrame, scope: list[str], grain_keys: list[str],
                 version_order: str = "lexicographic") -> DataFrame:
    """K5: (grain keys, d, device_id) of devices seen on ``d`` in a version
    greater than a version they used on an earlier day within ``scope``
    (string order by default, see ``version_key``)."""
    cols = sorted(set(scope) | set(grain_keys) | {"version"})
    t = rollup_active.select(*cols, "device_id", "d").distinct()
    t = t.withColumn("_vk", version_key(F.col("version"), version_order))
    w = (Window.partitionBy(*scope, "device_id").orderBy(day_number(F.col("d")))
         .rangeBetween(Window.unboundedPreceding, -1))
    t = t.withColumn("_prev_min", F.min("_vk").over(w))
    return (t.where(F.col("_prev_min") < F.col("_vk"))
            .select(*grain_keys, "d", "device_id").distinct())


def daily_kpis(launch: DataFrame, pages: DataFrame | None, active: DataFrame | None,
               grain: str = "product", rollup: DataFrame | None = None,
               version_order: str = "lexicographic") -> DataFrame:
    """K1-K3, K5-K8 at one grain: (keys, d, sessions, startusers, newusers,
    upgradeusers, allusers, allsessions, usingtime).

    sessions/startusers/usingtime are flagless; newusers/upgradeusers count
    rows in active registry entries only.

    Device-level facts -- (keys, device, day) with its launch count, the
    (scope, device) first launch, the (keys, device, day) upgrade marks --
    are computed where the rollup is clustered by device, unioned with the
    page durations and counted by ONE (keys, day) aggregate: a single shuffle
    of pre-aggregated rows, then the running totals.
    """
    keys = GRAIN_KEYS[grain]
    scope = GRAIN_SCOPE[grain]
    r = rollup if rollup is not None else launch_rollup(launch)

    dev_day = (r.groupBy(*keys, "device_id", "d").agg(F.sum("n").alias("sessions"))
               .withColumn("startusers", F.lit(1)))
    new = only_active(first_launch(r, scope), active).select(*keys, "d", F.lit(1).alias("newusers"))
    upg = (upgrade_rows(only_active(r, active), scope, keys, version_order)
           .select(*keys, "d", F.lit(1).alias("upgradeusers")))
    parts = [dev_day.drop("device_id"), new, upg]
    metrics = ["sessions", "startusers", "newusers", "upgradeusers"]
    if pages is not None:
        parts.append(pages.select(*keys, "d", F.col("duration_ms").alias("usingtime")))
        metrics.append("usingtime")
    u = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    out = u.groupBy(*keys, "d").agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in metrics])
    if pages is None:
        out = out.withColumn("usingtime", F.lit(0).cast("bigint"))
    out = _running(out, keys, "newusers", "allusers")
    out = _running(out, keys, "sessions", "allsessions")
    return out.select(*keys, "d", "sessions", "startusers", "newusers", "upgradeusers",
                      "allusers", "allsessions", "usingtime")


def hourly_kpis(launch: DataFrame, active: DataFrame | None, rollup: DataFrame | None = None) -> DataFrame:
    """K1, K2, K4 by (product, channel, version, d, h).

    newusers (K4) = distinct devices in active entries with no active launch
    of the product on an earlier day; a device counts in every hour and
    entry it is seen in on its first day.  The first day is a window minimum
    over the device's rollup rows (clustered by device, no shuffle when the
    rollup is the bucketed one); launches, actives and new marks are counted
    by one aggregate.
    """
    keys = ["product_id", "channel_id", "version", "d", "h"]
    r = rollup if rollup is not None else launch_rollup(launch)
    base = r.select(*keys, F.col("n").alias("sessions"), F.lit(1).alias("startusers"))
    ra = only_active(r, active)
    first_day = F.min("d").over(Window.partitionBy("product_id", "device_id"))
    new = (ra.withColumn("_fd", first_day).where(F.col("d") == F.col("_fd"))
           .select(*keys, F.lit(1).alias("newusers")))
    u = base.unionByName(new, allowMissingColumns=True)
    return u.groupBy(*keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m)
                                  for m in ("sessions", "startusers", "newusers")])


def page_rollup(pages: DataFrame) -> DataFrame:
    """Page time per (product, channel, version, day)."""
    return pages.groupBy(*GRAIN_KEYS["channel"], "version", "d").agg(F.sum("duration_ms").alias("duration_ms"))


def session_daily(pages: DataFrame) -> DataFrame:
    """Total duration per (product, channel, version, day, session)."""
    return (pages.groupBy("product_id", "channel_id", "version", "d", "session_id")
            .agg(F.sum("duration_ms").alias("duration_ms")))


def launch_histogram(launch: DataFrame, buckets: list[tuple], rollup: DataFrame | None = None) -> DataFrame:
    """Devices per launch-count bucket per (product entry, day), zero
    filled for every bucket of every (entry, day) that has launches.

    ``buckets`` is the bucket configuration [(id, name, lo, hi|None)]; each
    bucket is one conditional count of the same aggregate.
    """
    from usagelens.functions.buckets import histogram
    keys = ["product_id", "channel_id", "version", "d"]
    r = rollup if rollup is not None else launch_rollup(launch)
    per_dev = r.groupBy(*keys, "device_id").agg(F.sum("n").alias("times"))
    return histogram(per_dev, keys, "times", buckets, "devices", "both")
