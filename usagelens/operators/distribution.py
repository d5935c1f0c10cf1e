"""Device distributions by attribute and engagement histograms.

Shared core ``distribution``: distinct devices per attribute value divided by
a per-attribute denominator, ranked with a name tie-break, optionally cut to
the top N per key.  Distinct counting is two partial aggregates
((key, value, device) then (key, value)); the 'pairs' denominator is the sum
of the numerators over a window on the small result, so the fact is not
re-read for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.buckets import histogram, in_bucket
from usagelens.functions.ratios import pct_round, ratio
from usagelens.operators.kpis import only_active

# Share denominator per attribute -- 'pairs' = distinct
# (device, value) pairs (shares sum to 1); 'devices' = distinct devices (a
# device seen with two values counts in both numerators, so shares may sum
# above 1) -- and the display label of a blank attribute.
DEFAULT_DENOM = {"brand": "pairs", "os": "devices", "carrier": "pairs", "network": "pairs",
                 "resolution": "devices", "country": "pairs", "region": "pairs"}
UNKNOWN = "unknown"


def in_range(df: DataFrame, a=None, b=None, col: str = "d") -> DataFrame:
    if a is not None:
        df = df.where(F.col(col) >= F.lit(a).cast("date"))
    if b is not None:
        df = df.where(F.col(col) <= F.lit(b).cast("date"))
    return df


def new_rows(launch: DataFrame, attrs: list[str]) -> DataFrame:
    """The new-user (first launch per product) rows with the given
    attributes: a partial ``min(struct(d, id, ...))`` aggregate."""
    keep = [c for c in attrs if c not in ("product_id", "device_id")]
    keep = list(dict.fromkeys(["channel_id", *keep]))
    f = (launch.groupBy("product_id", "device_id")
         .agg(F.min(F.struct("d", "launch_id", *keep)).alias("_f")))
    return f.select("product_id", "device_id", F.col("_f.d").alias("d"),
                    *[F.col(f"_f.{c}").alias(c) for c in keep])


def distribution(launch: DataFrame, attr: str, active: DataFrame | None = None, new_only: bool = False,
                 top_n: int | None = None, denom: str | None = None, by: list[str] = ("product_id",),
                 a=None, b=None, numerator_flagless: bool = False) -> DataFrame:
    """(by, attr, devices, percentage, rank) -- see module doc."""
    by = list(by)
    denom = denom or DEFAULT_DENOM.get(attr, "pairs")
    src = new_rows(launch, [*by, attr]) if new_only else launch
    rows = in_range(src, a, b)
    den_rows = only_active(rows, active)
    num_rows = rows if numerator_flagless else den_rows
    num = (num_rows.select(*by, attr, "device_id").distinct()
           .groupBy(*by, attr).agg(F.count(F.lit(1)).alias("devices")))
    w = Window.partitionBy(*by)
    if denom == "pairs" and not numerator_flagless:
        out = num.withColumn("_den", F.sum("devices").over(w))
    else:
        if denom == "pairs":
            den = (den_rows.select(*by, attr, "device_id").distinct()
                   .groupBy(*by).agg(F.count(F.lit(1)).alias("_den")))
        else:
            den = (den_rows.select(*by, "device_id").distinct()
                   .groupBy(*by).agg(F.count(F.lit(1)).alias("_den")))
        out = num.join(den, by, "left")
    rk = Window.partitionBy(*by).orderBy(F.col("devices").desc(), F.col(attr))
    out = out.select(*by, attr, F.col("devices").cast("bigint").alias("devices"),
                     F.col("_den").cast("bigint").alias("total"),
                     ratio(F.col("devices"), F.col("_den")).alias("percentage"),
                     F.row_number().over(rk).alias("rank"))
    if top_n is not None:
        out = out.where(F.col("rank") <= top_n)
    return out


def distinct_count(launch: DataFrame, cols: list[str], active: DataFrame | None = None,
                   by: list[str] = ("product_id",), a=None, b=None, out: str = "n") -> DataFrame:
    """Number of distinct values (tuples) of ``cols`` per key."""
    by = list(by)
    rows = only_active(in_range(launch, a, b), active)
    return (rows.select(*by, *cols).distinct().groupBy(*by)
            .agg(F.count(F.lit(1)).cast("bigint").alias(out)))


def label_unknown(c: Column) -> Column:
    """Blank attribute values display as 'unknown'."""
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(UNKNOWN)).otherwise(c)


def tenths(num: Column, den: Column) -> Column:
    """round_half_up(num / den * 1000) as an exact integer count of 0.1 %."""
    return F.when(den > 0, (pct_round(num, den, 1) * 10).cast("bigint"))


def with_others(dist: DataFrame, attr: str, by: list[str] = ("product_id",),
                others: str = "others") -> DataFrame:
    """Shares rounded to 0.1 % plus an 'others' row holding the
    remainder up to 100 % when the listed rows sum below it.

    ``dist`` needs (by, attr, devices, total); the rounding is done on the
    exact ratio in integer tenths of a percent, so the remainder is exact.
    """
    by = list(by)
    t = dist.select(*by, label_unknown(F.col(attr)).alias(attr),
                    tenths(F.col("devices"), F.col("total")).alias("_t"))
    rest = (t.groupBy(*by).agg(F.sum("_t").alias("_s"))
            .where(F.col("_s") < 1000)
            .select(*by, F.lit(others).alias(attr), (F.lit(1000) - F.col("_s")).alias("_t")))
    return t.unionByName(rest).select(*by, attr, (F.col("_t") / 10.0).alias("percent"))


# ---------------------------------------------------------------------------
# engagement histograms
# ---------------------------------------------------------------------------

def usage_histogram(pages: DataFrame, buckets: list[tuple], active: DataFrame | None = None,
                    by: list[str] = ("product_id",), a=None, b=None) -> DataFrame:
    """Daily session totals per session-length bucket ([lo, hi) ms): all
    sessions in the numerator, sessions of active entries in the denominator;
    every configured bucket is listed.  One pass over the sessions."""
    by = list(by)
    sess = (in_range(pages, a, b)
            .groupBy("product_id", "channel_id", "version", "d", "session_id")
            .agg(F.sum("duration_ms").alias("duration_ms")))
    if active is None:
        sess = sess.withColumn("_on", F.lit(True))
    else:
        sess = sess.join(active.withColumn("_on", F.lit(True)), active.columns, "left")
    # of a key without active sessions there is no share
    out = histogram(sess, by, "duration_ms", buckets, "sessions", "left",
                    {"_den": F.nullif(F.count("_on"), F.lit(0))})
    return out.select(*by, "bucket_id", "bucket", "sessions", ratio(F.col("sessions"), F.col("_den")).alias("percentage"))


def frequency_histogram(launch: DataFrame, buckets: list[tuple], active: DataFrame | None = None,
                        by: list[str] = ("product_id",), a=None, b=None) -> DataFrame:
    """Device-days per launch-count bucket (closed ranges) over active
    entries, with the share of the total; every configured bucket listed."""
    by = list(by)
    per_dev = (only_active(in_range(launch, a, b), active)
               .groupBy("product_id", "channel_id", "version", "d", "device_id").agg(F.count(F.lit(1)).alias("times")))
    out = histogram(per_dev, by, "times", buckets, "access", "both", {"_all": F.count(F.when(
        F.coalesce(*[F.when(in_bucket(F.col("times"), lo, hi, "both"), 1) for _, _, lo, hi in buckets]) == 1, 1))})
    return out.select(*by, "bucket_id", "bucket", "access", ratio(F.col("access"), F.col("_all")).alias("percentage"))
