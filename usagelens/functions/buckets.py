"""Range buckets (L9, F10) and zero-filled histograms.

A bucket list is report configuration: (bucket_id, bucket, lo, hi) with None
for an open end.  It is known when the query is built, so a value's bucket is a
chain of comparisons inside the scan's own stage, with no join, and a
histogram is one conditional count per bucket in a single aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_bucket(v: Column, lo, hi, closed: str) -> Column:
    if closed not in ("left", "both"):
        raise ValueError(closed)
    above = v >= F.lit(lo)
    if hi is None:
        return above
    return above & (v < F.lit(hi) if closed == "left" else v <= F.lit(hi))


def bucketize(df: DataFrame, value_col: str, buckets: list[tuple], closed: str = "left") -> DataFrame:
    """Attach bucket_id/bucket to every row of ``df``; rows whose value lies in
    no bucket (below the first, or NULL) are dropped, as a range-join update
    leaves them unset.  ``closed``: 'left' for [lo, hi), 'both' for [lo, hi]."""
    hit = F.coalesce(*[F.when(in_bucket(F.col(value_col), lo, hi, closed),
                              F.struct(F.lit(k).alias("bucket_id"), F.lit(name).alias("bucket")))
                       for k, name, lo, hi in buckets])
    return df.withColumn("_b", hit).where("_b is not null").select(*df.columns, "_b.bucket_id", "_b.bucket")


def histogram(df: DataFrame, keys: list[str], value_col: str, buckets: list[tuple], out: str,
              closed: str = "left", also: dict[str, Column] | None = None) -> DataFrame:
    """Rows of ``df`` per key and bucket, 0 where none, every bucket listed.

    ``also`` adds further aggregates per key, repeated on the key's buckets.
    """
    cells = [F.struct(F.lit(k).alias("bucket_id"), F.lit(name).alias("bucket"),
                      F.count(F.when(in_bucket(F.col(value_col), lo, hi, closed), 1)).alias(out))
             for k, name, lo, hi in buckets]
    more = [c.alias(n) for n, c in (also or {}).items()]
    return (df.groupBy(*keys).agg(F.array(*cells).alias("_cells"), *more)
            .select(*keys, F.explode("_cells").alias("_c"), *[n for n in (also or {})])
            .select(*keys, "_c.*", *[n for n in (also or {})]))
