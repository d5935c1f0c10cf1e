"""Ordered work within a device or session, split by time.

Rows are dealt once by (group, time bucket) and staged in that layout, so a
runaway group is spread over its buckets and the log is read once.  Local order
within a bucket is a window there; what crosses buckets is carried by one summary
row per bucket, windowed over the group and joined back in place.

A group is known by one text of its key columns, in which null differs from every
value: rows without a device or session form a group of their own.  Rows without
a time form the group's first bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.session import write_bucketed

#: bucket of rows without a time; before all others
NO_TIME = -(1 << 62)


def group_key(cols: list[str]) -> Column:
    """One text per combination of values, nulls included: each value with its length."""
    return F.concat_ws("|", *[F.when(F.col(c).isNull(), F.lit("n")).otherwise(
        F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"))) for c in cols])


def dealt(df: DataFrame, by: list[str], ts: str, bucket_seconds: int) -> DataFrame:
    """``df`` with ``_g`` (group), ``_us`` (time) and ``_b`` (bucket), dealt by group and bucket."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumns({"_g": group_key(by), "_us": us}) \
        .withColumn("_b", F.coalesce(F.floor(F.col("_us") / (bucket_seconds * 1_000_000)), F.lit(NO_TIME)).cast("long"))
    return rows.repartition(n, "_g", "_b")


def staged(rows: DataFrame, prefix: str) -> DataFrame:
    """Rows as dealt, staged by group and bucket."""
    return rows.sparkSession.table(write_bucketed(rows, ["_g", "_b"], prefix))
