"""Helpers shared by the operators: table access, staging, Arrow rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.session import ensure_checkpoint_dir

#: characters that separate words in the whitespace word rule
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's own switch to delete a query's shuffle files when the query has ended
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and reread it.

    Cuts the lineage: a lost executor costs a re-read of the files, and a
    later step never repeats the work before it.  The shuffle files of the
    write are not needed after it and go at once.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}_{uuid.uuid4().hex[:16]}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change other letters)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(c: Column) -> Column:
    """Whitespace words of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), f"{SPACE_CLASS}+"), "")


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts (0 for an empty table); sizes the buckets."""
    return docs.agg(F.sum(F.octet_length(F.col(column)).cast("long"))).first()[0] or 0


def has_repeated_ids(docs: DataFrame, column: str = "doc_id") -> bool:
    """Whether any id stands on more than one row (a plain key would then mix rows)."""
    return not docs.groupBy(column).count().where(F.col("count") > 1).isEmpty()
