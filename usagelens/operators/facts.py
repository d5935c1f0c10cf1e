"""Fact loading (L1-L4): ingested rows joined to the product dimension on
natural keys, with the dimension flags carried along and unmatched rows
returned as rejects instead of silently vanishing.

The product dimension is registry-sized (apps x channels x versions), so the
join is a broadcast hash join chosen by Catalyst from its measured size; the
fact side is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM_KEYS = ["product_id", "channel_id", "version"]
FLAGS = ["product_active", "channel_active", "version_active"]


def tag_rows(rows: DataFrame, product_dim: DataFrame, keys: list[str] = DIM_KEYS) -> DataFrame:
    """All rows, read and joined once: ``known`` tells whether the dimension has
    their key, ``active`` is its activity flag (NULL where it has none)."""
    dim = product_dim.select(*keys, *FLAGS).dropDuplicates(keys).withColumn("_known", F.lit(True))
    return rows.join(dim, keys, "left").withColumns({
        "active": (F.col("product_active") == 1) & (F.col("channel_active") == 1) & (F.col("version_active") == 1),
        "known": F.col("_known").isNotNull()}).drop(*FLAGS, "_known")


def _attach(rows: DataFrame, product_dim: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    return _split(tag_rows(rows, product_dim, keys))


def _split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tagged.where("known").drop("known"), tagged.where("NOT known").drop("known", "active")


def build_launch_fact(rows: DataFrame, product_dim: DataFrame, t0=None, t1=None) -> tuple[DataFrame, DataFrame]:
    """L1: launch fact for the ingest window [t0, t1): day and hour of the
    (repaired) event time, the dimension's activity flag."""
    from usagelens.operators.ingest import read_increment
    if t0 is not None:
        rows = read_increment(rows, t0, t1)
    rows = rows.withColumns({"d": F.to_date("ts"), "h": F.hour("ts")})
    return _attach(rows, product_dim, DIM_KEYS)


def build_page_fact(rows: DataFrame, product_dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L2: page-view fact (flagless in the reports that read it)."""
    rows = rows.withColumn("d", F.to_date("start_ts"))
    return _attach(rows, product_dim, DIM_KEYS)


def build_crash_fact(rows: DataFrame, product_dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L3: crash fact with the brand/OS attributes kept as columns."""
    return _split(tag_day_rows(rows, product_dim))


def tag_day_rows(rows: DataFrame, product_dim: DataFrame) -> DataFrame:
    """The rows of the crash or custom-event fact and its rejects in one frame
    (:func:`tag_rows`): who needs both doesn't read the rows twice."""
    return tag_rows(rows.withColumn("d", F.to_date("ts")), product_dim)


def build_event_fact(rows: DataFrame, product_dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L4: custom-event fact."""
    return _split(tag_day_rows(rows, product_dim))
