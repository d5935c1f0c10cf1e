"""Corpus pipeline: documents in, shards of a cleaned mixture out.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  The runner writes each result as Parquet and hands the
reread table to the next stage.  All stages but the last return the columns of
``documents``; the last adds the shard of every row (struct ``placed``).

1. quality rules: documents that the rules reject go
2. SimHash near-dedup: one document of each group of near-duplicates stays
3. benchmark decontamination: documents that contain a test item go
4. mixing: documents are drawn for the target weights, once per epoch
5. sharding: every row gets its shard
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usagelens.llm import decontam, mixing, quality, sharding, simhash
from usagelens.llm.common import stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near their language's reference."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of fingerprints at most three bits apart."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn for the target weights, repeated once per further epoch."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture with the shard of every row."""
    return sharding.sharded_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mix", source_mix),
    ("sharding", shard),
]

#: the first stages score with fitted references and 64-bit XXH64 fingerprints, which DuckDB's SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are staged before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
