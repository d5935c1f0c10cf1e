"""Spark session settings the operators are written against.

The library never creates a session on its own inside an operator; callers
(tests, bench, jobs) call :func:`get_session` once.  The settings below are the
ones every plan in this package assumes: ANSI on (Spark 4 default), UTC,
adaptive execution with skew-join splitting and partition coalescing, and the
size-checked broadcast threshold left to Catalyst/AQE (no unconditional
broadcast hints on data-derived inputs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only what the optimizer (static stats) or AQE (runtime
    # shuffle stats) has measured below this size; everything else shuffles
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "usagelens", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) the session with the package defaults.

    ``master`` defaults to ``local[*]`` only when nothing configured one
    (under spark-submit the launcher's ``spark.master`` is kept).
    """
    from pyspark import SparkConf

    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    elif not SparkConf().contains("spark.master") and "SPARK_MASTER" not in os.environ:
        builder = builder.master("local[*]")
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only in local mode
    (tests, bench) fall back to a fresh scratch folder."""
    try:
        sc = spark.sparkContext            # classic session
    except Exception:                      # noqa: BLE001 -- e.g. a Spark Connect session
        sc = None
    configured = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not str(master).startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="usagelens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None:
        sc.setCheckpointDir(path)
    return path


def files_state(spark: SparkSession, paths: list[str]) -> tuple:
    """Number, bytes and a digest of names, lengths and modification times of the
    files under ``paths``.  It changes when a file is rewritten in place.  Spark
    lists the files as rows (their content is not read) and folds them to one."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    one = F.xxhash64("path", "length", "modificationTime")
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(one)).first())


def spread(df: DataFrame) -> DataFrame:
    """A batch ``df`` read from files, dealt evenly over its partitions or the
    cluster's cores, whichever are more.  A file is split by its bytes but read by
    its row groups, so a few tasks may hold all rows whatever the splits."""
    return df.repartition(max(df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism))


def write_bucketed(df: DataFrame, keys: list[str], prefix: str = "stage") -> str:
    """Materialise ``df`` as an external parquet table bucketed (and sorted)
    by ``keys`` under the shared checkpoint folder, and return its name.

    This cuts lineage like a checkpoint (a lost executor costs a re-read, not
    a recompute), and the bucket spec tells the planner the data is already
    hash-partitioned by ``keys`` -- so later aggregates, windows and joins
    clustered on those keys run without another shuffle.  (A checkpoint under
    adaptive execution records an unknown partitioning and loses this.)
    Rows should arrive hash-partitioned by ``keys`` into as many partitions as
    buckets, so every task writes exactly one bucket file.
    """
    import uuid
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    name = f"{prefix}_{uuid.uuid4().hex[:16]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.mode("overwrite").format("parquet").bucketBy(n, *keys).sortBy(*keys)
     .option("path", f"{base}/tables/{name}").saveAsTable(name))
    return name


def drop_staged(spark: SparkSession, name: str) -> None:
    """Drop a table of :func:`write_bucketed` and delete its files."""
    path = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
