"""Hourly increments as deltas.

Every micro-batch is one pass over its rows: they are landed with a mark for
those behind the watermark (W2), and from there reduced to a delta of the launch
rollup.  A day's state is its compacted rows and the deltas since; nothing is
summed anew from raw rows.

::

    path/rows/epoch=<id>/late=<bool>    landed rows
    path/journal/epoch=<id>             rows on time and late, largest event time
    path/deltas/epoch=<id>/d=<day>      rollup of the batch's rows on time
    path/base/d=<day>                   compacted days, ``through`` which epoch
    path/summary/d=<day>                result, replaced for the days touched

Each write replaces its own epoch or days, so a replayed batch leaves the same
files.  The days of a batch stay a DataFrame and prune partitions as a dynamic
filter; the driver sees one journal row.  A delta counts only where the day's
base doesn't hold its epoch yet, so a job that stops between the steps of a
compaction counts nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from usagelens.operators.first_index import on_days
from usagelens.operators.kpis import launch_rollup
from usagelens.streaming.jobs import LATE_HORIZON, _ntz, _start

ROLLUP_KEYS = ["product_id", "channel_id", "version", "device_id", "d", "h"]
#: deltas that a day's reader merges at most before they are compacted
COMPACT_EVERY = 16


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def land(batch: DataFrame, epoch: int, path: str, horizon: str = LATE_HORIZON) -> DataFrame:
    """Land the batch, split by the watermark as it stood before; the rows on time.

    The watermark is the largest event time of earlier epochs less the horizon.
    A row without event time is on time.  One write and one count of raw rows:
    ``on_time + late`` of the journal is the input, exactly.
    """
    spark = batch.sparkSession
    seen = None
    if _exists(spark, f"{path}/journal"):
        seen = spark.read.parquet(f"{path}/journal").where(F.col("batch") < epoch).agg(F.max("max_ts")).first()[0]
    late = F.lit(False) if seen is None else F.coalesce(F.col("ts") <= F.lit(seen) - F.expr(f"INTERVAL {horizon}"), F.lit(False))
    obs = Observation(f"land-{epoch}")
    marked = batch.withColumn("late", late).observe(
        obs, F.count(F.when(~F.col("late"), 1)).alias("on_time"), F.count(F.when(F.col("late"), 1)).alias("late"), F.max("ts").alias("max_ts"))
    marked.write.mode("overwrite").partitionBy("late").parquet(f"{path}/rows/epoch={epoch}")
    got = obs.get
    spark.createDataFrame([(epoch, got["on_time"], got["late"], got["max_ts"])],
                          f"batch long, on_time long, late long, max_ts {batch.schema['ts'].dataType.simpleString()}") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/journal/epoch={epoch}")
    return landed(spark, path, False, batch.schema, epoch)


def landed(spark: SparkSession, path: str, late: bool, schema, epoch: int | None = None) -> DataFrame:
    """Landed rows, on time or late, of one epoch or all."""
    at = f"{path}/rows/epoch={epoch}" if epoch is not None else f"{path}/rows"
    full = spark.read.schema(", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "late boolean"])).parquet(at)
    return full.where(F.col("late") == late).select(*schema.names)


def merged(rollups: DataFrame) -> DataFrame:
    """Rollup rows of any number of deltas as one row per key."""
    return rollups.groupBy(*ROLLUP_KEYS).agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"))


def daily_summary(rollup: DataFrame) -> DataFrame:
    """Launches and distinct devices per product and day of a rollup."""
    device_day = rollup.groupBy("product_id", "d", "device_id").agg(F.sum("n").alias("n"))
    return device_day.groupBy("product_id", "d").agg(F.sum("n").cast("bigint").alias("launches"),
                                                     F.count("device_id").cast("bigint").alias("devices"))


class IncrementJob:
    """One delta per micro-batch, summaries of the days it touches, compaction now and then."""

    def __init__(self, spark: SparkSession, path: str, summarize: Callable[[DataFrame], DataFrame] = daily_summary,
                 horizon: str = LATE_HORIZON, compact_every: int = COMPACT_EVERY):
        self.spark, self.path, self.summarize, self.horizon, self.every = spark, path, summarize, horizon, compact_every
        self.kinds: T.StructType | None = None        # of the deltas; known after the first merge

    def _deltas(self, first: int, last: int) -> DataFrame | None:
        """The deltas of these epochs, with their ``epoch``; a batch without rows has an empty one."""
        live = [f"{self.path}/deltas/epoch={e}" for e in range(first, last + 1) if _exists(self.spark, f"{self.path}/deltas/epoch={e}")]
        if not live:
            return None
        if self.kinds is None:
            self.kinds = self.spark.read.option("basePath", f"{self.path}/deltas").parquet(*live).schema
        return self.spark.read.schema(self.kinds).option("basePath", f"{self.path}/deltas").parquet(*live)

    def _compacted(self) -> int:
        """Epoch that all days' base goes through at least."""
        at = f"{self.path}/compactions"
        return self.spark.read.parquet(at).agg(F.max("through")).first()[0] if _exists(self.spark, at) else -1

    def rollup(self, upto: int, days: DataFrame | None = None) -> DataFrame:
        """The rollup of all epochs to ``upto``, of the given days only if any."""
        rows = self._deltas(self._compacted() + 1, upto)
        rows = rows if days is None or rows is None else on_days(rows, days)
        base = f"{self.path}/base"
        if not _exists(self.spark, base):
            return merged(rows.drop("epoch"))
        held = self.spark.read.parquet(base)
        held = held if days is None else on_days(held, days)
        if rows is None:
            return merged(held.drop("through"))
        through = held.groupBy("d").agg(F.max("through").alias("through")).withColumnRenamed("d", "_d")
        rows = rows.join(through, F.col("d").eqNullSafe(F.col("_d")), "left") \
            .where(F.col("epoch") > F.coalesce("through", F.lit(-1))).drop("_d", "through")
        rows = rows.drop("epoch").unionByName(held.drop("through"))
        return merged(rows)

    def take(self, batch: DataFrame, epoch: int) -> None:
        """Land one micro-batch and bring the days of its rows on time up to date."""
        self.merge(land(batch, epoch, self.path, self.horizon), epoch)

    def merge(self, rows: DataFrame, epoch: int) -> None:
        """Take up rows as the delta of this epoch."""
        delta = launch_rollup(rows)
        delta.write.mode("overwrite").partitionBy("d").parquet(f"{self.path}/deltas/epoch={epoch}")
        self.kinds = T.StructType([*delta.schema.fields, T.StructField("epoch", T.LongType())])
        mine = self._deltas(epoch, epoch)
        days = mine.select(F.col("d").alias("_day")).distinct()
        self._replace(self.summarize(self.rollup(epoch, days)), "summary")
        if (epoch + 1) % self.every == 0:
            self.compact(epoch)

    def _replace(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(f"{self.path}/{name}")

    def compact(self, epoch: int) -> None:
        """Merge the deltas to ``epoch`` into their days' base."""
        live = self._deltas(self._compacted() + 1, epoch)
        if live is None:
            return
        days = live.select(F.col("d").alias("_day")).distinct()
        staged = f"{self.path}/compacting/epoch={epoch}"
        self.rollup(epoch, days).withColumn("through", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(staged)
        self._replace(self.spark.read.parquet(staged), "base")
        self.spark.createDataFrame([(epoch,)], "through long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/compactions/epoch={epoch}")

    def repair(self, schema, epoch: int) -> DataFrame:
        """Take up all late rows landed so far as one more delta; these rows."""
        late = landed(self.spark, self.path, True, schema)
        self.merge(late, epoch)
        return late

    def journal(self) -> DataFrame:
        """batch, on_time, late, max_ts: one row per micro-batch."""
        return self.spark.read.parquet(f"{self.path}/journal").select("batch", "on_time", "late", "max_ts")

    def summary(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/summary")

    def start(self, rows: DataFrame, checkpoint: str, trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
        """Run over a stream of launches (the rollup's columns, launch_id and ts)."""
        writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, epoch: self.take(batch, epoch))
        return _start(writer, trigger, available_now)


# ---------------------------------------------------------------------------
# Rolling actives from mergeable sketches
# ---------------------------------------------------------------------------

#: precision of the distinct-count sketches: 2**14 registers, a standard error of 0.8 %
SKETCH_PRECISION = 14
SKETCH_ERROR = 0.0081


def day_sketches(rows: DataFrame, precision: int = SKETCH_PRECISION) -> DataFrame:
    """One distinct-count sketch of devices per product and day."""
    return rows.groupBy("product_id", "d").agg(F.hll_sketch_agg("device_id", precision).alias("devices"))


def sketch_job(rows: DataFrame, path: str, checkpoint: str, precision: int = SKETCH_PRECISION,
               trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Each micro-batch adds the sketches of its own rows; they merge when read."""
    def take(batch: DataFrame, epoch: int) -> None:
        day_sketches(batch, precision).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    return _start(rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take), trigger, available_now)


def rolling_actives(sketches: DataFrame, days: int) -> DataFrame:
    """Estimated distinct devices of the ``days`` days that end at each day with launches.

    Every (day, sketch) goes to the window ends it counts for; sketches unite in
    a partial aggregate, so a hot product is merged where its rows lie.
    """
    per_day = sketches.where("d is not null").groupBy("product_id", "d").agg(F.hll_union_agg("devices").alias("devices"))
    ends = per_day.select("product_id", F.explode(F.sequence(F.col("d"), F.date_add("d", days - 1))).alias("end"), "devices")
    united = ends.groupBy("product_id", "end").agg(F.hll_sketch_estimate(F.hll_union_agg("devices")).cast("bigint").alias("actives"))
    return united.join(per_day.select("product_id", F.col("d").alias("end")), ["product_id", "end"], "left_semi") \
        .select("product_id", F.col("end").alias("d"), "actives")


def exact_rolling_actives(rows: DataFrame, days: int) -> DataFrame:
    """Exact distinct devices of the same windows, from the raw log: each device
    counts for every day from a visit to ``days - 1`` days after it, once."""
    seen = rows.where("d is not null").select("product_id", "device_id", "d").distinct()
    counted = seen.select("product_id", "device_id", F.explode(F.sequence(F.col("d"), F.date_add("d", days - 1))).alias("d")).distinct()
    return counted.groupBy("product_id", "d").agg(F.count("device_id").cast("bigint").alias("actives")) \
        .join(seen.select("product_id", "d").distinct(), ["product_id", "d"], "left_semi")


# ---------------------------------------------------------------------------
# Exact hourly actives by chained stateful operators
# ---------------------------------------------------------------------------

def hourly_actives(rows: DataFrame, watermark: str = LATE_HORIZON) -> DataFrame:
    """Exact distinct devices per product and event-time hour, in append mode.

    A first stateful operator keeps one row per (hour, product, device), a
    second one counts them; the watermark closes both and evicts their state.
    """
    hours = rows.where("ts is not null").withWatermark("ts", watermark).withColumn("hour", F.window("ts", "1 hour"))
    once = hours.dropDuplicates(["hour", "product_id", "device_id"])
    return once.groupBy("hour", "product_id").agg(F.count("device_id").alias("actives")) \
        .select(_ntz(F.col("hour.start")).alias("window_start"), "product_id", "actives")
