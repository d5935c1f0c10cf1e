"""Kept first-launch index (L5-L7, T1-T3): who was new, kept up as rows arrive.

The index holds one row per (scope, device): the day and id of its first launch,
with that launch's attributes.  It lies in ``n_buckets`` hash buckets of (scope,
device), and every update writes the buckets it changes as a new generation
beside the old one; a manifest row per changed bucket makes a generation count.
A replayed update writes the same generation again, and a failed one leaves
nothing that is read.

:meth:`FirstLaunchIndex.update` is the reference's repair of the last days (L7)
without a recompute.  Late rows are first reduced to one first launch per device
(a partial aggregate).  Their buckets are the only ones opened, and a Bloom
filter of their devices, ``BLOOM_BITS`` bits built by the executors, thins the
opened rows before the join.  Of these only buckets in which some device is new
or got an earlier first launch are written.  What reaches the driver is bounded
by the filter and the number of buckets, not by the rows.

The result of an update is the corrections: per device the launch that loses the
flag and the one that gets it, from which :func:`reflag` sets ``is_new`` in just
the days concerned and :func:`new_user_deltas` adjusts daily counts.

Null keys are keys like any other (a launch without device belongs to the one
device "null" of its product); a launch without day is first only where the
device has no other, as nulls stand last in (day, id) order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: bits of the filter of late devices (128 KB), and bits set for each device
BLOOM_BITS = 1 << 20
BLOOM_HASHES = 3
N_BUCKETS = 64


def order_key(row: str | None = None) -> Column:
    """(day, id), nulls last: the order that decides the first launch (of a struct column ``row``)."""
    c = lambda name: F.col(f"{row}.{name}" if row else name)
    return F.struct(c("d").isNull().alias("no_d"), c("d").alias("d"), c("launch_id").isNull().alias("no_id"), c("launch_id").alias("id"))


def first_rows(launch: DataFrame, scope: list[str], attributes: list[str]) -> DataFrame:
    """scope, device_id, d, launch_id and attributes of each device's first launch."""
    rest = _rest(scope, attributes)
    first = F.min_by(F.struct("d", "launch_id", *rest), order_key())
    return launch.groupBy(*scope, "device_id").agg(first.alias("_f")).select(*scope, "device_id", "_f.*")


def _rest(scope: list[str], attributes: list[str]) -> list[str]:
    return [c for c in attributes if c not in scope and c not in ("device_id", "d", "launch_id")]


def _positions(keys: list[str]) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), *keys), F.lit(BLOOM_BITS)) for k in range(BLOOM_HASHES)]


def bloom_filter(rows: DataFrame, keys: list[str]) -> Column:
    """The filter of all rows' keys as an array of 64-bit words, a scalar subquery.

    Executors set the bits and or them per word; one task lines up the
    ``BLOOM_BITS / 64`` words.
    """
    bits = rows.select(F.explode(F.array(*_positions(keys))).alias("p"))
    words = bits.groupBy(F.floor(F.col("p") / 64).cast("long").alias("id")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits"))
    every = rows.sparkSession.range(BLOOM_BITS // 64).join(words, "id", "left").select(F.struct("id", F.coalesce("bits", F.lit(0)).cast("long").alias("bits")).alias("w"))
    return every.agg(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["bits"])).scalar()


def might_contain(words: Column, keys: list[str]) -> Column:
    """Whether the filter may hold a row's key (never false for one that it holds)."""
    hit = F.lit(True)
    for p in _positions(keys):
        hit = hit & (F.getbit(F.element_at(words, (F.floor(p / 64) + 1).cast("int")), (p % 64).cast("int")) == 1)
    return hit


class FirstLaunchIndex:
    """The index under ``path`` (shared storage) for one scope."""

    def __init__(self, spark: SparkSession, path: str, scope: list[str] = ("product_id",), attributes: list[str] = (), n_buckets: int = N_BUCKETS):
        self.spark, self.path, self.scope, self.attributes, self.n = spark, path, list(scope), list(attributes), n_buckets
        self.keys = [*self.scope, "device_id"]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n)).cast("int")

    def generations(self, before: int | None = None) -> dict[int, int]:
        """Newest generation (below ``before``) of every bucket that has rows."""
        manifest = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        if not manifest.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(manifest):
            return {}
        rows = self.spark.read.parquet(f"{self.path}/manifest")
        rows = rows if before is None else rows.where(F.col("generation") < before)
        return {r.bucket: r.generation for r in rows.groupBy("bucket").agg(F.max("generation").alias("generation")).collect()}

    def _open(self, generations: dict[int, int], buckets: set[int] | None = None) -> DataFrame | None:
        paths = [f"{self.path}/rows/generation={g}/bucket={b}" for b, g in sorted(generations.items()) if buckets is None or b in buckets]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, buckets: set[int] | None = None) -> DataFrame | None:
        """The index, or its given buckets; only their files are listed and read."""
        return self._open(self.generations(), buckets)

    def _staged(self, df: DataFrame, kind: str, epoch: int) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{kind}/epoch={epoch}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{kind}/epoch={epoch}")

    def _matching(self, prefix: str) -> list[Column]:
        return [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in self.keys]

    def update(self, rows: DataFrame, epoch: int) -> DataFrame:
        """Take up launches that arrive in any order; the corrections of this epoch.

        Epochs ascend.  Corrections: keys, d, launch_id and attributes of the
        launch that now has the flag, and ``old``, the same of the one that had
        it (null for a device seen for the first time).
        """
        late = self._staged(first_rows(rows, self.scope, self.attributes).withColumn("bucket", self._bucket()), "late", epoch)
        before = self.generations(epoch)          # a replay begins where the first try began
        touched = {r.bucket for r in late.select("bucket").distinct().collect()}            # n_buckets at most
        held = self._open(before, touched)
        if held is None:
            row = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in late.schema if f.name not in (*self.keys, "bucket"))
            late = late.withColumn("old", F.from_json(F.lit(None).cast("string"), row))
        else:
            old = F.struct("d", "launch_id", *_rest(self.scope, self.attributes)).alias("old")
            held = held.where(might_contain(bloom_filter(late, self.keys), self.keys)).select(*[F.col(k).alias(f"_{k}") for k in self.keys], old)
            late = late.join(held, self._matching("_"), "left").drop(*[f"_{k}" for k in self.keys]) \
                .where(F.col("old").isNull() | (order_key() < order_key("old")))
        changes = self._staged(late, "corrections", epoch)
        changed = {r.bucket for r in changes.select("bucket").distinct().collect()}
        if changed:
            fresh = changes.drop("old")
            kept = self._open(before, changed)
            if kept is not None:
                gone = changes.select(*[F.col(k).alias(f"_{k}") for k in self.keys])
                fresh = kept.join(gone, self._matching("_"), "left_anti").withColumn("bucket", self._bucket()).unionByName(fresh)
            (fresh.repartition(len(changed), "bucket").write.mode("overwrite").partitionBy("bucket")
             .parquet(f"{self.path}/rows/generation={epoch}"))
        self.spark.createDataFrame([(b, epoch) for b in sorted(changed)], "bucket int, generation long").coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.path}/manifest/epoch={epoch}")
        return changes.drop("bucket")

    def corrections(self) -> DataFrame:
        """The corrections of all epochs."""
        return self.spark.read.parquet(f"{self.path}/corrections").drop("bucket")


def reflag(flagged: DataFrame, corrections: DataFrame, flag: str = "is_new") -> DataFrame:
    """The days of a flagged fact that corrections concern, with their flags put right.

    Rows of other days don't come out: they stay as they are.  The days join as
    a broadcast list of measured size, so that day partitions are pruned.
    """
    days = corrections.select(F.col("d").alias("_day")).unionAll(corrections.where("old is not null").select("old.d")).distinct()
    return set_flags(on_days(flagged, days), corrections, flag)


def set_flags(rows: DataFrame, corrections: DataFrame, flag: str = "is_new") -> DataFrame:
    """``rows`` with the flags of the launches that corrections name."""
    on = corrections.select(F.col("launch_id").alias("_id"), F.lit(1).alias("_set")) \
        .unionAll(corrections.where("old is not null").select("old.launch_id", F.lit(0)))
    return rows.join(on, F.col("launch_id") == F.col("_id"), "left").withColumn(flag, F.coalesce("_set", F.col(flag))).drop("_id", "_set")


def on_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the listed days (``_day``) only; a plain equality, so that the list
    prunes the scan's day folders as it runs.  Rows without a day are the folder
    of theirs, wanted where the list has a null."""
    dated = rows.join(days.where("_day > date'0001-01-01'"), F.col("d") == F.col("_day"), "left_semi")
    asked = days.where("_day is null").select(F.lit(1).alias("_null"))
    undated = rows.where("d is null").withColumn("_null", F.lit(1)).join(asked, "_null", "left_semi").drop("_null")
    return dated.unionByName(undated)


def take_late_rows(index: FirstLaunchIndex, fact_path: str, late: DataFrame, epoch: int, flag: str = "is_new") -> DataFrame:
    """Bring late rows into a flagged fact that lies by day under ``fact_path``.

    Only the days of the late rows and of the flags that move are read and
    replaced; rows that the fact holds already (a replay) don't come twice.
    The corrections come back.
    """
    spark = index.spark
    corrections = index.update(late, epoch)
    corrections.write.mode("overwrite").parquet(f"{index.path}/applied/epoch={epoch}")
    corrections = spark.read.schema(corrections.schema).parquet(f"{index.path}/applied/epoch={epoch}")
    fact = spark.read.parquet(fact_path)
    days = late.select(F.col("d").alias("_day")).unionAll(corrections.select("d")) \
        .unionAll(corrections.where("old is not null").select("old.d")).distinct()
    held = on_days(fact, days)
    new = late.withColumn(flag, F.lit(0)).select(*fact.columns).join(held.select(F.col("launch_id").alias("_id")), F.col("launch_id").eqNullSafe(F.col("_id")), "left_anti")
    staged = f"{index.path}/days/epoch={epoch}"
    set_flags(held.unionByName(new), corrections, flag).write.mode("overwrite").parquet(staged)
    spark.read.schema(fact.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(fact_path)
    return corrections


def new_user_deltas(corrections: DataFrame, keys: list[str]) -> DataFrame:
    """Change of the number of new users per (keys, day): one less where the flag
    was, one more where it is.  ``keys`` are of the index's scope or attributes."""
    gain = corrections.select(*keys, "d", F.lit(1).alias("n"))
    held = [c for c in corrections.schema["old"].dataType.names]
    loss = corrections.where("old is not null").select(*[F.col(f"old.{k}" if k in held else k).alias(k) for k in keys], F.col("old.d").alias("d"), F.lit(-1).alias("n"))
    return gain.unionAll(loss).groupBy(*keys, "d").agg(F.sum("n").alias("newusers")).where("newusers <> 0")
