"""Sharding by extendible hashing (operator 3).

A document's place is a fixed hash of its id and text.  The directory is
indexed by the leading bits of that hash.  A bucket that holds more bytes than
a shard may is split on one more bit, and only that bucket; the others keep
their depth.  A shard is thus the shallowest bucket that fits.

Splitting works on sums: documents are counted once into fine cells of the
hash, and every bucket at every depth is a sum of cells.  Cells that are still
too large are counted again on more bits, over their own documents only.

A document larger than the limit is a shard of its own.  Documents with one and
the same hash (exact copies of row and id) can't be split by bits; if they
don't fit together they overflow into numbered pages of a shard.

Rows: a null text has zero bytes; a null id hashes like a value.  An empty
table has no shards.  Further columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import stage

LIMIT_BYTES = 64 << 20
BITS = 60               # of the hash; 15 hex digits of an MD5
FINE = 4                # first cells are this many bits finer than even shards
STEP = 8                # bits that each further round adds


def place(*rest: str) -> Column:
    """60-bit hash of a document's id and text, and of the columns ``rest``."""
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))]
    if rest:
        parts.append(F.to_json(F.struct(*rest)))
    key = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(key, 1, BITS // 4), 16, 10).cast("long")


def size() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")


def prefix(h: Column, depth: int) -> Column:
    return F.shiftright(h, BITS - depth)


def directory(rows: DataFrame, limit: int = LIMIT_BYTES):
    """Rounds of the directory: a list of (bits, cells) and the rows that no number of bits can split.

    ``rows`` are staged (h, n_bytes, ...).  ``cells`` has ``cell`` (leading
    ``bits`` of the hash) and ``depth`` of the shard it belongs to.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(1, -(-total // limit))
    low, high = 0, min(BITS, (shards - 1).bit_length() + FINE)
    rounds, pending = [], rows
    while True:
        cells = stage(pending.groupBy(prefix(F.col("h"), high).alias("cell"))
                      .agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_rows")), "shard_cells")
        deep = cells.select("cell", "n_bytes", "n_rows", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")) \
            .withColumn("bucket", F.expr(f"shiftright(cell, {high} - depth)"))
        fits = deep.groupBy("depth", "bucket").agg(F.sum("n_bytes").alias("sum_bytes"), F.sum("n_rows").alias("sum_rows")) \
            .where((F.col("sum_bytes") <= limit) | (F.col("sum_rows") == 1))
        found = deep.join(fits, ["depth", "bucket"], "left_semi").groupBy("cell").agg(F.min("depth").alias("depth"))
        found = stage(cells.select("cell").join(found, "cell", "left"), "shard_directory")
        rounds.append((high, found.where("depth is not null")))
        over = found.where("depth is null").select("cell")
        if over.isEmpty():
            return rounds, None
        bits = high
        pending = stage(pending.join(over, prefix(F.col("h"), bits) == F.col("cell"), "left_semi"), "shard_rows")
        if high == BITS:
            return rounds, pending
        low, high = high + 1, min(BITS, high + STEP)


def shard_name() -> Column:
    """A shard's name: its hash prefix as bits (the empty prefix is the only shard, 'all')."""
    bits = F.lpad(F.bin(F.expr(f"shiftright(h, {BITS} - depth)")), F.col("depth"), "0")
    return F.when(F.col("depth") == 0, "all").otherwise(bits)


def locate(rows: DataFrame, rounds) -> DataFrame:
    """``rows`` (with h) and the ``depth`` of their shard; null where the copies overflow.

    The directory is joined by equality on leading bits, one join per round;
    Spark broadcasts it where its measured size allows and shuffles otherwise.
    """
    out = rows.withColumn("depth", F.lit(None).cast("int"))
    for bits, cells in rounds:
        c = cells.select(F.col("cell").alias("cell_"), F.col("depth").alias("depth_"))
        out = out.join(c, prefix(F.col("h"), bits) == F.col("cell_"), "left") \
            .withColumn("depth", F.coalesce("depth", "depth_")).drop("cell_", "depth_")
    return out


def index_rows(docs: DataFrame, *rest: str) -> DataFrame:
    return docs.select("doc_id", place(*rest).alias("h"), size().alias("n_bytes"))


def _pages(groups: DataFrame, limit: int) -> DataFrame:
    """Spread ``copies`` equal rows over pages of at most ``limit`` bytes."""
    per = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1))))
    return groups.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))) \
        .withColumn("page", F.floor(F.col("copy") / per).cast("long")) \
        .withColumn("depth", F.lit(BITS)).drop("copies", "copy")


def shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """The index: doc_id, n_bytes, depth, shard, page (0 unless copies overflow)."""
    rows = stage(index_rows(docs), "shard_index")
    rounds, over = directory(rows, limit)
    out = locate(rows, rounds).withColumn("page", F.lit(0).cast("long"))
    if over is not None:
        copies = over.groupBy("doc_id", "h", "n_bytes").agg(F.count("*").alias("copies"))
        out = out.where("depth is not null").unionByName(_pages(copies, limit).select(*out.columns))
    return out.select("doc_id", "n_bytes", "depth", shard_name().alias("shard"), "page")


def sharded_documents(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """The rows of ``docs`` with a struct ``placed`` (shard, page, depth, n_bytes) beside their columns.

    The struct is named ``placed_`` if there is such a column already.  All
    columns enter the hash, so only rows that are equal throughout can overflow.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    rounds, over = directory(stage(index_rows(docs, *rest), "shard_index"), limit)
    rows = docs.select(F.struct("*").alias("row"), place(*rest).alias("h"), size().alias("n_bytes"))
    out = locate(rows, rounds).withColumn("page", F.lit(0).cast("long"))
    if over is not None:
        lost = over.select("h").distinct()
        copies = rows.join(lost, rows.h == lost.h, "left_semi").groupBy("row", "h", "n_bytes").agg(F.count("*").alias("copies"))
        out = out.where("depth is not null").unionByName(_pages(copies, limit).select(*out.columns))
    name = "placed"
    while name in docs.columns:
        name += "_"
    return out.select("row.*", F.struct(shard_name().alias("shard"), "page", "depth", "n_bytes").alias(name))
