"""Conversation prefix trie with count-min screening (operator 11).

A node is a distinct sequence of first turns, known by a 128-bit digest; its
members are the conversations that start with it.  Texts never leave the scan:
a turn travels as a digest and its number of code points, and a prefix digest
is a running sum of digests of (depth, turn), so it needs no text either.

* Ordinals and prefix digests are running totals over rows dealt by range.  A
  conversation may lie in many tasks: each task totals its own stretch, and the
  totals of the stretches before it, two rows a task, are added afterwards.
* A count-min sketch counts all prefix digests.  It never counts too little, so
  an estimate of one proves that no other conversation shares the prefix, nor
  any longer one: from there on the conversation's nodes are written where they
  are.  Only prefixes that may be shared are shuffled and grouped exactly.
* Every conversation is the smallest member of one stretch of nodes, from the
  depth where it leaves all smaller members to its end.  A subtree's turns and
  its distinct turns are sums over members, so no walk down the tree is needed:
  a member adds the code points before its own stretch to ``saved_tokens`` and
  its end, if childless, to ``n_leaves``, at each node that it shares.

The sketch takes at most ``MAX_CELLS`` cells a row (24 MB of bits in all at the
driver and in each executor).  A fuller sketch proves less and more prefixes are
grouped exactly; the result is the same.

Rows: null roles and texts are empty.  Turns of one number (null first) stand by
role, then by the MD5 of their content, so repeated rows are turns of their own.
Rows without ``conv_id`` belong to no conversation and make no node.  An empty
table has no node, not even the root.  Only ``conv_id``, ``turn``, ``role`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import stage

GROUP = 100
HEADS = 6
#: rows of the sketch, cells a row for each counted prefix, and the most cells a row
SKETCH_ROWS = 3
CELLS_A_PREFIX = 4
MIN_CELLS = 1 << 16
MAX_CELLS = 1 << 26
#: cells that travel together, and tasks whose cells are merged at a time
_BLOCK = 1 << 16
_FAN_IN = 64
#: a parent with this share of all stretches below it is looked up in a broadcast list, of 1,000 rows at most
HOT_PARENTS = 1000
LANES = ("x1", "x2", "x3", "x4")


def _longs(batch, name: str) -> np.ndarray:
    return np.ascontiguousarray(batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False), np.int64)


def running(rows: DataFrame, key: str, order: list[Column], values: list[str], name: str) -> DataFrame:
    """``rows`` with ``run_<v>``, the total of each long column up to the row within its ``key``.

    Rows are dealt by range of (key, order), so that a key of any size is
    spread over tasks; the totals of a key's earlier tasks come from two rows a
    task.  The result is staged, in order within each ``part``.
    """
    dealt = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    schema = dealt.schema.simpleString()[7:-1]
    runs = [f"run_{v}" for v in values]

    def scan(batches):
        part = TaskContext.get().partitionId()
        last, total = None, [0] * len(values)
        for b in batches:
            if b.num_rows == 0:
                continue
            k = _longs(b, key)
            first = np.concatenate(([k[0] != last], k[1:] != k[:-1]))
            start = np.maximum.accumulate(np.where(first, np.arange(len(k)), -1))     # -1: the batch before's last key goes on
            sums = []
            for v, before in zip(values, total):
                c = np.cumsum(_longs(b, v))
                sums.append(c + np.where(start < 0, before, np.where(start > 0, -c[start - 1], 0)))
            last, total = k[-1], [int(s[-1]) for s in sums]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(k), part, np.int32)), *map(pa.array, sums)],
                                             names=[*b.schema.names, "part", *runs])

    done = stage(dealt.mapInArrow(scan, f"{schema}, part int, {', '.join(f'{r} long' for r in runs)}"), name)
    # only a task's smallest and largest key may go on in another; totals grow, so the largest is the key's
    edges = done.groupBy("part").agg(F.max(F.struct(F.bitwise_not(key).alias("key"), *runs)).alias("low"),
                                     F.max(F.struct(F.col(key).alias("key"), *runs)).alias("high")).collect()
    carry, seen = [], {}
    for r in sorted(edges, key=lambda r: r.part):
        for k, stretch in {~r.low.key: r.low, r.high.key: r.high}.items():
            if k in seen:
                carry.append((r.part, k, *seen[k]))
            seen[k] = [x + y for x, y in zip(seen.get(k, [0] * len(runs)), stretch[1:])]
    if not carry:
        return done
    names = [f"_carry_{r}" for r in runs]
    carried = rows.sparkSession.createDataFrame(carry, f"part int, {key} long, {', '.join(f'{c} long' for c in names)}")
    return done.join(F.broadcast(carried), ["part", key], "left") \
        .withColumns({r: F.col(r) + F.coalesce(F.col(c), F.lit(0)) for r, c in zip(runs, names)}).drop(*names)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, k (from 1), turn_digest, n_chars of every turn in order."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("turn_digest"),
        F.char_length(text).cast("long").alias("n_chars"), F.lit(1).cast("long").alias("one"))
    rows = stage(rows, "turns")
    return running(rows, "conv_id", [F.asc_nulls_first("turn"), F.col("role"), F.col("turn_digest")], ["one"], "ordered_turns") \
        .select("conv_id", F.col("run_one").alias("k"), "turn_digest", "n_chars")


def grouped_heads(ordered: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """conv_id, depth, length, turn_digest, n_chars: conversations that share the head of their group's first one.

    Conversation c takes the first h = crc32(c) % heads turns of conversation
    c - c % group, then its own turns after its first h.  Depth 0 is a row
    without turn, so that a conversation without any turns is there too.
    """
    own = ordered.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    first = ordered.where((F.col("conv_id") % group == 0) & (F.col("k") < heads)).groupBy(F.col("conv_id").alias("base")) \
        .agg(F.array_sort(F.collect_list(F.struct("k", "turn_digest", "n_chars"))).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    info = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", h).join(first, "base", "left")
    info = info.withColumn("head", F.expr("filter(head, x -> x.k <= h)")).withColumn("n_head", F.coalesce(F.size("head"), F.lit(0)).cast("long")) \
        .withColumn("length", F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    info = stage(info.select("conv_id", "h", "head", "n_head", "length"), "heads")
    top = info.select("conv_id", "length", F.explode(F.concat(
        F.array(F.struct(F.lit(0).cast("long").alias("k"), F.lit(None).cast("string").alias("turn_digest"), F.lit(0).cast("long").alias("n_chars"))),
        F.coalesce("head", F.expr("array()")))).alias("t")).select("conv_id", F.col("t.k").alias("depth"), "length", "t.turn_digest", "t.n_chars")
    rest = ordered.join(info.select("conv_id", "h", "n_head", "length"), "conv_id").where("k > h") \
        .select("conv_id", (F.col("k") - F.col("h") + F.col("n_head")).alias("depth"), "length", "turn_digest", "n_chars")
    return top.unionAll(rest)


def plain(ordered: DataFrame) -> DataFrame:
    """conv_id, depth, length, turn_digest, n_chars: every conversation as it stands, with its depth 0."""
    length = ordered.groupBy("conv_id").agg(F.count("*").alias("length"))
    zero = length.select("conv_id", F.lit(0).cast("long").alias("depth"), "length", F.lit(None).cast("string").alias("turn_digest"),
                         F.lit(0).cast("long").alias("n_chars"))
    return zero.unionAll(ordered.join(length, "conv_id").select("conv_id", F.col("k").alias("depth"), "length", "turn_digest", "n_chars"))


def prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, length, before (code points above), through, and the node's and its parent's key.

    A key is two 64-bit hashes of the depth and four running sums of 32 bits of each turn's hashes.
    """
    lane = lambda seed, low: F.when(F.col("turn_digest").isNull(), F.lit(0)).otherwise(
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), "depth", "turn_digest"), 0 if low else 32).bitwiseAND(F.lit(0xFFFFFFFF))).cast("long")
    lanes = rows.withColumns(dict(zip(LANES, (lane(1, True), lane(1, False), lane(2, True), lane(2, False))))).drop("turn_digest")
    run = running(lanes, "conv_id", [F.col("depth")], [*LANES, "n_chars"], "prefixes")
    key = lambda seed: F.xxhash64(F.lit(seed), "depth", *(f"run_{x}" for x in LANES))
    up = lambda seed: F.xxhash64(F.lit(seed), F.col("depth") - 1, *(F.col(f"run_{x}") - F.col(x) for x in LANES))
    return run.select("part", "conv_id", "depth", "length", (F.col("run_n_chars") - F.col("n_chars")).alias("before"),
                      F.col("run_n_chars").alias("through"), key(1).alias("k1"), key(2).alias("k2"), up(1).alias("p1"), up(2).alias("p2"))


def _cells(k1: np.ndarray, k2: np.ndarray, row: int, width: int) -> np.ndarray:
    return ((k1.view(np.uint64) + np.uint64(row) * (k2.view(np.uint64) | np.uint64(1))) & np.uint64(width - 1)).astype(np.int64)


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """Bits (SKETCH_ROWS x width/8) of the count-min cells that hold two prefixes or more."""
    size = min(_BLOCK, width)

    def count(batches):
        cells = np.zeros((SKETCH_ROWS, width), np.uint8)       # 0, 1, or 2 for two and more
        for b in batches:
            k1, k2 = _longs(b, "k1"), _longs(b, "k2")
            for r in range(SKETCH_ROWS):
                at, n = np.unique(_cells(k1, k2, r, width), return_counts=True)
                cells[r, at] = np.minimum(cells[r, at] + np.minimum(n, 2), 2)
        part = TaskContext.get().partitionId()
        for r in range(SKETCH_ROWS):
            for k in range(0, width, size):
                c = cells[r, k:k + size]
                if c.any():
                    yield pa.RecordBatch.from_pydict({"r": pa.array([r], pa.int32()), "block": pa.array([k // size], pa.int32()),
                                                      "part": pa.array([part // _FAN_IN], pa.int32()),
                                                      "once": [np.packbits(c > 0).tobytes()], "twice": [np.packbits(c > 1).tobytes()]})

    def merge(table: pa.Table) -> pa.Table:
        once = twice = np.zeros(size // 8, np.uint8)
        for a, b in zip(table.column("once").to_pylist(), table.column("twice").to_pylist()):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            twice = twice | b | (once & a)
            once = once | a
        first = lambda c: table.column(c)[0].as_py()
        return pa.table({"r": pa.array([first("r")], pa.int32()), "block": pa.array([first("block")], pa.int32()),
                         "part": pa.array([first("part") // _FAN_IN], pa.int32()), "once": [once.tobytes()], "twice": [twice.tobytes()]})

    blocks = rows.select("k1", "k2").mapInArrow(count, "r int, block int, part int, once binary, twice binary")
    for _ in range(3):                 # 64 ** 3 tasks come down to one row a block
        blocks = blocks.groupBy("r", "block", "part").applyInArrow(merge, blocks.schema)
    bits = np.zeros((SKETCH_ROWS, width // 8), np.uint8)
    for row in blocks.select("r", "block", "twice").toLocalIterator():
        at = row.block * (size // 8)
        bits[row.r, at:at + size // 8] = np.frombuffer(row.twice, np.uint8)
    return bits


def screened(rows: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` with ``alone`` (proven to have one member) and ``opens`` (the first such row of its stretch)."""
    width = min(MAX_CELLS, max(MIN_CELLS, 1 << (max(n_rows, 1) * CELLS_A_PREFIX - 1).bit_length()))
    bits = rows.sparkSession.sparkContext.broadcast(sketch(rows, width))
    names = rows.columns

    def screen(batches):
        twice = bits.value
        last, proven = None, False
        for b in batches:
            if b.num_rows == 0:
                continue
            k1, k2, conv, part = _longs(b, "k1"), _longs(b, "k2"), _longs(b, "conv_id"), _longs(b, "part")
            many = np.ones(len(k1), bool)
            for r in range(SKETCH_ROWS):
                c = _cells(k1, k2, r, width)
                many &= (twice[r, c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
            # a longer prefix of a proven one is proven too, as far as the rows stand in order
            start = np.concatenate(([True], (conv[1:] != conv[:-1]) | (part[1:] != part[:-1])))
            at = np.flatnonzero(start)
            one = (~many).astype(np.int64)
            if proven and last == (conv[0], part[0]):
                one[0] = 1
            carried = proven and last == (conv[0], part[0])
            c = np.cumsum(one)
            c = c - np.repeat(c[at] - one[at], np.diff(np.concatenate((at, [len(c)]))))
            alone = c > 0
            opens = alone & np.concatenate(([True], ~alone[:-1] | start[1:]))
            if carried:
                opens[0] = False
            last, proven = (conv[-1], part[-1]), bool(alone[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(alone), pa.array(opens)], names=[*names, "alone", "opens"])

    return rows.mapInArrow(screen, f"{rows.schema.simpleString()[7:-1]}, alone boolean, opens boolean")


def ends(rows: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256: hash of the ids, ascending and comma-joined, that end at a shared node.

    A task packs the ids of a node into one text for each batch and ``part``.
    There rows stand in order of ids, so the texts of a node are stretches of its
    list and are hashed in turn.
    """
    def pack(batches):
        for b in batches:
            conv, k1, k2 = _longs(b, "conv_id"), _longs(b, "k1"), _longs(b, "k2")
            if len(conv) == 0:
                continue
            part = _longs(b, "part")
            order = np.lexsort((conv, k2, k1, part))
            key = np.stack([part[order], k1[order], k2[order]])
            at = np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0))))
            ids = [conv[o].tolist() for o in np.split(order, at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(key[1][at]), pa.array(key[2][at]), pa.array([x[0] for x in ids], pa.int64()),
                                              pa.array([",".join(map(str, x)) for x in ids], pa.string())], names=["k1", "k2", "low", "ids"])

    def digest(batches):
        now, sha = None, None
        for b in batches:
            done = []
            for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in (0, 1, 3))):
                if now != (k1, k2):
                    if now:
                        done.append((*now, sha.hexdigest()))
                    now, sha = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "ends_sha256"), x)) for x in done], schema=out)
        if now:
            yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "ends_sha256"), (*now, sha.hexdigest())))], schema=out)

    out = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
    return rows.where("depth = length").select("part", "conv_id", "k1", "k2").mapInArrow(pack, "k1 long, k2 long, low long, ids string") \
        .repartition("k1", "k2").sortWithinPartitions("k1", "k2", "low").mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """Nodes of the trie of ``rows`` (conv_id, depth, length, turn_digest, n_chars; depth 0 included).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    path = prefixes(rows)
    n_rows = path.count()
    path = stage(screened(path, n_rows), "screened")
    shared, alone = path.where("not alone"), path.where("alone")
    nodes = shared.groupBy("k1", "k2").agg(
        F.count("*").alias("n_convs"), F.min(F.struct("conv_id", "depth", "length", "before", "p1", "p2")).alias("low"))
    nodes = stage(nodes.select("k1", "k2", "n_convs", "low.*"), "nodes")

    # where each conversation's own stretch begins, and the node above it
    place = ["conv_id", "depth", "before", "p1", "p2"]
    tops = nodes.select(*place).unionAll(alone.where("opens").select(*place)).groupBy("conv_id") \
        .agg(F.min(F.struct("depth", "before", "p1", "p2")).alias("top")).select("conv_id", "top.*")
    tops = stage(tops, "stretches")
    below = tops.where("depth > 0")
    families = nodes.join(below.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("hung")), ["k1", "k2"], "left") \
        .withColumn("hung", F.coalesce("hung", F.lit(0)))
    families = stage(families, "families")
    hung = families.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"), "hung").where("hung > 0")
    n_below = below.count()
    hot = F.col("hung") * HOT_PARENTS >= n_below           # so many rows at most
    found = below.join(F.broadcast(hung.where(hot).drop("hung")), ["p1", "p2"], "left")
    found = stage(found, "hot_parents")
    parents = found.where("parent is not null").select("conv_id", "depth", "parent").unionAll(
        found.where("parent is null").drop("parent").join(hung.where(~hot), ["p1", "p2"]).select("conv_id", "depth", "parent"))

    # what every member adds to the nodes that it shares
    leaf = families.where("depth = length and hung = 0").select("conv_id").unionAll(
        alone.where("depth = length").select("conv_id")).withColumn("leaf", F.lit(1).cast("long"))
    whole = shared.groupBy("conv_id").agg(F.max("through").alias("through"))
    adds = whole.join(tops.select("conv_id", F.col("before").alias("own")), "conv_id", "left").join(leaf, "conv_id", "left") \
        .select("conv_id", F.coalesce("own", "through").alias("own"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    sums = shared.join(adds, "conv_id").groupBy("k1", "k2").agg(
        F.sum(F.greatest(F.col("own") - F.col("before"), F.lit(0))).alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    nobody = F.sha2(F.lit("").cast("binary"), 256)
    many = families.join(sums, ["k1", "k2"]).join(ends(shared), ["k1", "k2"], "left").select(
        "conv_id", "depth", "n_convs", (F.col("hung") + (F.col("length") > F.col("depth")).cast("long")).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"))
    one = F.lit(1).cast("long")
    single = alone.select("conv_id", "depth", one.alias("n_convs"), (F.col("length") > F.col("depth")).cast("long").alias("n_children"), one.alias("n_leaves"),
                          F.lit(0).cast("long").alias("saved_tokens"),
                          F.when(F.col("depth") == F.col("length"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(nobody).alias("ends_sha256"),
                          "opens")
    order = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    met = many.unionAll(single.where("opens").drop("opens")).join(parents, ["conv_id", "depth"], "left") \
        .withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")))
    tail = single.where("not opens").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    return met.select(*order).unionAll(tail.select(*order))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they stand."""
    return trie(plain(turns(conversations)))
