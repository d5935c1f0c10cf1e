"""Conversation prefix trie against a brute-force trie."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.llm import prefix_trie as pt

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def ordered(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.md5(
        f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest())
    out: dict = {}
    for r in sorted(rows, key=key):
        if r[0] is not None:
            out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def with_heads(conv):
    out = {}
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = conv.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(conv):
    nodes: dict = {}
    for c, turns in conv.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids: dict = {}
    for n in nodes:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        below = kids.get(n, [])
        leaves[n] = sum(leaves[x] for x in below) or 1
        saved[n] = sum(saved[x] for x in below) + (len(nodes[n]) - 1) * (len(n[-1][1]) if n else 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), len(kids.get(n, [])), leaves[n], saved[n],
                   sha([c for c in m if len(conv[c]) == len(n)])) for n, m in nodes.items())


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def some(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), n) + [0, 100, 300]:
        for k in range(rng.randrange(0, 9)):
            rows.append((c, rng.choice([k, k, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "long " * 9])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_trie_with_shared_heads(spark, seed):
    rows = some(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(pt.trie(pt.grouped_heads(pt.turns(df)))) == brute(with_heads(ordered(rows)))


def test_plain_trie_clashing_columns_and_rows_without_id(spark):
    rows = some(7) + [(None, 0, "user", "lost"), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("k", "depth", "part", "length", "edge", "alone", "k1", "head", "one", "run_one"):
        df = df.withColumn(name, F.lit("clash"))
    assert got(pt.prefix_trie(df)) == brute(ordered(rows))


def test_copies_long_conversations_and_repeated_rows(spark):
    rows = [(c, k, "user", f"turn {k}") for c in range(40) for k in range(3)]                        # one group of copies
    rows += [(50, k, "user", f"turn {min(k, 700)}") for k in range(1500)] + [(51, k, "user", f"turn {k}") for k in range(900)]
    rows += [(60, 1, "user", "again")] * 5 + [(61, 1, "user", "again")] * 3
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert got(pt.prefix_trie(df)) == brute(ordered(rows))


def test_turnless_conversation_is_a_member_of_the_root(spark):
    lost = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)        # its only turn goes, its base is absent
    rows = [(lost, 0, "user", "x"), (205, 0, "user", "y")]
    result = got(pt.trie(pt.grouped_heads(pt.turns(spark.createDataFrame(rows, SCHEMA)))))
    assert result == brute(with_heads(ordered(rows)))
    assert result[0][:4] == (lost, 0, None, 2)


def test_empty_table_and_single_conversation(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert got(pt.prefix_trie(empty)) == []
    assert got(pt.trie(pt.grouped_heads(pt.turns(empty)))) == []
    rows = [(5, 0, "user", "hello"), (5, 1, "assistant", "x" * 200_000)]
    assert got(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(ordered(rows))


def test_a_full_sketch_proves_less_and_changes_nothing(spark, monkeypatch):
    rows = some(11)
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(pt, "MIN_CELLS", 8)
    monkeypatch.setattr(pt, "MAX_CELLS", 8)
    assert got(pt.prefix_trie(df)) == brute(ordered(rows))


def test_estimate_of_one_is_never_shared(spark):
    rows = some(3, 200)
    path = pt.prefixes(pt.plain(pt.turns(spark.createDataFrame(rows, SCHEMA).repartition(6))))
    n = path.count()
    seen = path.groupBy("k1", "k2").count()
    marked = pt.screened(path, n).join(seen, ["k1", "k2"])
    assert marked.where("alone and count > 1").isEmpty()
    # a sketch of four cells a prefix proves nearly all that stand alone
    alone, proven = marked.where("count = 1").count(), marked.where("alone").count()
    assert alone > 0 and proven > 0.95 * alone


def test_running_totals_of_a_key_in_many_tasks(spark):
    rows = spark.range(5000).select((F.col("id") % 2 * 7).alias("key"), F.col("id").alias("at"), (F.col("id") % 5).alias("v"))
    rows = rows.repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = pt.running(rows, "key", [F.col("at")], ["v"], "totals").select("key", "at", "v", "run_v", "part").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.part for r in out}) > 2
    total = {0: 0, 7: 0}
    for r in sorted(out, key=lambda r: (r.key, r["at"])):
        total[r.key] += r.v
        assert r.run_v == total[r.key]


def test_cells_are_spread():
    k1, k2 = np.random.default_rng(1).integers(-1 << 63, 1 << 63, (2, 1 << 14), np.int64)
    for r in range(pt.SKETCH_ROWS):
        assert len(np.unique(pt._cells(k1, k2, r, 1 << 16))) > 13_000
