"""Operator 10 against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from tests.llm.docs import SCHEMA, corpus, frame, odd_frame
from usagelens.llm import simhash


def brute_print(t):
    w = "".join(c.lower() if c.isascii() else c for c in t or "").replace("\t", " ").replace("\n", " ").split(" ")
    w = [x for x in w if x]
    if not w:
        return 0
    g = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, ids, d=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= d:
                root[find(a)] = find(b)
    low = {}
    for k, i in enumerate(ids):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return [low.get(find(k)) for k in range(len(ids))]


def check(spark, texts, ids=None, odd=False):
    ids = list(range(len(texts))) if ids is None else ids
    prints = [brute_print(t) for t in texts]
    want = sorted(zip(ids, (f"{p:016x}" for p in prints), brute_components(prints, ids)), key=str)
    df = (odd_frame if odd else frame)(spark, texts, ids)
    assert sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=str) == want


def test_against_brute_force(spark):
    check(spark, corpus(11))


def test_repeated_and_null_ids(spark):
    texts = corpus(12, 25)
    check(spark, texts, [None if k % 7 == 0 else k // 2 for k in range(len(texts))], odd=True)


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert simhash.keep_one(frame(spark, [])).collect() == []


@pytest.mark.parametrize("d", [0, 1, 2, 3, 4])
def test_links_connect_all_pairs_within_distance(d):
    rng = random.Random(d)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = list(dict.fromkeys(base + [b ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(1, 6))) for b in base for _ in range(6)]))
    f, pairs = np.array(prints, np.uint64), set()
    for bucket in range(16):
        pairs |= {tuple(p) for p in simhash.bucket_links(f, bucket, 4, d).tolist()}
    assert all((a ^ b).bit_count() <= d for a, b in pairs)
    index = {p: k for k, p in enumerate(prints)}
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        root[find(index[a])] = find(index[b])
    want = brute_components(prints, list(range(len(prints))), d)
    groups = {}
    for k in range(len(prints)):
        groups.setdefault(find(k), []).append(k)
    assert sorted(min(g) for g in groups.values() for _ in g) == sorted(want)


def test_dense_groups_hand_on_few_links():
    """Hundreds of copies within three bits of each other: links grow with the copies, not with their pairs."""
    rng = random.Random(9)
    center = rng.getrandbits(64)
    prints = list({center ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(0, 2))) for _ in range(400)}
                  | {center ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)})
    f, seen, kept = np.array(prints, np.uint64), set(), set()
    for bucket in range(16):
        pairs = simhash.bucket_links(f, bucket, 4, 3)
        tree = simhash.forest(pairs)
        assert len(tree) < len(f)
        seen |= {tuple(p) for p in pairs.tolist()}
        kept |= {tuple(p) for p in tree.tolist()}
    assert {x for p in kept for x in p} == {x for p in seen for x in p} == set(prints)
    assert len(kept) <= 4 * len(prints)


def test_forest_of_no_pairs():
    assert simhash.forest(np.zeros((0, 2), np.uint64)).shape == (0, 2)


def test_components_of_paths_and_stars(spark):
    n = 60
    path = [(k, k + 1) for k in range(n)]
    star = [(1000, 1000 + k) for k in range(1, 40)]
    loops = [(5000, 5000), (7000, 6999), (6999, 7000)]
    got = dict(tuple(r) for r in simhash.components(spark.createDataFrame(path + star + loops, "a long, b long")).collect())
    want = {k: 0 for k in range(n + 1)} | {1000 + k: 1000 for k in range(40)} | {7000: 6999, 6999: 6999}
    assert got == want


def test_keep_one_leaves_one_of_each_group(spark):
    texts = corpus(13, 25)
    ids = [None if k % 11 == 0 else k // 2 for k in range(len(texts))]
    prints = [brute_print(t) for t in texts]
    df = frame(spark, texts, ids)
    df = df.unionAll(df)        # every row twice
    got = simhash.keep_one(df).collect()
    roots = brute_components(prints, list(range(len(texts))))
    assert len(got) == len(set(roots))
    assert {(r.doc_id, r.text) for r in got} <= set(zip(ids, texts))
    assert simhash.keep_one(df).columns == SCHEMA.names


def test_copies_of_a_fingerprint_stay_few():
    """What a fingerprint costs in shuffle: 8 bytes a copy, at 64 buckets as at 3 TB."""
    from usagelens.llm import simhash as sh
    assert sh.copies(6) == 13
    # two kilobytes of text a document: 10**7 fingerprints are 20 GB, 10**9 are 2 TB
    for nodes, most in ((10 ** 5, 40), (10 ** 7, 60), (10 ** 9, 120)):
        sent = sh.copies(sh.bucket_bits(nodes))
        assert sent <= most and sent * 8 < 0.5 * 2000


def test_bucket_sets_are_disjoint_and_cover_all_bits():
    from usagelens.llm import simhash as sh
    for bits in (2, 6, 7, 12, 19, 33, 48):
        sets = sh._parities(bits)
        assert sum(sets) == (1 << 64) - 1 and all(x for x in sets)
        assert all(x < 1 << 32 or x % (1 << 32) == 0 for x in sets)
