"""Operator 7 against brute force."""

from __future__ import annotations

import random
import re

import numpy as np

from tests.llm.docs import corpus, frame, odd_frame, prose
from usagelens.llm import decontam


def plain(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))


def brute_tiles(a, b, width=5):
    """Textbook greedy string tiling: the longest free match first, ties by document then item position."""
    ma, mb, out = [False] * len(a), [False] * len(b), []
    while True:
        best = (width - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ma[i + n] and not mb[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < width:
            return out
        out.append((i, j, n))
        ma[i:i + n], mb[j:j + n] = [True] * n, [True] * n


def brute_leaks(text, items, coverage=0.5):
    out = []
    for k, item in enumerate(items):
        b = plain(item)
        found = brute_tiles(plain(text), b) if len(b) >= 5 else []
        if found and sum(n for *_, n in found) >= coverage * len(b):
            out.append((k, sum(n for *_, n in found), len(found)))
    return out


def test_tiles_are_greedy():
    rng = random.Random(71)
    for k in range(200):
        letters = "xyz" if k % 2 else "xy"
        a, b = ([rng.choice(letters) for _ in range(rng.randrange(3, 40))] for _ in range(2))
        found = decontam.tiles(*(np.array([ord(c) for c in w]) for w in (a, b)))
        assert found == brute_tiles(a, b)


def test_tiles_with_colliding_hashes(monkeypatch):
    """Equal hashes of different words are verified, so a weak hash gives the same tiles."""
    monkeypatch.setattr(decontam, "mix", lambda h: h % np.uint64(2))
    rng = random.Random(75)
    for _ in range(100):
        a, b = (np.array([rng.randrange(4) for _ in range(rng.randrange(5, 40))]) for _ in range(2))
        assert decontam.tiles(a, b) == brute_tiles(a.tolist(), b.tolist())


def test_seeded_words_hold_every_match():
    rng = random.Random(76)
    for _ in range(100):
        a, b = ([rng.choice("xyz") for _ in range(rng.randrange(5, 60))] for _ in range(2))
        grams = {}
        for j in range(len(b) - 4):
            grams.setdefault(tuple(b[j:j + 5]), j)
        seeds = [(i, grams[tuple(a[i:i + 5])]) for i in range(len(a) - 4) if tuple(a[i:i + 5]) in grams]
        if not seeds:
            assert brute_tiles(a, b) == []
            continue
        item = np.array([ord(c) for c in b])
        words, at, gaps = decontam.seeded_words(*np.array(seeds).T, item)
        assert [(int(at[i]), j, n) for i, j, n in decontam.tiles(words, item, gaps=gaps)] == brute_tiles(a, b)


def test_one_word_repeated_in_both_texts(spark):
    """A place is one seed, not one for each place of the item; every copy of the item's words is one tile."""
    df = frame(spark, ["buy " * 60_000, "now " * 4 + "buy " * 700])
    table = spark.createDataFrame([(0, "buy " * 2_000)], "item_id long, text string")
    assert decontam.seeds(df, decontam.item_words(table)).count() == 60_000 - 4 + 700 - 4
    got = [(r.doc_id, r.n_covered, r.n_tiles, r.first_word) for r in decontam.leaks(df, table).collect()]
    assert got == [(0, 2_000, 1, 0)]


def test_very_long_text(spark):
    rng = random.Random(77)
    item = prose(rng, 40)
    w = item.split()
    long = prose(rng, 100_000) + " " + " ".join(w[20:]) + " " + prose(rng, 50_000) + " " + " ".join(w[:20])
    table = spark.createDataFrame([(0, item)], "item_id long, text string")
    got = decontam.leaks(frame(spark, [long, prose(rng, 100_000)]), table).collect()
    assert [(r.doc_id, r.last_word) for r in got] == [(0, len(plain(long)) - 1)] and got[0].n_covered == 40


def test_items_that_share_an_id(spark):
    rng = random.Random(78)
    a, b = prose(rng, 12), prose(rng, 30)
    table = spark.createDataFrame([(7, a), (7, b), (7, a), (None, b)], "item_id long, text string")
    got = decontam.leaks(frame(spark, [a, b]), table).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_item) for r in got), key=str) == sorted([(0, 7, 12), (1, 7, 30), (1, None, 30)], key=str)


def cases(seed):
    rng = random.Random(seed)
    items = [prose(rng, rng.randrange(3, 40)) for _ in range(12)] + [None, "", "one two", "a b c d e"]
    texts = corpus(seed, 15)
    for t in items[:6]:
        w = (t or "").split()
        cut = len(w) // 2
        texts += [prose(rng, 30) + " " + t.upper() + "!! " + prose(rng, 5), " ".join(w[cut:] + ["between"] + w[:cut]), " ".join(w[:cut // 2])]
    return texts, items


def test_against_brute_force(spark):
    texts, items = cases(72)
    table = spark.createDataFrame([(k if k != 3 else None, t) for k, t in enumerate(items)], "item_id long, text string")
    got = decontam.leaks(frame(spark, texts), table).collect()
    want = [(d, k if k != 3 else None, c, n) for d, t in enumerate(texts) for k, c, n in brute_leaks(t, items)]
    assert sorted(((r.doc_id, r.item_id, r.n_covered, r.n_tiles) for r in got), key=str) == sorted(want, key=str)
    assert len(want) >= 10


def test_null_and_repeated_ids_and_columns(spark):
    texts, items = cases(73)
    ids = [None if k % 5 == 0 else k // 2 for k in range(len(texts))]
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = odd_frame(spark, texts, ids)
    out = decontam.keep_clean(df, table)
    assert out.columns == df.columns
    want = sorted(((i, t) for i, t in zip(ids, texts) if not brute_leaks(t, items)), key=str)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(0, "a b c d e f g")], "item_id long, text string")
    assert decontam.leaks(frame(spark, []), some).collect() == []
    assert decontam.leaks(frame(spark, ["a b c d e f g"]), none).collect() == []
    assert decontam.leaks(frame(spark, ["a b c d e f g"]), some).count() == 1
