"""Operator 9 against plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tests.llm.docs import corpus, frame, odd_frame
from usagelens.llm import quality


def brute_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(1 for k, x in enumerate(lines) if x in lines[:k])
    grams = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    hit = set()
    for k in range(len(w) - 4):
        if grams[tuple(w[k:k + 5])] > 1:
            hit.update(range(k, k + 5))
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), n < 10 or 100 * len(hit) > 20 * n)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@pytest.mark.parametrize("odd", [False, True])
def test_base_counts(spark, odd):
    texts = corpus(21) + ["a\n\na\n \n \na", "#*$ %&|<> é", "w\x0bx\x0cy", "日本 語"]
    ids = [None if k % 9 == 0 else k // 2 for k in range(len(texts))]
    got = quality.judge((odd_frame if odd else frame)(spark, texts, ids)).collect()
    assert sorted(((r.doc_id, *(r[n] for n in NAMES)) for r in got), key=str) \
        == sorted(((i, *brute_counts(t)) for i, t in zip(ids, texts)), key=str)
    assert not [r for r in got if r.base_failed and r.kept]


def test_empty_table(spark):
    assert quality.judge(frame(spark, [])).collect() == []
    assert quality.keep_good(frame(spark, [])).collect() == []


def js(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = lambda a, m: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
    m = [(x + y) / 2 for x, y in zip(p, q)]
    return math.sqrt(max(0.0, (kl(p, m) + kl(q, m)) / 2))


def test_distances_and_references(spark):
    clean = ["the cat and the dog went to the town, as it was in a story of the sea and he had to be there %d" % k
             + " with my old friend by the river" * (k % 3) for k in range(400)]
    caps = ["SHOUTING WORDS WITHOUT END OR SENSE FOR EVERY READER HERE AND THERE " * 4 + f"X{k}" for k in range(4)]
    texts = clean + caps
    df = frame(spark, texts).withColumn("lang", F.lit("en"))
    rows = {r.doc_id: r for r in quality.judge(df).collect()}
    m = [quality.measure(t.encode(), quality._Bin()) for t in texts]
    for k, at in (("char_distance", 5), ("word_distance", 6)):
        ref = np.sum([x[at] for i, x in enumerate(m) if not rows[i].base_failed], axis=0)
        for i in (0, 7, len(texts) - 1):
            assert rows[i][k] == pytest.approx(js(m[i][at].tolist(), ref.tolist()), abs=1e-9)
    assert all(rows[k].char_distance > quality.MAX_CHAR_DISTANCE for k in range(len(clean), len(texts)))
    assert all(rows[k].kept == (not rows[k].base_failed) for k in range(len(clean)))


def test_windows_longer_than_a_number():
    """Many distinct words: windows are numbered step by step."""
    ids = np.concatenate([np.arange(9000), np.arange(50, 60)])
    assert quality.repeated_words(ids) == 20


def test_keep_good_keeps_columns(spark):
    texts = corpus(22)
    df = odd_frame(spark, texts)
    good = {r.doc_id for r in quality.judge(df).collect() if r.kept}
    out = quality.keep_good(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == good


def test_words_cut_up_by_symbols_are_caught_and_labelled_good_ones_stay(spark):
    """The limits on the given documents: measured on their labels and on the class of 'word | word' texts."""
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    cut = F.regexp_count("text", F.lit(r" \| ")) > 0.3 * F.size(F.split("text", r"\s+"))
    rows = quality.judge(docs).join(docs.select("doc_id", cut.alias("cut")), "doc_id").join(labels.select("doc_id", "quality"), "doc_id", "left").collect()
    pipes, good = [r for r in rows if r["cut"]], [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert len(pipes) > 15 and sum(not r.kept for r in pipes) >= 0.9 * len(pipes)
    assert len(good) > 200 and sum(not r.kept for r in good) < 0.03 * len(good)
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)
    # by the word histogram alone, as that is what tells them
    judged = [r for r in pipes if r.n_words >= quality.MIN_WORDS_JUDGED]
    assert all(r.word_distance > quality.MAX_WORD_DISTANCE for r in judged)


def test_junk_is_no_reference(spark):
    """Half of a language's rows are symbol noise that fails the base rules: it doesn't move the reference."""
    prose = [f"the cat of {k} and the dog in a house with his friend was not for them at {k * 7} by the sea or the wood" for k in range(300)]
    noise = [("| " * 40).strip()] * 300
    one = lambda texts: {r.doc_id: (r.char_distance, r.word_distance) for r in quality.judge(
        frame(spark, texts).withColumn("lang", F.lit("en"))).collect()}
    alone, mixed = one(prose), one(prose + noise)
    assert all(alone[k] == pytest.approx(mixed[k], abs=1e-12) for k in alone)
