"""Operators 4 and 5 against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tests.llm.docs import corpus, frame, odd_frame
from usagelens.llm import packed, suffix_dedup, window_dedup


def covered(items, n, width, first):
    """Mask of positions under a window that starts in a smaller document."""
    doc, seq = items
    mask = [False] * n
    for p in range(n - width + 1):
        if doc is not None and first[tuple(seq[p:p + width]) if isinstance(seq, list) else seq[p:p + width]] < doc:
            mask[p:p + width] = [True] * width
    return mask


def first_seen(docs, width):
    first = {}
    for doc, seq in docs:
        if doc is None:
            continue
        for p in range(len(seq) - width + 1):
            k = tuple(seq[p:p + width]) if isinstance(seq, list) else seq[p:p + width]
            first[k] = min(first.get(k, doc), doc)
    return first


def brute_words(rows, width=13):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first, out = first_seen(docs, width), []
    for i, w in docs:
        m = covered((i, w), len(w), width, first)
        kept = [x for x, gone in zip(w, m) if not gone]
        out.append((i, len(w), sum(m), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def brute_bytes(rows, width=50):
    docs = [(i, (t or "").encode()) for i, t in rows]
    first, out = first_seen(docs, width), []
    for i, b in docs:
        m = covered((i, b), len(b), width, first)
        kept = bytes(x for x, gone in zip(b, m) if not gone)
        spans = sum(1 for k, x in enumerate(m) if x and not (k and m[k - 1]))
        out.append((i, len(b), sum(m), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def words_of(df):
    return sorted((tuple(r) for r in window_dedup.dedup(df).drop("kept_text").collect()), key=str)


def bytes_of(df):
    return sorted((tuple(r) for r in suffix_dedup.dedup(df).drop("kept_bytes").collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    texts = corpus(seed)
    rows = list(enumerate(texts))
    df = frame(spark, texts)
    assert words_of(df) == brute_words(rows)
    assert bytes_of(df) == brute_bytes(rows)


def test_segments_of_one_run(spark, monkeypatch):
    """Nothing is resolved locally when each segment is tiny."""
    texts = corpus(3, 12)
    monkeypatch.setattr(packed, "SEGMENT_BYTES", 1)
    df = frame(spark, texts, parts=1)
    assert words_of(df) == brute_words(list(enumerate(texts)))


def test_repeated_and_null_ids(spark):
    texts = corpus(4, 20)
    ids = [None if k % 9 == 0 else k // 2 for k in range(len(texts))]
    rows = list(zip(ids, texts))
    df = odd_frame(spark, texts, ids)
    assert words_of(df) == brute_words(rows)
    assert bytes_of(df) == brute_bytes(rows)


def test_empty_table(spark):
    assert words_of(frame(spark, [])) == []
    assert bytes_of(frame(spark, [])) == []


def test_long_text_is_cut_without_gaps(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh ") for _ in range(400_000))
    texts = [long[130_900:131_400], long, long[200_000:200_049], "q" * 60 + long[300_000:300_050]]
    got = {r[0]: r for r in bytes_of(frame(spark, texts))}
    assert [got[k][2] for k in range(4)] == [0, 500, 0, 50]


@pytest.mark.parametrize("resolve", [True, False])
def test_one_letter_or_word_over_and_over_stays_small(resolve):
    """Equal pieces of one text travel once with their positions, so a text of one letter shrinks on its way."""
    letters, words = b"a" * 4_000_000, [b"pad"] * 1_000_000
    for runs, size in ((suffix_dedup._runs(letters, 50, 96), len(letters)),
                       (window_dedup._runs(words, window_dedup._WordHash(), 13, 96), 4 * len(words))):
        seg = packed.Segment(96, resolve)
        seg.add(1, 0, runs)
        assert len(seg.doc) < 10
        assert sum(map(len, seg.text)) < 10_000
        blocks = [b for batch in seg.flush() for b in batch.column("block").to_pylist()]
        assert sum(map(len, blocks)) < size / 20
        back = packed.decode_all(blocks)
        assert back.times.sum() == len(back.pos) > 1_000


def test_padded_texts_against_brute_force(spark):
    """Padding of one letter, of short periods and of one word, within and between documents."""
    rng = random.Random(8)
    fill = lambda n: " ".join(rng.choice(("north", "south", "east", "west")) + str(rng.randrange(99)) for _ in range(n))
    pads = ["a" * 700, "ab" * 300, "-=-" * 150, "pad " * 400, "x y " * 150, "a" * 130, "pad " * 30]
    texts = [rng.choice(pads) + fill(rng.randrange(20)) + " " + rng.choice(pads) + fill(3) + rng.choice(pads) for _ in range(30)]
    texts = [pads[0] * 20, fill(5), pads[3] * 5, *texts, "a" * 60, "pad " * 14]
    for ids in (list(range(len(texts))), [k // 2 for k in range(len(texts))]):
        rows = list(zip(ids, texts))
        df = odd_frame(spark, texts, ids)
        assert words_of(df) == brute_words(rows)
        assert bytes_of(df) == brute_bytes(rows)


def test_long_texts_of_one_letter(spark):
    """Megabytes of one letter in several documents and lengths: all but the first and what it lacks go."""
    texts = ["a" * 300_000 + "b" * 49, "a" * 3_000_000 + "b" * 60, "c" + "a" * 2_000_000, "a" * 49, "pad " * 500_000, "pad " * 600_000 + "end"]
    n = [len(t) for t in texts]
    got = {r[0]: r for r in bytes_of(frame(spark, texts))}
    # fifty b's in a row are new, so the eleven b's after the first 49 stay
    assert [got[k][1] for k in range(6)] == n
    assert [got[k][2] for k in range(6)] == [0, 3_000_000 + 49, 2_000_000, 0, 0, 2_400_000]
    got = {r[0]: r for r in words_of(frame(spark, texts))}
    assert [got[k][2] for k in range(6)] == [0, 0, 0, 0, 0, 600_000]


def test_repeat_groups_of_a_repeated_run(spark):
    """Every position of a run that repeats in its own document is reported."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefghijk ") for _ in range(70))
    fill = lambda n: "".join(rng.choice("lmnopqrstu ") for _ in range(n))
    text = fill(30) + passage + fill(30) + passage + fill(30)
    places = [text.index(passage), text.rindex(passage)]
    rows = suffix_dedup.repeat_groups(frame(spark, [text, fill(90)])).collect()
    reach = {r["start"] + j for r in rows for j in range(r["length"])}
    assert all(set(range(p, p + 70)) <= reach for p in places)
    assert all(text.encode().count(text.encode()[r["start"]:r["start"] + r["length"]]) > 1 for r in rows)


def test_window_order_survives_equal_keys(monkeypatch):
    """Windows whose sort keys collide are told apart by their words."""
    import numpy as np
    ids = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3])
    start = np.array([0, 3, 6])
    monkeypatch.setattr(window_dedup, "mix", lambda h: h * np.uint64(0))
    order, new = window_dedup._window_labels(ids, start, 3)
    label = np.empty(3, int)
    label[order] = np.cumsum(new)
    assert label[0] == label[2] != label[1]


def test_maximal_repeats_against_brute_force():
    rng = random.Random(6)
    strings = list(dict.fromkeys("".join(rng.choice("ab") for _ in range(rng.randrange(6, 14))).encode() for _ in range(40)))
    sa = suffix_dedup.SuffixArray(strings, 5)
    got = {}
    for n, lo, hi in sa.maximal_repeats(5):
        k, o = int(sa.string[lo]), int(sa.offset[lo])
        got[strings[k][o:o + n]] = {(int(sa.string[p]), int(sa.offset[p])) for p in range(lo, hi + 1)}
    occ = {}
    for k, s in enumerate(strings):
        for o in range(len(s)):
            for e in range(o + 5, len(s) + 1):
                occ.setdefault(s[o:e], set()).add((k, o))
    want = {}
    for w, places in occ.items():
        if len(places) < 2:
            continue
        left = {strings[k][o - 1] if o else ("start", k) for k, o in places}
        right = {strings[k][o + len(w)] if o + len(w) < len(strings[k]) else ("end", k) for k, o in places}
        if len(left) > 1 and len(right) > 1:
            want[w] = places
    assert got == want


def test_repeat_groups_list_all_occurrences(spark):
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefghijk ") for _ in range(60))
    fill = lambda n: "".join(rng.choice("lmnopqrstu ") for _ in range(n))
    texts = [fill(30) + passage + fill(30) for _ in range(5)]
    rows = suffix_dedup.repeat_groups(frame(spark, texts)).collect()
    for name in {r["repeat"] for r in rows}:
        own = [r for r in rows if r["repeat"] == name]
        assert {r["doc_id"] for r in own} == set(range(5))
        assert len({texts[r["doc_id"]].encode()[r["start"]:r["start"] + r["length"]] for r in own}) == 1
    reach = {r["doc_id"]: set() for r in rows}
    for r in rows:
        reach[r["doc_id"]].update(range(r["start"], r["start"] + r["length"]))
    assert all(len(v) >= 60 for v in reach.values())
