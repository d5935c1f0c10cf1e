"""Fill-in-middle: brute force per row and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.docs import corpus, frame, odd_frame
from usagelens.llm import fill_in_middle as fim


def brute(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    hexes = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[8 * k:8 * k + 8], 16) for k in range(4)]
    u = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in fim.SENTINELS) or h[2] % 100 >= rate:
        return len(u), "plain", None, None, text
    return (len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm_rate else (len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def lines(seed, n=120):
    rng = random.Random(seed)
    parts = ["a", "é", "\n", "\n\n", "\r", " ", "<", "<P", "S>", "<<M", " ", "\x00", "𝕊", "word"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)] + [
        "", None, "\n", "one line", "x<P>y\nz", "<S>", "tail<M>", "a\nb", "<P\n>\n", "\n" * 500, "q" * 300_000, ("r" * 99 + "\n") * 5000]


@pytest.mark.parametrize(("rate", "spm_rate"), [(100, 50), (60, 0), (0, 50), (100, 100)])
def test_brute_force_and_round_trip(spark, rate, spm_rate):
    texts = lines(1) + corpus(3)
    df = frame(spark, texts)
    out = fim.restored(fim.transform(df, rate=rate, spm_rate=spm_rate)).select("doc_id", "fim.*", "restored")
    seen = 0
    for r in out.collect():
        text = texts[r.doc_id]
        assert tuple(r)[1:6] == brute(r.doc_id, text, rate=rate, spm_rate=spm_rate)
        assert r.restored == (text or "")
        seen += 1
    assert seen == len(texts)


def test_other_columns_stay_and_clashes_do_not_matter(spark):
    texts = ["one\ntwo\nthree", None, "x<M>"]
    df = odd_frame(spark, texts, [4, None, 4]).withColumnRenamed("row", "_row").withColumnRenamed("count", "a b.c")
    out = fim.transform(df)
    assert out.columns == [c for c in df.columns if c != "text"] + ["fim"]
    got = {r.n_chars: tuple(r.fim) for r in out.collect()}
    assert got == {len(t) if t is not None else None: brute(i, t) for i, t in zip([4, None, 4], texts)}
    assert {r["a b.c"] for r in out.collect()} == {"clash"}


def test_empty_table(spark):
    assert fim.restored(fim.transform(frame(spark, []))).collect() == []


def test_units_of_one_batch_without_rows_or_text():
    assert fim.units(pa.array([], pa.string())).to_pylist() == []
    assert fim.units(pa.array(["", "\n", "a\nb", "a\n\n"])).to_pylist() == [[], ["\n"], ["a\n", "b"], ["a\n", "\n"]]
    made = fim.arrange(pa.array(["", ""]), [np.zeros(2, np.int64)] * 4)
    assert made["form"].to_pylist() == ["plain", "plain"]
