"""Language identification: brute-force vectors and nearest centroids, held-out accuracy, odd rows."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tests.llm.docs import SCHEMA, odd_frame
from usagelens.llm import language_id as li

SYLLABLES = {"aa": "ka lo mi ren tus vel".split(), "bb": "scho bri zug äl fen ort".split(), "cc": "ñon que ía res ado lla".split()}


def text(rng, lang, n=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def labelled(spark, n=150, odd=()):
    rng = random.Random(5)
    rows = [(i, text(rng, lang := "aa bb cc".split()[i % 3]), lang, "s", 0) for i in range(n)]
    return spark.createDataFrame(rows + list(odd), SCHEMA).repartition(4)


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 4


def grams(s):
    places = []
    for ch in " " + s.lower() + " ":
        ch = ch if ch.isalpha() else " "
        if ch != " " or not places or places[-1] != " ":
            places.append(ch)
    bins = {}
    for n in (1, 2, 3):
        for i in range(len(places) - n + 1):
            g = places[i:i + n]
            if any(c != " " for c in g):
                h = 0
                for k, c in enumerate(g):
                    h = ((h ^ (0 if c == " " else ord(c))) * int(li._MIX[k])) & 0xFFFFFFFF
                    h ^= h >> 15
                bins[h % li.DIMENSIONS] = bins.get(h % li.DIMENSIONS, 0) + 1
    return bins


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_counts_and_vectors_equal_brute_force(monkeypatch, size):
    monkeypatch.setattr(li, "_PIECE", size)          # pieces of a long text
    rng = random.Random(2)
    idf = np.linspace(1, 3, li.DIMENSIONS)
    for t in [text(rng, "cc"), "Ab, 12 cD\n\n  éß?!", "x", "  x  ", "İstanbul STRASSE", "a1b2c3" * 50, "1 2 a", "𝕊 日本語"]:
        want = grams(t)
        got = li.counts(t)
        assert {int(k): int(got[k]) for k in np.flatnonzero(got)} == want
        weighed = {k: (1 + math.log(n)) * idf[k] for k, n in want.items()}
        length = math.sqrt(sum(v * v for v in weighed.values()))
        v = li.vectors([t], idf)[0]
        assert all(abs(v[k] - w / length) < 1e-5 for k, w in weighed.items())
    assert li.counts(None) is None and li.counts("") is None and li.counts("12 !?") is None


def test_nearest_centroid_and_rejection(spark):
    docs = labelled(spark)
    model = li.fit(docs)
    assert sorted(set(model.langs)) == ["aa", "bb", "cc"] and max(map(model.langs.count, model.langs)) > 1
    for r in li.identify(docs, model).join(docs.select("doc_id", "text", "lang"), "doc_id").collect():
        v = li.vectors([r.text], model.idf)[0]
        cosine = [float(np.dot(v, c)) for c in model.centroids]
        k = int(np.argmax(cosine))
        assert r.lang_pred == model.langs[k] == r.lang
        assert r.score == pytest.approx(min(1, max(0, cosine[k])), abs=1e-5)
        assert r.accepted == (1 - cosine[k] <= model.reach[k])
    far = li.identify(docs.limit(1).withColumn("text", F.lit("zzzz wwww zwzw")), model).first()
    assert not far.accepted and far.lang_pred in ("aa", "bb", "cc")


def test_held_out_accuracy_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = li.identify(docs, li.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where(li.held_out(F.col("doc_id"))).collect()
    assert len(got) > 200 and sum(r.lang == r.lang_pred for r in got) >= 0.99 * len(got)


def test_held_out_labels_teach_nothing(spark):
    docs = labelled(spark)
    kept = {r.doc_id for r in docs.where(~li.held_out(F.col("doc_id"))).collect()}
    assert kept == {i for i in range(150) if fold(i) != 2}
    lied = docs.withColumn("lang", F.when(li.held_out(F.col("doc_id")), F.lit("lie")).otherwise(F.col("lang"))) \
        .withColumn("text", F.when(li.held_out(F.col("doc_id")), F.lit("lie lie")).otherwise(F.col("text")))
    a, b = li.fit(docs), li.fit(lied)
    assert a.langs == b.langs and np.array_equal(a.centroids, b.centroids) and np.array_equal(a.idf, b.idf)


def test_odd_rows_and_clashing_columns(spark):
    odd = [(None, None, None, None, None), (900, None, "aa", "s", 0), (901, "", "bb", "s", 0), (902, "12 34 !", "dd", "s", 0),
           (903, "ka lo mi", None, "s", 0), (7, "ka lo mi", "aa", "s", 0), (7, "ka lo mi", "aa", "s", 0), (904, "scho briäl " * 200_000, "bb", "s", 0)]
    docs = labelled(spark, odd=odd)
    for name in ("lang_pred", "score", "accepted", "place", "id", "share", "r", "bins"):
        docs = docs.withColumn(name, F.lit("clash"))
    out = li.identify(docs, li.fit(docs)).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert len(out) == 158 and len(by[7]) == 3
    for i in (None, 900, 901, 902):
        assert [(r.lang_pred, r.score, r.accepted) for r in by[i]] == [("und", 0.0, False)]
    assert by[903][0].lang_pred == "aa" and by[904][0].lang_pred == "bb"


def test_no_labels_and_empty_table(spark):
    docs = labelled(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in li.identify(docs, li.fit(docs)).collect()} == {"und"}
    none = docs.where("false")
    assert li.identify(none, li.fit(none)).collect() == []
    assert li.identify(odd_frame(spark, ["12", None]), li.fit(labelled(spark))).select("lang_pred").distinct().collect()[0][0] == "und"


def test_the_sample_is_bounded_and_does_not_depend_on_partitions(spark):
    docs = labelled(spark, odd=[(3, f"ka lo {k}", "aa", "s", 0) for k in range(300)])
    one, two = li.sample(docs, 20), li.sample(docs.repartition(9), 20)
    assert {r.lang: r["count"] for r in one.groupBy("lang").count().collect()} == {"aa": 20, "bb": 20, "cc": 20}
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
