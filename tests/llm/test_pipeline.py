"""The pipeline against the brute-force versions of its stages."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.docs import SCHEMA, corpus, frame
from tests.llm.test_decontam import brute_leaks
from tests.llm.test_quality import brute_counts
from tests.llm.test_simhash import brute_components, brute_print
from usagelens.llm import decontam, mixing, quality, sharding


def bench(spark, tmp_path, items):
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")


def test_stages_against_brute_force(spark, tmp_path):
    texts = corpus(51, 40)
    item = " ".join(f"secret{k}" for k in range(20))
    texts += [texts[0] + " " + item, "clean words of a text that says nothing at all twice over " + "or so it seems to me today"]
    bench(spark, tmp_path, [item, "short one"])
    docs = frame(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}

    out = docs
    kept = []
    for _, step in corpus_pipeline.STAGES[:3]:
        out = step(spark, out, str(tmp_path))
        assert out.columns == SCHEMA.names
        kept.append({r.doc_id for r in out.collect()})
    verdict = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert kept[0] == {i for i in rows if verdict[i]} and not [i for i in kept[0] if brute_counts(rows[i])[-1]]
    ids = sorted(kept[0])
    assert kept[1] == set(brute_components([brute_print(rows[i]) for i in ids], ids))
    assert kept[2] == {i for i in kept[1] if not brute_leaks(rows[i], [item, "short one"])}
    assert len(texts) - 2 not in kept[2] and len(texts) - 1 in kept[2]

    mixed = corpus_pipeline.source_mix(spark, out, str(tmp_path))
    drawn = Counter(r.doc_id for r in mixing.mix(out).collect())
    assert Counter(r.doc_id for r in mixed.collect()) == drawn and set(drawn) <= kept[2]
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.text) for r in final) == Counter({(i, rows[i]): n for i, n in drawn.items()})
    load = Counter()
    for r in final:
        load[r.placed.shard, r.placed.page] += r.placed.n_bytes
    assert max(load.values()) <= sharding.LIMIT_BYTES


def test_empty_and_odd_tables(spark, tmp_path):
    bench(spark, tmp_path, ["a benchmark item of some more words than five"])
    empty = frame(spark, [])
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, empty, str(tmp_path)).collect() == [], name
    odd = frame(spark, [None, "", "x y z " * 20, None, "x y z " * 20], [None, None, 3, None, 3]) \
        .withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string"))
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, odd, str(tmp_path)).collect()
        assert len(out) <= 5 * mixing.MAX_EPOCHS, name
    assert decontam.keep_clean(odd, spark.createDataFrame([], "item_id long, text string")).count() == 5
