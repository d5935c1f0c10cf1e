"""Small corpora for the operator tests."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def frame(spark, texts, ids=None, parts=3):
    """Documents with the given texts; ids count from 0 unless given."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, ("en", "de", None)[k % 3], f"src{k % 4}", len(t) if t is not None else None)
            for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def odd_frame(spark, texts, ids=None):
    """The same with extra columns that bear the operators' own names."""
    from pyspark.sql import functions as F
    df = frame(spark, texts, ids)
    for name in ("n_words", "score", "ranges", "tag", "start", "end", "bucket", "component_id", "kept", "shard",
                 "fingerprint", "n_tokens", "epoch", "leaf", "row", "count", "n_bytes", "domain"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def prose(rng: random.Random, n: int, vocab: int = 300) -> str:
    ends = [" ", " ", " ", " ", "\n", "  ", "\t"]
    return "".join(f"w{rng.randrange(vocab)}é{rng.choice(ends)}" if rng.random() < .1 else f"w{rng.randrange(vocab)}{rng.choice(ends)}"
                   for _ in range(n))


def corpus(seed: int, n: int = 40) -> list:
    """Prose with exact and edited copies, shared passages, repeated lines, nulls and blanks."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(0, 200)) for _ in range(n)]
    passage = prose(rng, 40)
    texts: list = []
    for i, t in enumerate(base):
        texts.append(t)
        if i % 5 == 0:
            texts.append(t)
        if i % 4 == 0:
            w = t.split(" ")
            for _ in range(max(1, len(w) // 30)):
                w[rng.randrange(len(w))] = "edited"
            texts.append(" ".join(w))
        if i % 6 == 0:
            texts.append(prose(rng, 20) + passage + prose(rng, 10))
    texts += ["same words again " * 30, "", None, "   \n ", "one", passage * 40, "x" * 300, "ab" * 200]
    rng.shuffle(texts)
    return texts
