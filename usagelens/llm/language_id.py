"""Language identification by nearest centroid (operator 13).

A text is the TF-IDF vector, of length one, of its letter n-grams: letters are
folded to lower case, everything else is one gap, and all runs of one, two and
three characters with a letter are hashed into ``DIMENSIONS`` bins.  Every
language has up to ``CENTROIDS`` centroids, found by spherical k-means over its
labelled texts, so a language whose texts fall into kinds (prose, lists, code
with comments) keeps a direction for each.  A text gets the language of the
centroid of largest cosine; ``accepted`` tells whether it lies as near to it as
the centroid's own texts did (distance-based rejection).

Fitting takes at most ``SAMPLE`` labelled documents of each language, those of
the smallest hash of their id, whole texts; so it stays bounded however many
rows are labelled.  Languages are fitted apart, each in a task of its own, and
``fit`` returns a model of ``CENTROIDS * DIMENSIONS`` floats a language, whose
number doesn't grow with the rows.  Prediction is one pass over all rows without
a shuffle and reads the text only.

Rows: a null text, or one without a letter, is ``und`` with score 0 and not
accepted.  Labelled rows of these kinds teach nothing.  Ties of cosine go to the
language that is first in order.  Repeated rows and ids are judged row by row;
in the sample, rows of one id stand together within the bound.  Without any
labelled row every text is ``und``.  A very long text is counted in pieces,
exactly.  Only ``doc_id``, ``text`` and, for fitting, ``lang`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import stage

UNKNOWN = "und"
#: hash bins of n-grams of one to three characters
DIMENSIONS = 1 << 13
#: labelled documents of a language that the model is fitted on, at most
SAMPLE = 1000
CENTROIDS = 4
ROUNDS = 10
#: a text is accepted within this multiple of the distance of the centroid's farthest text but one in a hundred
REACH = 1.25
FOLDS = 4
HELD_OUT = 2
_PIECE = 1 << 20
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once in a task's process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _gram(h: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    h = (h ^ c) * _MIX[n]
    return h ^ (h >> np.uint32(15))


def counts(text: str | None) -> np.ndarray | None:
    """N-grams of a text per bin; null without a letter."""
    if not text:
        return None
    out, folded, found = np.zeros(DIMENSIONS, np.int64), text.lower(), False
    seen = np.zeros(0, np.uint32)          # the last places of the piece before
    for lo in range(0, len(folded), _PIECE):
        c = np.frombuffer(folded[lo:lo + _PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where(_letters()[c], c, np.uint32(0))
        found = found or bool(c.any())
        edge = np.zeros(1, np.uint32)      # a text begins and ends in a gap
        c = np.concatenate((seen if lo else edge, c, edge if lo + _PIECE >= len(folded) else edge[:0]))
        c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]        # a gap is one place
        h, new = np.zeros(len(c), np.uint32), len(seen) if lo else 0
        for n in range(min(3, len(c))):
            h = _gram(h[:len(c) - n], c[n:], n)                  # of the n + 1 places from each on
            own = h[max(0, new - n):]                            # those that end in this piece
            if n == 0:
                own = own[c[new:] != 0]
            out += np.bincount(own & np.uint32(DIMENSIONS - 1), minlength=DIMENSIONS)
        seen = c[-2:]
    return out if found else None


def vectors(texts: list, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one; zero without a letter."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for k, t in enumerate(texts):
        if (c := counts(t)) is not None:
            at = np.flatnonzero(c)
            v = (1 + np.log(c[at])) * idf[at]
            out[k, at] = v / np.sqrt((v * v).sum())
    return out


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from fitting, by the CRC-32 of its id."""
    return F.crc32(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def sample(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """lang, place, text: the labelled documents that are fitted on, ``size`` of a language at most."""
    ids = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    ids = ids.withColumn("place", F.xxhash64(F.lit("language sample"), "doc_id"))
    # of a large language only ids below a bound compete: four times as many as are needed.
    # One row a language, as in the model, so it is broadcast; ids are not dealt by language before the bound.
    share = ids.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(4.0 * size) / F.count("*")).alias("share"))
    low = (F.col("place").cast("double") / 2.0 ** 63 + 1) / 2 <= F.col("share")
    first = lambda *order: F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    chosen = ids.join(F.broadcast(share), "lang").where(low).withColumn("r", first("place")).where(F.col("r") <= size) \
        .select("lang", "place", F.col("doc_id").alias("id")).distinct()
    chosen = stage(chosen, "language_ids")
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("_lang"), F.col("text").cast("string").alias("text"))
    texts = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("_lang") == F.col("lang"))).select("lang", "place", "text")
    # repeated ids may have brought more rows than were chosen
    return texts.withColumn("r", first("place", F.md5("text"))).where(F.col("r") <= size).drop("r")


def kmeans(rows: np.ndarray, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of unit rows by cosine, and each row's centroid."""
    rng = np.random.default_rng(seed)
    centre = rows[[int(np.argmax(rows @ rows.mean(axis=0)))]]
    while len(centre) < k:                 # further ones, likelier the farther they lie
        far = np.maximum(0, 1 - (rows @ centre.T).max(axis=1)).astype(np.float64)
        if far.sum() <= 1e-6 * len(rows):
            break
        centre = np.vstack([centre, rows[[int(rng.choice(len(rows), p=far / far.sum()))]]])
    for _ in range(ROUNDS):
        own = (rows @ centre.T).argmax(axis=1)
        sums = np.stack([rows[own == j].sum(axis=0) if (own == j).any() else centre[j] for j in range(len(centre))])
        centre = (sums / np.linalg.norm(sums, axis=1, keepdims=True)).astype(np.float32)
    return centre, (rows @ centre.T).argmax(axis=1)


class Model:
    """idf per bin; languages, unit centroids and reach (distance of acceptance), one row a centroid."""

    def __init__(self, idf, langs, centroids, reach):
        self.idf, self.langs, self.centroids, self.reach = idf, langs, centroids, reach

    def predict(self, texts: list) -> tuple[list, np.ndarray, np.ndarray]:
        """Language, score and acceptance of each text."""
        lang, score, accepted = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        for lo in range(0, len(texts) if self.langs else 0, 256):
            v = vectors(texts[lo:lo + 256], self.idf)
            cosine = v @ self.centroids.T
            best = cosine.argmax(axis=1)
            for k in np.flatnonzero(v.any(axis=1)):
                c = float(cosine[k, best[k]])
                lang[lo + k], score[lo + k], accepted[lo + k] = self.langs[best[k]], min(1.0, max(0.0, c)), 1 - c <= self.reach[best[k]]
        return lang, score, accepted


def fit(docs: DataFrame, size: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """The model of ``docs``'s labelled languages (``lang``); rows with ``held_out`` ids teach nothing."""
    rows = stage(sample(docs, size), "language_sample")

    def bins(batches):
        for b in batches:
            got = [counts(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"bins": pa.array([None if c is None else np.flatnonzero(c) for c in got], pa.list_(pa.int32()))})

    found = rows.select("text").mapInArrow(bins, "bins array<int>").where("bins is not null")
    total = found.count()
    df = np.zeros(DIMENSIONS)
    for r in found.select(F.explode("bins").alias("bin")).groupBy("bin").count().collect():      # one row a bin at most
        df[r.bin] = r["count"]
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)

    def cluster(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("text", "ascending")])
        v = vectors(table.column("text").to_pylist(), idf)
        v = v[v.any(axis=1)]
        if len(v) == 0:
            return table.schema.empty_table().select(["lang"]).append_column("centroid", pa.array([], pa.int32())) \
                .append_column("vector", pa.array([], pa.binary())).append_column("reach", pa.array([], pa.float64()))
        centre, own = kmeans(v, min(centroids, len(v)))
        reach = [REACH * float(np.quantile(1 - v[own == j] @ centre[j], 0.99)) if (own == j).any() else 0.0 for j in range(len(centre))]
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(centre)), "centroid": pa.array(range(len(centre)), pa.int32()),
                         "vector": pa.array([c.tobytes() for c in centre], pa.binary()), "reach": pa.array(reach, pa.float64())})

    made = sorted(rows.groupBy("lang").applyInArrow(cluster, "lang string, centroid int, vector binary, reach double").collect(),
                  key=lambda r: (r.lang, r.centroid))
    centre = np.stack([np.frombuffer(r.vector, np.float32) for r in made]) if made else np.zeros((0, DIMENSIONS), np.float32)
    return Model(idf, [r.lang for r in made], centre, np.array([r.reach for r in made]))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (cosine to the centroid), accepted: one row per row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            lang, score, accepted = held.value.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(accepted)],
                                             names=["doc_id", "lang_pred", "score", "accepted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")
