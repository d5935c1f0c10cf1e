"""Quality rules by distribution divergence (operator 9).

Every document is summed up by two histograms: character classes and common
words.  The histograms of a language's documents that pass the base rules add
up to that language's reference; a document whose Jensen-Shannon distance from its
reference is too large (capitals only, symbol noise, word lists without
function words) is rejected.  Guards keep texts that are too short to judge,
and references gathered from too little text give way to the whole corpus.

Two base rules come first: too few words, or too large a share of words in
repeated five-word windows.

Rows: a null or blank text has no words and fails the base rule.  A null or
rare language is compared with the whole corpus.  Repeated rows and ids are
judged row by row.  Only ``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import stage

MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20
#: guards: characters and words below which a document's histogram says nothing
MIN_CHARS_JUDGED = 200
MIN_WORDS_JUDGED = 60
#: characters a language's reference is gathered from, at least
MIN_REFERENCE_CHARS = 20_000
#: Jensen-Shannon distances (0 to 1) above which a document is rejected, chosen between what
#: was measured on labelled documents: of good ones 99 % lie below 0.19 (characters) and 0.30
#: (words); shouted text begins at 0.35 of the one, text cut up by symbols at 0.47 of the other
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.40

# Common words of English, German, French and Spanish.
COMMON_WORDS = (
    "the of and to in a is that for it was on are as with they be at this have from or had by not but what all were when "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch an nach wie aus bei "
    "le la les de du des et en un une que qui dans pour sur par pas au avec est ce il ne se "
    "el los las y del que por con una su para como más lo al sus pero ha"
).split()
SYMBOLS = b"#*$%&|<>"
# Character classes; white space is left out, letters beyond ASCII are one class.
CLASSES = ("lower", "upper", "digit", "beyond_ascii", "point", "symbol", "other")

_CLASS = np.full(256, CLASSES.index("other"))
_CLASS[[*range(97, 123)]] = CLASSES.index("lower")
_CLASS[[*range(65, 91)]] = CLASSES.index("upper")
_CLASS[[*range(48, 58)]] = CLASSES.index("digit")
_CLASS[[*range(192, 256)]] = CLASSES.index("beyond_ascii")
_CLASS[[*b".,;:!?'\"()-"]] = CLASSES.index("point")
_CLASS[[*SYMBOLS]] = CLASSES.index("symbol")
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_TAIL = np.zeros(256, bool)
_TAIL[128:192] = True
# bin 0: every other word; the last bin: words of punctuation and symbols alone
_BINS = {w.encode(): k for k, w in enumerate([*dict.fromkeys(COMMON_WORDS), ""], 1)}
N_BINS = len(_BINS) + 1
_STRIP = b".,;:!?'\"()-" + SYMBOLS


class _Bin(dict):
    """Histogram bin per word as written, remembered while a task runs (bounded)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 20:
            self.clear()
        b = self[word] = _BINS.get(word.decode("utf-8", "replace").lower().encode().strip(_STRIP), 0)
        return b


def repeated_words(ids: np.ndarray, width: int = REPEAT_WINDOW) -> int:
    """Words covered by a window of ``width`` words that stands twice or more."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    base = int(ids.max()) + 1
    if base ** width < 1 << 62:        # the windows fit into one number each
        key = np.zeros(n, np.int64)
        for j in range(width):
            key = key * base + ids[j:j + n]
    else:                           # number ever longer windows
        key = ids[:n]
        for j in range(1, width):
            key = np.unique(key * base + ids[j:j + n], return_inverse=True)[1].astype(np.int64)
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
    step = np.zeros(n + width, np.int64)
    at = np.flatnonzero(hit)
    step[at] += 1
    step[at + width] -= 1
    return int((np.cumsum(step) > 0).sum())


def measure(text: bytes, bins: dict) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class and word histograms."""
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    solid = np.where(_SPACE | _TAIL, 0, count)
    words = text.split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    by_bin = np.bincount(np.fromiter(map(bins.__getitem__, number), np.int64, len(number)),
                         weights=np.bincount(ids, minlength=len(number)) if len(ids) else np.zeros(0), minlength=N_BINS)
    return (len(words), int(solid.sum()), int(count[[*SYMBOLS]].sum()), len(lines) - len(set(lines)),
            repeated_words(ids) if len(ids) else 0,
            np.bincount(_CLASS, weights=solid, minlength=len(CLASSES)).astype(np.int64), by_bin.astype(np.int64))


_MEASURES = ("doc_id long, tag long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, classes array<long>, common array<long>")


def _measure(batches):
    bins = _Bin()
    for b in batches:
        got = [measure(t or b"", bins) for t in b.column(3).to_pylist()]
        cols = [b.column(0), b.column(1), b.column(2)]
        cols += [pa.array([g[k] for g in got], pa.int64()) for k in range(5)]
        cols += [pa.array([g[k] for g in got], pa.list_(pa.int64())) for k in (5, 6)]
        yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in _MEASURES.split(", ")])


def measures(docs: DataFrame) -> DataFrame:
    """Counts and histograms of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"),
                       F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(_measure, _MEASURES)


def base_failed() -> Column:
    """The base rules on a row of measures."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def references(rows: DataFrame) -> DataFrame:
    """ref (a language, or '*' for the whole corpus) with the summed histograms of its documents.

    Documents that fail the base rules are no reference for others.  Languages
    with less than ``MIN_REFERENCE_CHARS`` characters have none.
    """
    rows = rows.where(~base_failed())
    parts = []
    for name in ("classes", "common"):
        parts.append(rows.select("lang", F.lit(name).alias("kind"), F.posexplode(name).alias("bin", "n")))
    sums = parts[0].unionAll(parts[1]).groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n"))
    total = sums.groupBy("kind", "bin").agg(F.sum("n").alias("n")).withColumn("lang", F.lit("*")).select("lang", "kind", "bin", "n")
    ordered = lambda kind: F.transform(
        F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("bin", "n")))), lambda x: x["n"])
    out = sums.where("lang is not null and lang <> '*'").unionAll(total).groupBy("lang") \
        .agg(ordered("classes").alias("ref_classes"), ordered("common").alias("ref_common"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.withColumn("ref_chars", total("ref_classes")).withColumn("ref_words", total("ref_common")) \
        .where((F.col("lang") == "*") | (F.col("ref_chars") >= MIN_REFERENCE_CHARS)).withColumnRenamed("lang", "ref")


def js_distance(p: Column, p_total: Column, q: Column, q_total: Column) -> Column:
    """Jensen-Shannon distance (root of the divergence in bits, 0 to 1) of two
    histograms with their totals; null if one is empty."""
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    share = lambda h, n: F.transform(h, lambda x: F.try_divide(x.cast("double"), n))
    parts = F.zip_with(share(p, p_total), share(q, q_total), lambda x, y: (term(x, (x + y) / 2) + term(y, (x + y) / 2)) / 2)
    sum_ = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.when((p_total > 0) & (q_total > 0), F.sqrt(F.greatest(F.least(sum_, F.lit(1.0)), F.lit(0.0))))


def judge(docs: DataFrame) -> DataFrame:
    """Counts, distances and verdict of every row.

    doc_id, tag, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    char_distance, word_distance, base_failed, kept.
    """
    rows = stage(measures(docs), "measures")
    refs = stage(references(rows), "references")
    own = rows.join(refs.where("ref <> '*'"), F.col("lang") == F.col("ref"), "left")
    # the reference of the whole corpus is one row of two short arrays
    whole = refs.where("ref = '*'").select("ref_classes", "ref_common").first()
    own_or = lambda c, k: F.coalesce(c, F.lit([int(x) for x in whole[k]] if whole else []).cast("array<long>"))
    total_or = lambda c, k: F.coalesce(c, F.lit(sum(whole[k]) if whole else 0).cast("long"))
    # a row's class histogram adds up to its word_chars, its word histogram to its n_words
    out = own.withColumn("char_distance", js_distance(F.col("classes"), F.col("word_chars"), own_or("ref_classes", 0), total_or("ref_chars", 0))) \
        .withColumn("word_distance", js_distance(F.col("common"), F.col("n_words"), own_or("ref_common", 1), total_or("ref_words", 1)))
    failed = base_failed()
    odd_chars = (F.col("word_chars") >= MIN_CHARS_JUDGED) & (F.col("char_distance") > MAX_CHAR_DISTANCE)
    odd_words = (F.col("n_words") >= MIN_WORDS_JUDGED) & (F.col("word_distance") > MAX_WORD_DISTANCE)
    return out.select("doc_id", "tag", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "char_distance", "word_distance", failed.alias("base_failed"),
                      (~failed & ~F.coalesce(odd_chars, F.lit(False)) & ~F.coalesce(odd_words, F.lit(False))).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they were."""
    good = stage(judge(docs).where("kept").select("doc_id", "tag").distinct(), "kept")
    row = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("tag"))
    return row.join(good, row.id.eqNullSafe(good.doc_id) & (row.tag == good.tag), "left_semi").select("row.*")
