"""Benchmark decontamination by greedy string tiling (operator 7).

Test items and documents are cut into words (A-Z lower-cased, punctuation
aside).  Hashes of five words, taken anew at each position, find seeds: places
of a document whose five words stand in an item too; the words themselves are
compared, so a hash collision is no seed.  A place is one seed for an item
however often the item repeats the words, so a word that both texts repeat
costs one row a place, never a product of places.  Only documents with enough
seeds to reach the coverage threshold become candidates.

For each candidate, greedy string tiling repeatedly marks the longest match
that overlaps no earlier one, found by a running Karp-Rabin search: rolling
hashes of all unmarked windows of a length, of the document's seeded words and
of the item, are compared, the length is bisected, and equal hashes are verified
word by word before they are marked.  Each pass uses a smaller length and marks
at least that many words of the item, so an item of m words takes at most about
the square root of 2 m passes, each in n log n of the two texts' words.  An item
is leaked if its tiles cover enough of its words; the tiles may stand in any
order, so reordered passages are caught.

Rows: a null or blank text has no words.  Items shorter than five words can't
be told from chance and are never found.  Rows with a null or repeated
``doc_id`` are judged like any other; equal rows are judged once.  Items that
share an ``item_id`` are items of their own; equal ones are judged once.  Only
``doc_id`` and ``text`` (of items: ``item_id`` and ``text``) are read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ascii_lower, stage
from usagelens.llm.packed import mix

#: words of the shortest tile
MIN_MATCH = 5
#: share of an item's words that tiles must cover
MIN_COVERAGE = 0.5
#: base of the rolling hash (odd, so that it can be undone modulo 2^64)
BASE = 0x9E3779B97F4A7C15
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _gram(words: str, at: Column, width: int) -> list[Column]:
    return [F.get(words, at + j) for j in range(width)]


def item_words(items: DataFrame, width: int = MIN_MATCH) -> DataFrame:
    """(item_id, item_tag, n_item, words): the distinct test items of at least ``width`` words."""
    return items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("item_tag"),
                        plain_words(F.col("text")).alias("words")).withColumn("n_item", F.size("words").cast("long")) \
        .where(F.col("n_item") >= width).dropDuplicates(["item_id", "item_tag"])


def item_grams(words: DataFrame, width: int = MIN_MATCH) -> DataFrame:
    """(item_id, item_tag, n_item, gram, hash, q, times): each distinct word gram of an item, its first place and count."""
    at = words.select("item_id", "item_tag", "n_item", "words", F.posexplode_outer("words").alias("q", "w0"))
    return at.where(F.col("q") <= F.col("n_item") - width).select(
        "item_id", "item_tag", "n_item", "q", F.array(*_gram("words", F.col("q"), width)).alias("gram")) \
        .groupBy("item_id", "item_tag", "n_item", "gram").agg(F.min("q").alias("q"), F.count("*").alias("times")) \
        .withColumn("hash", F.xxhash64(*_gram("gram", F.lit(0), width)))


def seeds(docs: DataFrame, words: DataFrame, width: int = MIN_MATCH) -> DataFrame:
    """(doc_id, tag, item_id, item_tag, n_item, p, q, times): word p of the document begins a gram first found at word q of the item.

    Item grams are staged, so that Spark knows their size: it broadcasts them
    below its threshold and shuffles both sides above it.  A position of a
    document joins with its own five words only, never with the whole text.
    """
    grams = stage(item_grams(words, width), "item_grams")
    w = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tag"),
                    plain_words(F.col("text")).alias("words"))
    # the outer form: the plain one would have the words cut twice, once to test for emptiness
    at = w.select("doc_id", "tag", "words", F.posexplode_outer("words").alias("p", "w0")) \
        .where(F.get("words", F.col("p") + (width - 1)).isNotNull())
    own = _gram("words", F.col("p"), width)
    own = at.select("doc_id", "tag", "p", F.xxhash64(*own).alias("own_hash"), F.array(*own).alias("own_gram"))
    return own.join(grams, (F.col("own_hash") == grams.hash) & (F.col("own_gram") == grams.gram)) \
        .select("doc_id", "tag", "item_id", "item_tag", "n_item", "p", "q", "times").distinct()


class _Rolling:
    """One text under search: word numbers, marked words and rolling hashes of its free windows."""

    def __init__(self, words: np.ndarray, powers: np.ndarray, marked: np.ndarray):
        self.words, self.powers, self.marked = words, powers, marked
        with np.errstate(over="ignore"):
            term = mix(words.astype(np.uint64) + np.uint64(1)) * powers[:len(words)]
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)))

    def free(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of n unmarked words, in order, and their hashes."""
        used = np.concatenate(([0], np.cumsum(self.marked)))
        at = np.flatnonzero(used[n:] == used[:-n])
        # a window's sum is lifted to one power, so that its place no longer counts
        return at, (self.sums[at + n] - self.sums[at]) * self.powers[len(self.powers) - 1 - at]


def tiles(a: np.ndarray, b: np.ndarray, width: int = MIN_MATCH, gaps: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two texts given as word numbers: (place in a, place in b, words), longest first.

    Ties go to the smaller place in ``a``, then in ``b``.  No tile touches a
    word of ``a`` marked in ``gaps``.
    """
    most = max(len(a), len(b))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(most, BASE, np.uint64))), dtype=np.uint64)
    x = _Rolling(a, powers, np.zeros(len(a), bool) if gaps is None else gaps.copy())
    y = _Rolling(b, powers, np.zeros(len(b), bool))
    out, top = [], min(len(a), len(b))
    while top >= width:
        low, high = width - 1, top + 1      # matches of `low` words may exist, of `high` words none do
        while high - low > 1:
            n = (low + high) // 2
            if np.isin(x.free(n)[1], y.free(n)[1]).any():
                low = n
            else:
                high = n
        if low < width:
            return out
        out += _mark(x, y, low)
        top = low - 1
    return out


def _mark(x: _Rolling, y: _Rolling, n: int) -> list[tuple[int, int, int]]:
    """Mark every match of n words, each verified, in order of the places."""
    at, key = x.free(n)
    places, keys = y.free(n)
    here = np.isin(key, keys)
    wanted = np.isin(keys, key)
    waiting: dict[int, list[int]] = {}
    for k, j in zip(keys[wanted][::-1].tolist(), places[wanted][::-1].tolist()):
        waiting.setdefault(k, []).append(j)         # the smallest place is last
    out, end = [], 0
    for i, k in zip(at[here].tolist(), key[here].tolist()):
        if i < end:
            continue
        rest, other = waiting[k], []
        while rest:
            j = rest.pop()
            if y.marked[j:j + n].any():
                continue                            # a marked word stays marked
            if not np.array_equal(x.words[i:i + n], y.words[j:j + n]):
                other.append(j)                     # equal hashes of different words
                continue
            out.append((i, j, n))
            x.marked[i:i + n] = y.marked[j:j + n] = True
            end = i + n
            break
        rest += other[::-1]
    return out


def seeded_words(p: np.ndarray, q: np.ndarray, item: np.ndarray, width: int = MIN_MATCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of a document that its seeds cover, taken from the item: word numbers, their places, gaps between stretches."""
    step = np.arange(width)
    place, first = np.unique((p[:, None] + step).ravel(), return_index=True)
    words = item[(q[:, None] + step).ravel()[first]]
    slot = np.arange(len(place)) + np.cumsum(np.diff(place, prepend=place[0]) > 1)
    gaps = np.ones(slot[-1] + 1, bool)
    gaps[slot] = False
    out, at = np.zeros(len(gaps), np.int64), np.zeros(len(gaps), np.int64)
    out[slot], at[slot] = words, place
    return out, at, gaps


_TILED = "doc_id long, tag long, item_id long, n_item long, n_covered long, n_tiles long, longest long, first_word long, last_word long"


def _tile(width: int):
    names = [c.split()[0] for c in _TILED.split(", ")]

    def tile(table: pa.Table, texts: pa.Table) -> pa.Table:
        item = texts.column("words").combine_chunks()[0].values.dictionary_encode().indices.to_numpy().astype(np.int64)
        p, q = (table.column(c).to_numpy().astype(np.int64) for c in ("p", "q"))
        words, at, gaps = seeded_words(p, q, item, width)
        found = [(int(at[i]), n) for i, _, n in tiles(words, item, width, gaps)]
        head = [table.column(c)[0].as_py() for c in ("doc_id", "tag", "item_id")]
        row = [*head, len(item), sum(n for _, n in found), len(found), max(n for _, n in found),
               min(i for i, _ in found), max(i + n - 1 for i, n in found)]
        return pa.table({k: pa.array([v], pa.int64()) for k, v in zip(names, row)})
    return tile


def leaks(docs: DataFrame, items: DataFrame, min_coverage: float = MIN_COVERAGE, width: int = MIN_MATCH) -> DataFrame:
    """Documents that contain a test item, one row per document and item.

    doc_id, tag, item_id, n_item, n_covered, n_tiles, longest, first_word,
    last_word (of the document), coverage.
    """
    words = stage(item_words(items, width), "item_words")
    found = stage(seeds(docs, words, width), "seeds")
    # tiles of n words hold n - width + 1 >= n / width seeds of the item, so fewer can't cover enough
    key = ["doc_id", "tag", "item_id", "item_tag"]
    able = found.groupBy(*key, "q").agg(F.max("times").alias("times"), F.max("n_item").alias("n_item")) \
        .groupBy(*key).agg(F.sum("times").alias("n"), F.max("n_item").alias("n_item")) \
        .where(F.col("n") * width >= F.col("n_item") * min_coverage).select(*key)
    other = able.select(*[F.col(k).alias(f"{k}_") for k in key])
    rows = found.select(*key, "p", "q").join(other, _same(key), "left_semi")
    texts = other.select("item_id_", "item_tag_", F.col("doc_id_").alias("doc_id"), F.col("tag_").alias("tag")) \
        .join(words.select("item_id", "item_tag", "words"), _same(key[2:])).select(*key, "words")
    return rows.groupBy(*key).cogroup(texts.groupBy(*key)).applyInArrow(_tile(width), _TILED) \
        .withColumn("coverage", F.col("n_covered") / F.col("n_item")).where(F.col("coverage") >= min_coverage)


def _same(key: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in key])


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that contain a test item, with their columns as they were."""
    bad = stage(leaks(docs, items).select("doc_id", "tag").distinct(), "leaks")
    row = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                      F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tag"))
    return row.join(bad, row.id.eqNullSafe(bad.doc_id) & (row.tag == bad.tag), "left_anti").select("row.*")
