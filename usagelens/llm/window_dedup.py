"""Substring dedup on word windows by super-k-mer partitioning (operator 4).

Every window of ``width`` consecutive words is placed by its minimiser (the
smallest hash among its word triples).  Consecutive windows of a document that
share a minimiser travel together as one packed string to the minimiser's
bucket: a word window costs under three words of shuffle instead of ``width``.
Inside a bucket the windows are sorted and equal ones counted exactly: the sort
key is a hash of dictionary-encoded words, and neighbours are compared word by
word.  A window is a copy when its smallest document is not its own.

Rows: a null text has no words.  A null ``doc_id`` is neither smaller nor
larger than another, so such rows keep all their words and mark none.  Rows
that repeat a ``doc_id`` are separate documents that never mark each other.
Ties (the same window twice in one document) stay.  Only ``doc_id`` and
``text`` are read, so further columns, whatever their names, don't matter.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import has_repeated_ids, stage, text_bytes
from usagelens.llm.packed import (
    BLOCK_SCHEMA,
    RANGE_SCHEMA,
    Segment,
    decode_all,
    merge,
    mix,
    pieces,
    range_table,
    sliding_min,
)

WIDTH = 13
#: words in the hashed gram that orders windows; three, so that a frequent word
#: or word pair does not draw the windows of the whole corpus into one bucket
GRAM = 3
#: text bytes a bucket stands for (about three times as many travel to it)
BUCKET_BYTES = 6 << 20
MIN_BUCKETS = 96
#: windows of the longest run, in window widths (an unrepeated minimiser stays for less than one)
LONGEST = 4
_P = np.uint64(0xC2B2AE3D27D4EB4F)


def buckets_for(n_bytes: int) -> int:
    return max(MIN_BUCKETS, -(-n_bytes // BUCKET_BYTES))


class _WordHash(dict):
    """64-bit hash per word, remembered while a task runs (bounded)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 20:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _runs(words: list[bytes], hashes: _WordHash, width: int, buckets: int):
    """Super-k-mers of one text: (bucket, first word, words, mark, packed words)."""
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    gram = h[:len(h) - GRAM + 1].copy()
    for j in range(1, GRAM):
        gram = gram * _P + h[j:len(h) - GRAM + 1 + j]
    low = sliding_min(mix(gram), width - GRAM + 1)
    first, last = pieces(low, LONGEST * width)
    last = last + (width - 1)
    joined = b" ".join(words)
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
    for b, s, e, x, y in zip((mix(low[first]) % np.uint64(buckets)).tolist(), first.tolist(), last.tolist(),
                             at[first].tolist(), (at[last] - 1).tolist()):
        yield b, s, e - s, e - s, joined[x:y]


def _pack(width: int, buckets: int, tagged: bool):
    def pack(batches):
        seg, hashes = Segment(buckets), _WordHash()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_buffer()
                words = raw.to_pybytes().split() if raw is not None else []
                if doc is None or len(words) < width:
                    continue
                seg.add(doc, zlib.crc32(raw) if tagged else 0, _runs(words, hashes, width, buckets))
                if seg.full:
                    yield from seg.flush()
        yield from seg.flush()
    return pack


def _window_labels(ids: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows and, in that order, whether a new distinct window begins."""
    h = mix(ids.astype(np.uint64))
    parts, size, power = {1: h}, 1, {1: _P}
    with np.errstate(over="ignore"):
        while size * 2 <= width:
            p = parts[size]
            parts[size * 2] = p[:-size] * power[size] + p[size:]
            power[size * 2] = power[size] * power[size]
            size *= 2
        key, done = parts[size][start], size
        for s in sorted(parts, reverse=True)[1:]:
            if done + s <= width:
                key = key * power[s] + parts[s][start + done]
                done += s
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.concatenate(([False], k[1:] == k[:-1]))
    at = np.flatnonzero(same)
    a, b = start[order[at]], start[order[at - 1]]
    equal = np.ones(len(at), bool)
    for j in range(width):
        equal &= ids[a + j] == ids[b + j]
    if not equal.all():     # two different windows share a 64-bit key: sort by the words themselves
        order = np.lexsort([ids[start + j] for j in reversed(range(width))])
        s = start[order]
        same = np.concatenate(([False], np.ones(len(s) - 1, bool)))
        for j in range(width):
            same[1:] &= ids[s[1:] + j] == ids[s[:-1] + j]
    return order, ~same


def _judge(width: int):
    def judge(table: pa.Table) -> pa.Table:
        r = decode_all(table.column("block").to_pylist())
        out = [np.stack([r.done[k] for k in ("doc", "tag", "start", "end")], axis=1)]
        if len(r.doc):
            # runs are joined without a separator: put one after each run's bytes
            raw = np.frombuffer(r.data, np.uint8)
            ends = np.cumsum(r.size.astype(np.int64))
            text = np.insert(raw, ends, 32)
            edge = np.concatenate(([0], np.flatnonzero(text == 32) + 1)).astype(np.int64)
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edge) - 1, [None, pa.py_buffer(edge), pa.py_buffer(text)])
            ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
            n_words = r.mark.astype(np.int64)
            n_win = n_words - (width - 1)
            run = np.repeat(np.arange(len(n_win)), n_win)
            off = np.arange(len(run)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
            start = (np.cumsum(n_words) - n_words)[run] + off
            order, new = _window_labels(ids, start, width)
            doc = r.doc[run[order]]
            low = np.minimum.reduceat(doc, np.flatnonzero(new))
            copy = np.zeros(len(run), bool)
            copy[order] = doc > low[np.cumsum(new) - 1]
            at = np.flatnonzero(copy)
            if len(at):
                begins = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(run[at]) != 0)))
                b = np.flatnonzero(begins)
                e = np.concatenate((b[1:], [len(at)])) - 1
                i, pos = r.at_places(run[at[b]])
                k = run[at[b[i]]]
                out.append(np.stack([r.doc[k], r.tag[k], pos + off[at[b[i]]], pos + off[at[e[i]]] + width], axis=1))
        found = np.concatenate(out)
        return range_table(*found.T)
    return judge


def copied_ranges(docs: DataFrame, width: int = WIDTH, tagged: bool | None = None) -> DataFrame:
    """Word ranges [start, end) of each document that copy a smaller document.

    One row per (doc_id, tag, start, end); ranges of a document may overlap.
    ``tag`` is the text's CRC where ids repeat (so that rows of one id stay
    apart), else 0.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    tagged = has_repeated_ids(docs) if tagged is None else tagged
    buckets = buckets_for(text_bytes(docs))
    blocks = docs.mapInArrow(_pack(width, buckets, tagged), BLOCK_SCHEMA)
    return blocks.groupBy("bucket").applyInArrow(_judge(width), RANGE_SCHEMA)


def join_ranges(docs: DataFrame, ranges: DataFrame, tagged: bool) -> DataFrame:
    """Each document (doc_id, text) with its ranges as an array of (start, end)."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")) \
        .withColumn("tag", F.coalesce(F.crc32("text"), F.lit(0)) if tagged else F.lit(0).cast("long"))
    per_doc = ranges.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    return keyed.join(per_doc, ["doc_id", "tag"], "left").select("doc_id", "text", "ranges")


def row_ranges(batch: pa.RecordBatch):
    """(id, text bytes or None, merged ranges as n x 2 array) for each row of a joined batch."""
    lists = batch.column(2)
    flat = lists.flatten()
    pairs = np.stack([flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)], axis=1) \
        if len(flat) else np.zeros((0, 2), np.int64)
    sizes = np.array([n or 0 for n in lists.value_lengths().to_pylist()], np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
        yield doc, text, merge(pairs[at[i]:at[i + 1]])


def _apply(batches):
    for batch in batches:
        rows = []
        for doc, text, ranges in row_ranges(batch):
            words = (text or b"").split()
            kept, last = [], 0
            for s, e in ranges.tolist():
                kept += words[last:s]
                last = e
            kept += words[last:]
            rest = b" ".join(kept)
            rows.append((doc, len(words), len(words) - len(kept), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "replace")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Remove copied word windows: doc_id, n_words, n_removed, kept_sha256, kept_text.

    Stages the copied ranges once (so that a lost executor does not repeat the
    bucket step), then joins them to the texts.
    """
    tagged = has_repeated_ids(docs)
    ranges = stage(copied_ranges(docs, width, tagged), "window_ranges")
    joined = join_ranges(docs, ranges, tagged)
    return joined.mapInArrow(_apply, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
