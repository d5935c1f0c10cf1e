"""Substring dedup on bytes by a common-prefix interval tree (operator 5).

Texts are cut into runs of consecutive ``min_bytes`` windows that share a
minimiser (the smallest hash among their 16-byte grams) and travel to the
minimiser's bucket as byte strings.  A repeat of ``min_bytes`` or more always
meets in a bucket.  There the distinct strings around each minimiser enter a
suffix array with its table of common prefixes; one stack scan walks the
tree of common-prefix intervals, keeps those of ``min_bytes`` or more whose
occurrences are preceded by different bytes (maximal repeats), and reports
each with all its occurrences, not just neighbours in the array.

The suffix array of a bucket holds only strings around a minimiser that has
several different ones.  Identical strings are one entry with several
occurrences, and a string alone at its minimiser repeats nothing else.

Rows: a null text is empty.  A null ``doc_id`` is neither smaller nor larger
than another, so such rows keep all bytes and mark none.  Rows that repeat a
``doc_id`` are separate documents that never mark each other.  Only ``doc_id``
and ``text`` are read, so further columns, whatever their names, don't matter.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import replace
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import has_repeated_ids, stage, text_bytes
from usagelens.llm.packed import BLOCK_SCHEMA, RANGE_SCHEMA, Runs, Segment, decode_all, mix, pieces, range_table, sliding_min
from usagelens.llm.window_dedup import buckets_for, join_ranges, row_ranges

MIN_BYTES = 50
GRAM = 16
#: bytes of text hashed at a time, so that the working arrays stay in cache
_SLICE = 1 << 17
_P = np.uint64(0x9FB21C651E98DF25)


def _gram_hashes(a: np.ndarray) -> np.ndarray:
    h, p, s = mix(a.astype(np.uint64) + np.uint64(1)), _P, 1
    with np.errstate(over="ignore"):
        while s < GRAM:
            h = h[:-s] * p + h[s:]
            p, s = p * p, s * 2
    return mix(h)


def _runs(text: bytes, width: int, buckets: int):
    """Runs of one text: (bucket, first byte, bytes, minimiser's offset, bytes of the run)."""
    whole = np.frombuffer(text, np.uint8)
    step = _SLICE - width + 1
    for base in range(0, max(1, len(whole) - width + 1), step):
        part = whole[base:base + _SLICE]
        g = _gram_hashes(part)
        # the low bits hold the gram's place, so a run knows where its minimiser stands
        g = (g & ~np.uint64(63)) | (np.arange(len(g), dtype=np.uint64) & np.uint64(63))
        low = sliding_min(g, width - GRAM + 1)
        first, last = pieces(low, width - GRAM + 1)
        last = last + (width - 1)
        top = low[first]
        offset = ((top & np.uint64(63)).astype(np.int64) - first) & 63
        bucket = (mix(top >> np.uint64(6)) % np.uint64(buckets)).tolist()
        for b, s, e, o in zip(bucket, (first + base).tolist(), (last + base).tolist(), offset.tolist()):
            yield b, s, e - s, o, text[s:e]


def _pack(width: int, buckets: int, tagged: bool, resolve: bool):
    def pack(batches):
        seg = Segment(buckets, resolve)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if doc is None or text is None or len(text) < width:
                    continue
                seg.add(doc, zlib.crc32(text) if tagged else 0, _runs(text, width, buckets))
                if seg.full:
                    yield from seg.flush()
        yield from seg.flush()
    return pack


def _shared_minimiser(r: Runs, at: np.ndarray) -> np.ndarray:
    """Run numbers ordered by minimiser, and group edges, of minimisers that several runs have."""
    text = np.frombuffer(r.data, np.uint8)
    gram = text[(at + r.mark)[:, None] + np.arange(GRAM)].view(np.uint64)
    order = np.lexsort((gram[:, 1], gram[:, 0]))
    g = gram[order]
    new = np.concatenate(([True], (g[1:] != g[:-1]).any(axis=1)))
    edge = np.concatenate((np.flatnonzero(new), [len(order)]))
    return order, edge


class SuffixArray:
    """Suffixes of at least ``width`` bytes of short strings, sorted, with common-prefix lengths."""

    def __init__(self, strings: list[bytes], width: int):
        size = np.array([len(s) for s in strings], np.int64)
        cells = -(-int(size.max()) // 8) + 1
        n_suf = size - (width - 1)
        self.string = np.repeat(np.arange(len(strings)), n_suf)
        self.offset = np.arange(len(self.string)) - np.repeat(np.cumsum(n_suf) - n_suf, n_suf)
        start = (np.cumsum(size) - size)[self.string] + self.offset
        self.rest = size[self.string] - self.offset
        text = np.concatenate((np.frombuffer(b"".join(strings), np.uint8), np.zeros(8 * cells + 8, np.uint8)))
        word = np.lib.stride_tricks.sliding_window_view(text, 8)
        keys = []
        for c in range(cells):      # eight bytes at a time, big-endian, zero beyond the string's end
            k = word[start + 8 * c].copy().view(">u8").reshape(-1).astype(np.uint64)
            short = np.clip(8 * (c + 1) - self.rest, 0, 8)
            k = np.where(short >= 8, np.uint64(0), (k >> (8 * np.minimum(short, 7)).astype(np.uint64)) << (8 * np.minimum(short, 7)).astype(np.uint64))
            keys.append(k)
        order = np.lexsort([self.rest, *reversed(keys)])
        self.string, self.offset, self.rest, start = (x[order] for x in (self.string, self.offset, self.rest, start))
        lcp, open_ = np.zeros(len(order), np.int64), np.ones(len(order), bool)
        open_[0] = False
        for k in keys:
            k = k[order]
            d = k ^ np.concatenate((k[:1], k[:-1]))
            same = np.where(d == 0, 8, 0)
            hard = np.flatnonzero(d)
            for s in range(8):
                differ = (d[hard] >> np.uint64(56 - 8 * s)) > 0
                same[hard[differ]] = s
                hard = hard[~differ]
            lcp += np.where(open_, same, 0)
            open_ &= same == 8
        lcp[1:] = np.minimum(lcp[1:], np.minimum(self.rest[1:], self.rest[:-1]))
        lcp[0] = 0
        self.lcp = lcp
        # the byte before each suffix; a string's first suffix may extend to the left in any way
        self.left = np.where(self.offset > 0, text[start - 1].astype(np.int64), -1 - self.string)

    def maximal_repeats(self, width: int):
        """Stack scan over the interval tree: (length, first, last) of each left-diverse interval.

        ``first`` and ``last`` are positions in the array, both included.  An
        interval is left-diverse if two of its suffixes are preceded by
        different bytes; then the repeat can't be extended to the left.
        """
        lcp = self.lcp
        deep = np.flatnonzero(lcp >= width)
        if len(deep) == 0:
            return
        # each stretch of neighbours with long common prefixes is one tree of its own
        begin = np.concatenate(([True], np.diff(deep) != 1))
        edges = np.concatenate((np.flatnonzero(begin), [len(deep)]))
        for k in range(len(edges) - 1):
            lo, hi = int(deep[edges[k]]) - 1, int(deep[edges[k + 1] - 1])
            if hi == lo + 1:        # a tree of two leaves
                if self.left[lo] != self.left[hi]:
                    yield int(lcp[hi]), lo, hi
                continue
            left = self.left[lo:hi + 1].tolist()
            heights = lcp[lo + 1:hi + 1].tolist()
            stack: list[list] = []      # length, first, the one left byte or None if diverse
            leaf = left[0]
            for i, h in enumerate(heights, 1):
                first, seen = i - 1, leaf
                while stack and stack[-1][0] > h:
                    length, first, mark = stack.pop()
                    mark = mark if mark == seen else None
                    if mark is None:
                        yield length, lo + first, lo + i - 1
                    seen = mark
                if stack and stack[-1][0] == h:
                    stack[-1][2] = stack[-1][2] if stack[-1][2] == seen else None
                else:
                    stack.append([h, first, seen])
                leaf = left[i]
            seen = leaf
            while stack:
                length, first, mark = stack.pop()
                mark = mark if mark == seen else None
                if mark is None:
                    yield length, lo + first, hi
                seen = mark


def _distinct(r: Runs, at: np.ndarray):
    """For each minimiser with several runs: its distinct strings and their runs."""
    order, edge = _shared_minimiser(r, at)
    many = np.flatnonzero(np.diff(edge) > 1)
    data, end = r.data, at + r.size
    for lo, hi in zip(edge[many].tolist(), edge[many + 1].tolist()):
        runs = order[lo:hi]
        by: dict[bytes, list[int]] = {}
        for i, s, e in zip(runs.tolist(), at[runs].tolist(), end[runs].tolist()):
            by.setdefault(data[s:e], []).append(i)
        yield by


def _judge(width: int):
    def judge(table: pa.Table) -> pa.Table:
        r = decode_all(table.column("block").to_pylist())
        at = np.cumsum(r.size.astype(np.int64)) - r.size
        out = [np.stack([r.done[k] for k in ("doc", "tag", "start", "end")], axis=1)]
        strings: list[bytes] = []
        occ: list[int] = []
        owner: list[int] = []
        if len(r.doc):
            whole: list[int] = []
            doc = r.doc
            for by in _distinct(r, at):
                for s, runs in by.items():
                    if len(runs) > 1:       # the string itself repeats: later documents copy all of it
                        low = int(doc[runs].min())
                        whole += [i for i in runs if doc[i] > low]
                        runs = [i for i in runs if doc[i] == low]
                    if len(by) > 1:
                        occ += runs
                        owner += [len(strings)] * len(runs)
                        strings.append(s)
            w = np.array(whole, np.int64)
            i, pos = r.at_places(w)
            w = w[i]
            out.append(np.stack([r.doc[w], r.tag[w], pos, pos + r.size[w]], axis=1))
        if strings:
            occ_, owner_ = np.array(occ, np.int64), np.array(owner, np.int64)
            first = np.searchsorted(owner_, np.arange(len(strings) + 1))
            lead = r.doc[occ_[first[:-1]]]       # the one document of each string's remaining runs
            sa = SuffixArray(strings, width)
            lead_of = lead[sa.string]
            piece, length = [], []
            for n, lo, hi in sa.maximal_repeats(width):
                d = lead_of[lo:hi + 1]
                later = np.flatnonzero(d > d.min()) + lo
                if len(later):
                    piece.append(later)
                    length.append(np.full(len(later), n))
            if piece:
                p, n = np.concatenate(piece), np.concatenate(length)
                longest = np.zeros(len(sa.string), np.int64)
                np.maximum.at(longest, p, n)        # a suffix is in every interval around it: its longest covers the others
                p = np.flatnonzero(longest)
                n = longest[p]
                s = sa.string[p]
                times = first[s + 1] - first[s]
                k = np.repeat(np.arange(len(p)), times)
                run = occ_[first[s[k]] + np.arange(len(k)) - np.repeat(np.cumsum(times) - times, times)]
                start = sa.offset[p[k]]
                copied = np.stack([run, np.zeros_like(run), start, start + n[k]], axis=1)
                often = r.times[run] > 1            # ranges of a run are joined before they meet its many positions
                if often.any():
                    copied = np.concatenate((copied[~often], _union(copied[often])))
                i, pos = r.at_places(copied[:, 0])
                run, _, start, end = copied[i].T
                out.append(np.stack([r.doc[run], r.tag[run], pos + start, pos + end], axis=1))
        found = np.concatenate(out)
        if len(found):      # pieces of neighbouring windows overlap: emit their union
            found = _union(found)
        return range_table(*found.T)
    return judge


def _union(found: np.ndarray) -> np.ndarray:
    f = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.concatenate(([True], (f[1:, :2] != f[:-1, :2]).any(axis=1)))
    # ends never reach back over the edge of a document: lift each document's range above the last
    group = np.cumsum(new) - 1
    span = int(f[:, 3].max()) + 2
    s, e = f[:, 2] + group * span, f[:, 3] + group * span
    reach = np.maximum.accumulate(e)
    begin = np.concatenate(([True], s[1:] > reach[:-1]))
    b = np.flatnonzero(begin)
    last = np.concatenate((b[1:] - 1, [len(f) - 1]))
    return np.stack([f[b, 0], f[b, 1], f[b, 2], reach[last] - group[b] * span], axis=1)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def copied_ranges(docs: DataFrame, min_bytes: int = MIN_BYTES, tagged: bool | None = None) -> DataFrame:
    """Byte ranges [start, end) of each document that copy a smaller document (may overlap)."""
    docs = _source(docs)
    tagged = has_repeated_ids(docs) if tagged is None else tagged
    buckets = buckets_for(text_bytes(docs))
    return docs.mapInArrow(_pack(min_bytes, buckets, tagged, True), BLOCK_SCHEMA) \
        .groupBy("bucket").applyInArrow(_judge(min_bytes), RANGE_SCHEMA)


def _report(width: int):
    schema = pa.schema([("repeat", pa.string()), ("length", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64())])

    def report(table: pa.Table) -> pa.Table:
        r = decode_all(table.column("block").to_pylist())
        at = np.cumsum(r.size.astype(np.int64)) - r.size
        each, _ = r.at_places(np.arange(len(r.doc)))        # every position is an occurrence
        r = replace(r, doc=r.doc[each], tag=r.tag[each], size=r.size[each], mark=r.mark[each])
        at = at[each]
        rows: set[tuple] = set()
        for by in _distinct(r, at) if len(r.doc) else ():
            strings = [s for s, runs in by.items() for _ in runs]
            runs = [i for v in by.values() for i in v]
            owner = np.array(runs, np.int64)
            sa = SuffixArray(strings, width)
            for n, lo, hi in sa.maximal_repeats(width):
                k, o = int(sa.string[lo]), int(sa.offset[lo])
                name = hashlib.sha256(strings[k][o:o + n]).hexdigest()
                i = owner[sa.string[lo:hi + 1]]
                rows.update(zip(repeat(name), repeat(n), r.doc[i].tolist(), (r.pos[i] + sa.offset[lo:hi + 1]).tolist()))
        return pa.Table.from_pylist([dict(zip(schema.names, x)) for x in sorted(rows)], schema=schema)
    return report


def repeat_groups(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Maximal repeats inside runs with every occurrence: repeat (SHA-256), length, doc_id, start.

    A repeat longer than a run appears as several overlapping groups.
    """
    docs = _source(docs)
    buckets = buckets_for(text_bytes(docs))
    return docs.mapInArrow(_pack(min_bytes, buckets, False, False), BLOCK_SCHEMA) \
        .groupBy("bucket").applyInArrow(_report(min_bytes), "repeat string, length long, doc_id long, start long")


def _apply(batches):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"]
    for batch in batches:
        rows = []
        for doc, text, ranges in row_ranges(batch):
            text, last, kept = text or b"", 0, []
            for s, e in ranges.tolist():
                kept.append(text[last:s])
                last = e
            kept.append(text[last:])
            rest = b"".join(kept)
            rows.append((doc, len(text), len(text) - len(rest), len(ranges), hashlib.sha256(rest).hexdigest(), rest))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, kinds)], names=names)


def dedup(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Remove copied bytes: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes."""
    tagged = has_repeated_ids(docs)
    ranges = stage(copied_ranges(docs, min_bytes, tagged), "byte_ranges")
    return join_ranges(docs, ranges, tagged) \
        .mapInArrow(_apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary")
