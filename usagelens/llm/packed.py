"""Packed runs: the shuffle format of the two substring-dedup operators.

A *run* is a stretch of one document whose fixed-length windows all share a
minimiser; it travels to the minimiser's bucket as one byte string.  A map
task gathers the runs of many documents into :class:`Segment` and emits one
compressed block per bucket.

Runs that repeat inside a segment are resolved there: only the smallest
document's occurrence travels, the others are already known to be copies.
A passage that stands in a third of all documents therefore reaches its bucket
at most once per segment, however many copies there are.  A run that repeats
inside its own document travels once, with all its positions.

Text whose minimiser never changes (one letter or word over and over) is cut
into pieces of a bounded number of windows (:func:`pieces`).  The pieces are
equal, so such a text of any length is a few byte strings and a list of
positions.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard

BLOCK_SCHEMA = "bucket int, block binary"
#: bytes of runs after which a task emits its blocks and starts a new segment
SEGMENT_BYTES = 32 << 20

_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.binary())])
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (multiply, shift, multiply)."""
    h = h * _GOLD
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    n, s, m = len(a) - w + 1, 1, a
    while s * 2 <= w:
        m = np.minimum(m[:-s], m[s:])
        s *= 2
    return np.minimum(m[:n], m[w - s:w - s + n])


def pieces(low: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one window of each run: equal values in a row, at most ``longest`` of them."""
    first = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    n = np.diff(first, append=len(low))
    if n.max() > longest:
        parts = -(-n // longest)
        at = np.cumsum(parts) - parts
        first = np.repeat(first, parts) + longest * (np.arange(parts.sum()) - np.repeat(at, parts))
    return first, np.concatenate((first[1:], [len(low)]))


def _ints(a, kind) -> bytes:
    a = np.asarray(a, kind)
    d = np.diff(a, prepend=a.dtype.type(0))
    return d.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def _unints(b: memoryview, n: int, kind) -> np.ndarray:
    k = np.dtype(kind).itemsize
    d = np.frombuffer(b, np.uint8).reshape(k, n).T.copy().view(kind).reshape(n)
    return np.cumsum(d, dtype=kind)


_FIELDS = (("doc", np.int64), ("tag", np.int64), ("size", np.int32), ("mark", np.int32), ("times", np.int32))
_PLACES = (("pos", np.int64),)
_DONE = (("doc", np.int64), ("tag", np.int64), ("start", np.int64), ("end", np.int64))


@dataclass
class Runs:
    """Decoded block: run columns, the runs' positions, their bytes, and ranges already resolved.

    Run ``k`` stands at ``times[k]`` positions of its document; ``pos`` holds
    those of all runs, one run after the other.
    """
    doc: np.ndarray
    tag: np.ndarray
    size: np.ndarray
    mark: np.ndarray
    times: np.ndarray
    pos: np.ndarray
    data: bytes
    done: dict[str, np.ndarray]

    def at_places(self, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of ``run``, repeated once per position: its index in ``run`` and the position."""
        first = np.cumsum(self.times.astype(np.int64)) - self.times
        n = self.times[run].astype(np.int64)
        k = np.repeat(np.arange(len(run)), n)
        return k, self.pos[first[run[k]] + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)]


def encode(cols: dict, places: np.ndarray, data: bytes, done: dict) -> bytes:
    body = [struct.pack("<qqq", len(cols["doc"]), len(places), len(done["doc"]))]
    body += [_ints(cols[k], t) for k, t in _FIELDS]
    body += [_ints(places, t) for _, t in _PLACES]
    body += [_ints(done[k], t) for k, t in _DONE]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([*body, data]))


def decode(block: bytes) -> Runs:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(block))
    n, p, m = struct.unpack_from("<qqq", raw)
    at, cols, done = 24, {}, {}
    for out, fields, k in ((cols, _FIELDS, n), (cols, _PLACES, p), (done, _DONE, m)):
        for name, kind in fields:
            size = k * np.dtype(kind).itemsize
            out[name] = _unints(raw[at:at + size], k, kind)
            at += size
    return Runs(**cols, data=bytes(raw[at:]), done=done)


def decode_all(blocks) -> Runs:
    """The runs of several blocks in one."""
    parts = [decode(b) for b in blocks]
    cat = lambda get: np.concatenate([get(p) for p in parts])
    return Runs(**{k: cat(lambda p, k=k: getattr(p, k)) for k, _ in _FIELDS + _PLACES},
                data=b"".join(p.data for p in parts),
                done={k: cat(lambda p, k=k: p.done[k]) for k, _ in _DONE})


class Segment:
    """Runs of one map task, waiting to be emitted by bucket."""

    def __init__(self, buckets: int, resolve: bool = True):
        self.buckets, self.resolve = buckets, resolve
        self._clear()

    def _clear(self):
        self.first: dict[bytes, int] = {}
        self.doc, self.tag, self.pos, self.mark, self.bucket, self.text = [], [], [], [], [], []
        self.again: dict[int, list[int]] = {}   # further positions of a run in its own document
        self.done: list[list[int]] = []     # doc, tag, start, end
        self.bytes = 0

    def add(self, doc: int, tag: int, runs) -> None:
        """``runs``: (bucket, position, length in position units, mark, bytes)."""
        first, last = self.first, None
        for bucket, pos, length, mark, data in runs:
            n = len(self.doc)
            i = first.setdefault(data, n)
            if i != n:
                other = self.doc[i]
                if other < doc and self.resolve:        # a smaller document has the same run
                    if last is not None and last[3] >= pos:
                        last[3] = pos + length
                    else:
                        last = [doc, tag, pos, pos + length]
                        self.done.append(last)
                    continue
                if other == doc and self.tag[i] == tag:
                    self.again.setdefault(i, []).append(pos)
                    self.bytes += 8
                    continue
                first[data] = n     # documents came out of order, or none is to be resolved: the new one leads
            self.doc.append(doc)
            self.tag.append(tag)
            self.pos.append(pos)
            self.mark.append(mark)
            self.bucket.append(bucket)
            self.text.append(data)
            self.bytes += len(data)

    @property
    def full(self) -> bool:
        return self.bytes >= SEGMENT_BYTES or len(self.done) >= 1 << 20

    def _places(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions, run after run in ``order``, and how many each run has."""
        pos = np.array(self.pos, np.int64)[order]
        if not self.again:
            return pos, np.ones(len(pos), np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        more = np.repeat(rank[list(self.again)], [len(x) for x in self.again.values()])
        run = np.concatenate((np.arange(len(pos)), more))
        pos = np.concatenate((pos, np.fromiter(chain.from_iterable(self.again.values()), np.int64, len(more))))
        return pos[np.argsort(run, kind="stable")], np.bincount(run, minlength=len(order))

    def flush(self):
        """Arrow batches (bucket, block); the segment is empty afterwards."""
        if not self.doc and not self.done:
            return
        bucket = np.array(self.bucket, np.int64)
        order = np.argsort(bucket, kind="stable")
        cols = {k: np.array(getattr(self, k), np.int64)[order] for k in ("doc", "tag", "mark")}
        places, times = self._places(order)
        at = np.concatenate(([0], np.cumsum(times)))
        done = np.array(self.done, np.int64).reshape(-1, 4)
        home = (mix(done[:, 0].astype(np.uint64)) % np.uint64(self.buckets)).astype(np.int64)
        by = np.argsort(home, kind="stable")
        done, home = done[by], home[by]
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        edges_done = np.searchsorted(home, np.arange(self.buckets + 1))
        text, rows, size = self.text, order.tolist(), 0
        out_bucket, out_block = [], []
        for b in range(self.buckets):
            lo, hi, dlo, dhi = edges[b], edges[b + 1], edges_done[b], edges_done[b + 1]
            if lo == hi and dlo == dhi:
                continue
            data = [text[i] for i in rows[lo:hi]]
            part = {k: v[lo:hi] for k, v in cols.items()} | {"size": [len(x) for x in data], "times": times[lo:hi]}
            ready = {k: done[dlo:dhi, j] for j, (k, _) in enumerate(_DONE)}
            out_bucket.append(b)
            out_block.append(encode(part, places[at[lo]:at[hi]], b"".join(data), ready))
            size += len(out_block[-1])
            if size > 8 << 20:
                yield pa.record_batch([pa.array(out_bucket, pa.int32()), pa.array(out_block, pa.binary())], schema=_ARROW)
                out_bucket, out_block, size = [], [], 0
        if out_bucket:
            yield pa.record_batch([pa.array(out_bucket, pa.int32()), pa.array(out_block, pa.binary())], schema=_ARROW)
        self._clear()


RANGE_SCHEMA = "doc_id long, tag long, start long, end long"


def range_table(doc, tag, start, end) -> pa.Table:
    return pa.table({k: pa.array(np.asarray(v, np.int64), pa.int64())
                     for k, v in (("doc_id", doc), ("tag", tag), ("start", start), ("end", end))})


def merge(ranges: np.ndarray) -> np.ndarray:
    """Union of half-open ranges (n x 2) as sorted, separate ranges."""
    if len(ranges) == 0:
        return ranges.reshape(0, 2)
    r = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(r[:, 1])
    new = np.concatenate(([True], r[1:, 0] > reach[:-1]))
    at = np.flatnonzero(new)
    return np.stack([r[at, 0], reach[np.concatenate((at[1:] - 1, [len(r) - 1]))]], axis=1)
