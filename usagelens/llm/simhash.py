"""SimHash near-dedup by meet-in-the-middle ball hashing (operator 10).

Fingerprints at most ``d`` bits apart meet at a value that lies within ``d//2``
bits of the one and ``d - d//2`` bits of the other.  Every distinct fingerprint
emits all its variants within half the radius; equal variants meet in a bucket,
where each group is deduplicated into links and the links are verified by
their true distance.

* An odd ``d`` needs variants of the larger half only inside one half of the
  64 bits: of ``2h + 1`` differing bits, ``h + 1`` lie in the same half.
* The bucket of a variant is linear in its bits, ``B(f ^ m) = B(f) ^ B(m)``.
  So a task ships the fingerprint once per bucket, and the bucket enumerates
  exactly those masks whose variants fall into it.  Each bucket bit is the
  parity of a set of bits of its own inside one half, so a mask of one or two
  bits flips one or two bucket bits at most: with ``b`` bucket bits a
  fingerprint travels ``copies(b)`` times, about ``b * b / 4`` (13 at 64
  buckets, 43 at 4,096, 101 at half a million), not once per bucket.
* In a group of equal variants all link to the smallest fingerprint that lies
  within the smaller half, a star instead of all pairs.  Radii add up to ``d``
  at most, so every link is true, and any pair within ``d`` bits is connected
  through the group it meets in.  A bucket then hands on a spanning forest of
  its links, at most one per fingerprint, however dense a group of copies is.

Links join into components by alternating large-star and small-star steps,
each written to the shared checkpoint folder.

Rows: a null or blank text has fingerprint zero and links like any other.  A
null ``doc_id`` takes part; it is never the smallest id unless a component has
no other, whose ``component_id`` is then null.  Repeated rows are rows of their
own.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import has_repeated_ids, stage

SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
MIN_BUCKETS = 64
#: variants that one bucket enumerates on average
BUCKET_VARIANTS = 1 << 22


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles (repeats count)."""
    w = (text or b"").lower().split()       # of bytes: A-Z and ASCII white space only
    if not w:
        return 0
    digest = xxhash.xxh64_intdigest
    grams = zip(*(w[k:] for k in range(shingle))) if len(w) >= shingle else [w]
    h = np.array([digest(b" ".join(g), SEED) for g in grams], "<u8")
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 16):
        part = h[lo:lo + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: str | None = None) -> DataFrame:
    """(doc_id, tag, fp): the signed 64-bit fingerprint of every row; ``tag`` tells texts of one id apart."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], names=["doc_id", "tag", "fp"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"),
                       F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, tag long, fp long")


def ball(distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks whose variants a fingerprint emits, and the bits each one flips."""
    if not 0 <= distance <= 5:
        raise ValueError("the ball of half the distance must stay small: 0 <= distance <= 5")
    low, high = distance // 2, distance - distance // 2
    masks = [sum(1 << b for b in bits) for r in range(low + 1) for bits in combinations(range(64), r)]
    if high > low:
        masks += [sum(1 << b for b in bits) for half in (range(32), range(32, 64)) for bits in combinations(half, high)]
    m = np.array(masks, np.uint64)
    return m, np.bitwise_count(m).astype(np.int64)


def _parities(bits: int) -> list[int]:
    """Disjoint sets of fingerprint bits, as masks; each set lies in one half."""
    sets = [0] * bits
    for half, own in ((range(32), range(0, bits, 2)), (range(32, 64), range(1, bits, 2))):
        for k, b in enumerate(half):
            if len(own):
                sets[own[k % len(own)]] |= 1 << b
    return sets


def copies(bits: int, distance: int = MAX_DISTANCE) -> int:
    """How many buckets a fingerprint is sent to."""
    return len(np.unique(linear_bucket(ball(distance)[0], bits)))


def bucket_bits(nodes: int, distance: int = MAX_DISTANCE) -> int:
    """Bucket bits for so many fingerprints: a bucket's variants fit a task."""
    return min(48, max(MIN_BUCKETS.bit_length() - 1, (nodes * len(ball(distance)[0]) // BUCKET_VARIANTS).bit_length()))


def linear_bucket(values: np.ndarray, bits: int) -> np.ndarray:
    """Bucket number of each value: ``bits`` parities of disjoint bit sets."""
    out = np.zeros(len(values), np.int64)
    for j, r in enumerate(_parities(bits)):
        out |= (np.bitwise_count(values & np.uint64(r)).astype(np.int64) & 1) << j
    return out


def _emit(bits: int, distance: int):
    def emit(batches):
        classes = np.unique(linear_bucket(ball(distance)[0], bits))
        for b in batches:
            f = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            home = linear_bucket(f.view(np.uint64), bits)
            order = np.argsort(home, kind="stable")
            f, home = f[order], home[order]
            groups, edge = np.unique(home, return_index=True)
            to: dict[int, list] = {}
            for h, own in zip(groups.tolist(), np.split(f, edge[1:])):
                for c in classes.tolist():
                    to.setdefault(h ^ c, []).append(own)
            names = list(to)
            for k in range(0, len(names), 256):
                part = names[k:k + 256]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([np.concatenate(to[x]).tobytes() for x in part], pa.binary())], names=["bucket", "fps"])
    return emit


def bucket_links(fps: np.ndarray, bucket: int, bits: int, distance: int) -> np.ndarray:
    """Verified links (n x 2, uint64) among fingerprints whose variants meet in this bucket."""
    fps = np.sort(fps)
    masks, flips = ball(distance)
    kind = linear_bucket(masks, bits)
    home = linear_bucket(fps, bits)
    value, owner, radius = [], [], []
    for h in np.unique(home):
        own = np.flatnonzero(home == h)
        m = np.flatnonzero(kind == bucket ^ h)
        value.append((fps[own][:, None] ^ masks[m]).ravel())
        owner.append(np.repeat(own, len(m)))
        radius.append(np.tile(flips[m], len(own)))
    value, owner, radius = np.concatenate(value), np.concatenate(owner), np.concatenate(radius)
    order = np.argsort(value)
    v = value[order]
    same = v[1:] == v[:-1]
    meet = np.concatenate((same, [False])) | np.concatenate(([False], same))
    at = order[meet]
    if len(at) == 0:
        return np.zeros((0, 2), np.uint64)
    v = value[at]
    begin = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
    size = np.diff(np.concatenate((begin, [len(at)])))
    none = len(fps)
    lead = np.repeat(np.minimum.reduceat(np.where(radius[at] <= distance // 2, owner[at], none), begin), size)
    use = (lead != none) & (lead != owner[at])
    a, b = fps[lead[use]], fps[owner[at][use]]
    true = np.bitwise_count(a ^ b) <= distance
    pairs = np.stack([np.minimum(a, b)[true], np.maximum(a, b)[true]], axis=1)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return pairs[np.concatenate(([True], (pairs[1:] != pairs[:-1]).any(axis=1)))] if len(pairs) else pairs


def forest(pairs: np.ndarray) -> np.ndarray:
    """Pairs (root, member) that connect what ``pairs`` connect: one per member, the root is the smallest."""
    node, place = np.unique(pairs, return_inverse=True)
    place = place.reshape(-1, 2)
    root = np.arange(len(node))
    while True:
        ends = root[place]
        low, high = ends.min(axis=1, initial=len(node)), ends.max(axis=1, initial=0)
        if (low >= high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    member = np.flatnonzero(root != np.arange(len(node)))
    return np.stack([node[root[member]], node[member]], axis=1)


def links(nodes: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Distinct pairs (a, b) that connect all of ``nodes.fp`` within ``distance`` bits of each other."""
    bits = bucket_bits(nodes.count(), distance)

    def meet(table: pa.Table) -> pa.Table:
        f = np.frombuffer(b"".join(table.column("fps").to_pylist()), np.uint64)
        found = np.ascontiguousarray(forest(bucket_links(f, table.column("bucket")[0].as_py(), bits, distance))).view(np.int64)
        return pa.table({"a": pa.array(found[:, 0], pa.int64()), "b": pa.array(found[:, 1], pa.int64())})

    return nodes.select("fp").mapInArrow(_emit(bits, distance), "bucket long, fps binary") \
        .groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge (a, b); root is the component's smallest node.

    Alternates large-star and small-star until the edges are stars around the
    smallest nodes.  Each round is written out, so rounds don't pile up in the
    lineage.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), "edges")
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large_star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.*").where("u <> v").distinct()
        edges = stage(small, "small_star")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = tuple(now)


def assign(docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, tag, fp, component_id) for every row."""
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    roots = components(links(nodes, distance))
    member = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    member = stage(member, "members")
    smallest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = member.join(smallest, "root").select("fp", "component_id", F.col("root").alias("class"))
    return rows.join(classes, "fp").select("doc_id", "tag", "fp", "component_id", "class")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per document."""
    return assign(docs, shingle, distance).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one of each component, its smallest id, stays."""
    chosen = assign(docs, shingle, distance).groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("row")).select("row.doc_id", "row.tag")
    chosen = stage(chosen, "kept")
    row = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("tag"))
    kept = row.join(chosen, row.id.eqNullSafe(chosen.doc_id) & (row.tag == chosen.tag), "left_semi")
    if has_repeated_ids(docs):      # the chosen row may itself be repeated
        kept = kept.groupBy("id", "tag").agg(F.min_by("row", F.to_json("row")).alias("row"))      # the same one in every run
    return kept.select("row.*")
