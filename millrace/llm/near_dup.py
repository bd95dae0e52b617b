"""Near-duplicates: SimHash fingerprints, linked by vantage-point trees.

Similar texts have fingerprints that differ in few bits. A vantage-point tree splits fingerprints by their Hamming distance
to a vantage point: those within the radius go inside, the others outside. By the triangle inequality a pair within ``bits``
that a boundary separates has its inside member within the outermost ``bits`` distances of the radius, so only those members
are queried on the other side too, and every linked pair meets in some shard. The top of the tree is fitted on a bounded
sample and deals all fingerprints to shards; each shard is one task, which goes on splitting and compares the rest exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import named, row_key, stage, texts, times

#: Distinct fingerprints, at most, that the driver reads to fit the top of the tree.
SAMPLE = 65_536
#: Fingerprints a shard is meant to hold, and how many are compared pair by pair at the bottom.
SHARD, LEAF = 20_000, 256
#: Vantage points tried for each split.
TRIES = 8
#: Shingles whose hashes are unpacked at once.
_CHUNK = 1 << 16


def fingerprint(text: str, words: int = 3) -> int:
    """64-bit SimHash: a bit is set if more than half of the shingles' XXH64 (seed 42) have it. No words: zero."""
    from xxhash import xxh64_intdigest

    parts = text.encode("utf-8", "replace").lower().split()  # of bytes: A-Z only, and white space of ASCII only
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(parts) - words + 1)
    spans = zip(starts[:n].tolist(), ends[len(parts) - n :].tolist())
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], 42) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        bits = np.unpackbits(hashes[i : i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int32)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.fromiter((fingerprint(t.as_py(), words) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fp"])

    rows = texts(docs, doc_id, text).select("doc_id", F.xxhash64("text"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


# The tree. A node is (vantage point, radius, inside, outside), a leaf is its number; children are nodes or leaves.


def _split(points: np.ndarray, bits: int) -> tuple[np.uint64, int] | None:
    """The vantage point and radius that leave the fewest pairs, or None if no split leaves clearly fewer."""
    best, least = None, 0.9 * len(points) ** 2
    for v in points[:: max(1, len(points) // TRIES)][:TRIES]:
        near = np.bincount(np.bitwise_count(points ^ v), minlength=65)
        inside = np.cumsum(near)
        again = np.convolve(near, np.ones(bits, np.int64))[:65]  # the outermost `bits` distances of each radius
        cost = inside**2 + (len(points) - inside + again) ** 2
        r = int(np.argmin(cost))
        if cost[r] < least:
            best, least = (v, r), cost[r]
    return best


def _sides(points: np.ndarray, v: np.uint64, r: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    d = np.bitwise_count(points ^ v).astype(np.int16)
    return points[d <= r], points[d > r - bits]


def fit_tree(sample: np.ndarray, total: int, shard: int, bits: int) -> tuple[object, int]:
    """A tree over ``sample``, split until a leaf stands for at most ``shard`` of ``total`` points; and its number of leaves."""
    leaves = 0

    def grow(points: np.ndarray) -> object:
        nonlocal leaves
        cut = _split(points, bits) if len(points) * total > shard * len(sample) and len(points) > 16 else None
        if cut is None:
            leaves += 1
            return leaves - 1
        inside, outside = _sides(points, *cut, bits)
        return (*cut, grow(inside), grow(outside))

    return grow(sample), leaves


def route(tree: object, points: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """The points of every leaf they belong to or must be queried in."""
    if not len(points):
        return
    if isinstance(tree, int):
        yield tree, points
        return
    v, r, inside, outside = tree
    a, b = _sides(points, v, r, bits)
    yield from route(inside, a, bits)
    yield from route(outside, b, bits)


def _star(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between positions of ``points``, as links of each point to the first one of its component."""
    label = np.arange(len(points))
    while True:
        old = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if np.array_equal(old, label):
            moved = np.flatnonzero(label != np.arange(len(points)))
            return points[moved], points[label[moved]]


def _dense(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked positions among points too close to split: all their neighbours are looked up, so work is linear in their number."""
    one = [1 << i for i in range(64)]
    masks, level = {0}, {0}
    for _ in range(bits):
        level = {m ^ o for m in level for o in one}
        masks |= level
    a, b = [], []
    for m in sorted(masks - {0}):
        other = points ^ np.uint64(m)
        at = np.minimum(np.searchsorted(points, other), len(points) - 1)
        hit = np.flatnonzero((points[at] == other) & (at > np.arange(len(points))))
        if len(hit):  # a spanning star of what this mask links is enough
            a.append(hit)
            b.append(at[hit])
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, np.int64), np.empty(0, np.int64))


def link(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all of ``points`` (sorted, distinct) within ``bits`` of each other, fewer than there are points."""
    a, b, todo = [], [], [points]
    while todo:
        part = todo.pop()
        if len(part) < 2:
            continue
        cut = _split(part, bits) if len(part) > LEAF else None
        if cut:
            todo += _sides(part, *cut, bits)
            continue
        if len(part) <= 8 * LEAF:
            i, j = np.nonzero(np.triu(np.bitwise_count(part[:, None] ^ part[None, :]) <= bits, 1))
        else:
            i, j = _dense(part, bits)
        u, v = _star(part, i, j)
        a.append(u)
        b.append(v)
    if not a:
        return points[:0], points[:0]
    return _star(points, np.searchsorted(points, np.concatenate(a)), np.searchsorted(points, np.concatenate(b)))


def links(nodes: DataFrame, bits: int = 2, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """``a, b``: links that join all fingerprints of ``nodes`` (column ``fp``, distinct) within ``bits`` of each other."""
    total = nodes.count()
    rows = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).toArrow()
    tree, leaves = fit_tree(rows.column("fp").to_numpy().view(np.uint64), total, shard, bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaf, part in route(tree, batch.column(0).to_numpy().view(np.uint64), bits):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), leaf, np.int32)), pa.array(part.view(np.int64))], ["leaf", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column(0).to_numpy().view(np.uint64) for b in batches]
        if parts:
            a, b = link(np.unique(np.concatenate(parts)), bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    dealt = nodes.select("fp").mapInArrow(deal, "leaf int, fp long")
    return dealt.repartitionById(leaves, F.col("leaf")).select("fp").mapInArrow(meet, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``edges`` (columns ``a, b``): the smallest node reachable.

    Each round a node takes the smallest label among its own, its neighbours' and its label's, so labels travel twice as far
    every time. Rounds are written to the shared folder.
    """
    both = stage(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        far = labels.select(F.col("node").alias("at"), F.col("label").alias("far"))
        new = labels.join(near, labels.node == near.a, "left").join(far, labels.label == far.at, "left")
        least = F.least("label", "near", "far")
        new = stage(new.select("node", least.alias("label"), (least < F.col("label")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels


def near_dup_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, bits: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Two rows are linked if their fingerprints differ in at most ``bits`` bits; ``component_id`` is the smallest ``doc_id``
    reachable over links, its own included. Texts are lower-cased (A-Z), split at ASCII white space and cut into shingles of
    ``words`` words; fewer words make one shingle, none (null, empty, blank) the fingerprint zero, linked like any other.
    Null ids are ignored in the minimum; a component of null ids only has a null ``component_id``. Repeated rows come back
    as often as they were given. No rows: no rows.
    """
    found = _grouped(docs, doc_id, text, words, bits)
    return found.select("doc_id", F.format_string("%016x", "fp").alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, doc_id: str, text: str, words: int, bits: int) -> DataFrame:
    """``doc_id, text_hash, fp, component, component_id`` of every row; ``component`` is a fingerprint that names the group."""
    prints = stage(fingerprints(docs, doc_id, text, words), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    labels = components(links(nodes, bits))
    of_label = labels.join(nodes, labels.node == nodes.fp).groupBy("label").agg(F.min("least").alias("component_id"))
    other = stage(labels.join(of_label, "label").select(F.col("node").alias("fp"), "label", F.lit(True).alias("linked"), "component_id"), "components")
    least = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least"))
    group = nodes.join(other, "fp", "left").select("fp", F.coalesce("label", "fp").alias("component"), least.alias("component_id"))
    return prints.join(stage(group, "groups"), "fp", "left")


def drop_near_dups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, bits: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of ``near_dup_groups``: that with the smallest id (null: last), then any."""
    found = stage(_grouped(docs, doc_id, text, words, bits).select("doc_id", "text_hash", "component"), "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    keep = found.groupBy("component").agg(first).select("first.doc_id", "first.text_hash")
    copies = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).withColumnsRenamed({"doc_id": "id_", "text_hash": "hash_"})
    keep = keep.join(copies, keep.doc_id.eqNullSafe(F.col("id_")) & (keep.text_hash == F.col("hash_")))
    keys = stage(keep.select(F.struct("doc_id", "text_hash"), "n", F.lit(1).alias("keep")), "keep")
    return times(docs, keys, row_key(named(doc_id), named(text))).select(*map(named, docs.columns))
