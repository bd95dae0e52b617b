"""Merkle manifest of a dataset, with a witness for each row.

Rows are leaves in the order of their keys within a group; subroots of the groups are leaves of one more tree. The tree is
built by appending. A task takes an aligned block of leaves and appends them one after the other: each open subtree keeps the
leaves below it, and whenever a run of siblings is complete every leaf below one of them gets the digests of the others as the
next step of its witness. Roots of blocks are appended in the same way, in blocks of the next level, until one node is left; a
leaf's whole witness is its own partial one followed by that of its block's root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import named, stage

#: Siblings of a run, and the levels that one block spans.
FAN, LEVELS = 2, 10
#: The columns that a leaf holds, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_ROWS = 1000  # of an output batch


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: of each field its length in UTF-8 and the value, or ``-`` for null, so no two rows read alike."""
    value = lambda c: c.cast("string")
    each = [F.coalesce(F.concat(F.octet_length(value(c)).cast("string"), F.lit(":"), value(c)), F.lit("-")) for c in fields]
    return F.sha2(F.concat(*each).cast("binary"), 256)


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Appender:
    """Appends leaves one by one; ``levels`` is how far the tree rises, whether or not one node is left before."""

    def __init__(self, fan: int, levels: int):
        self.fan, self.levels = fan, levels
        self.open: list[list[tuple[str, int, int]]] = [[] for _ in range(levels + 1)]  # digest, first leaf below, end
        self.steps: list[list[bytes]] = []

    def append(self, node: str) -> None:
        self.steps.append([])
        n = len(self.steps)
        self._put(0, (node, n - 1, n))

    def _put(self, level: int, node: tuple[str, int, int]) -> None:
        run = self.open[level]
        run.append(node)
        if len(run) == self.fan and level < self.levels:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        raw = [bytes.fromhex(d) for d, _, _ in run]
        for place, (_, first, end) in enumerate(run):
            step = bytes([place, len(run) - 1]) + b"".join(raw[:place] + raw[place + 1 :])
            for i in range(first, end):
                self.steps[i].append(step)
        self._put(level + 1, (digest([d for d, _, _ in run]), run[0][1], run[-1][2]))

    def close(self) -> str:
        """Complete the runs that are still open, from below; the root."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)
        return self.open[self.levels][0][0]


def siblings(witness: bytes) -> Iterator[tuple[int, list[str]]]:
    """Of each step the node's place in its run and the digests of the others."""
    at = 0
    while at < len(witness):
        place, others = witness[at], witness[at + 1]
        at += 2
        yield place, [witness[at + 32 * i : at + 32 * i + 32].hex() for i in range(others)]
        at += 32 * others


def fold(node: str, witness: bytes) -> str:
    """The root that a leaf and its witness give."""
    for place, others in siblings(witness):
        node = digest([*others[:place], node, *others[place:]])
    return node


def levels_of(n: int, fan: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan), levels + 1
    return levels


def positions(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, from 0 in their group (columns that are not null), and ``n``, the rows of the group.

    Rows are dealt to tasks by ranges of ``group`` and ``order`` (null first), so no task holds a whole large group; a row's
    position is its place in its task after the rows of the group in the tasks before, which are counted per task.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at_", F.monotonically_increasing_id())
    dealt = stage(dealt.withColumn("part_", F.shiftright("at_", 33)), "sorted")
    runs = dealt.groupBy(*group, "part_").agg(F.count("*").alias("rows_"), F.min("at_").alias("first_"))
    whole = Window.partitionBy(*group)
    before = F.sum("rows_").over(whole.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(*group, "part_", "first_", F.coalesce(before, F.lit(0)).alias("before_"), F.sum("rows_").over(whole).alias("n"))
    out = dealt.join(stage(runs, "runs"), [*group, "part_"])
    return out.select(*rows.columns, (F.col("at_") - F.col("first_") + F.col("before_")).alias("pos"), "n")


def _grow(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """``grp, pos, block, n, witness, top`` of ``grp, pos, n, node``: each block's appended nodes; ``top`` is its root."""
    size = fan**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["grp", "pos", "block", "n", "witness", "top"]
        out: list[list] = [[] for _ in names]
        at, tree, places = None, None, []

        def close() -> None:
            root = tree.close()
            for c, values in zip(out, ([at[0]] * len(places), places, [at[1]] * len(places), [at[2]] * len(places), map(b"".join, tree.steps), [root] * len(places))):
                c.extend(values)

        def batch() -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)
            for c in out:
                c.clear()
            return made

        for b in batches:
            for grp, pos, n, node in zip(*(b.column(i).to_pylist() for i in range(4))):
                if at is None or at[:2] != (grp, pos // size):
                    if at is not None:
                        close()
                        if len(out[0]) >= _ROWS:
                            yield batch()
                    at, places = (grp, pos // size, n), []
                    tree = Appender(fan, levels if n > size else levels_of(n, fan))
                tree.append(node)
                places.append(pos)
        if at is not None:
            close()
            yield batch()

    block = F.floor(F.col("pos") / size)
    rows = nodes.select("grp", "pos", "n", "node").repartition("grp", block).sortWithinPartitions("grp", "pos")
    return stage(rows.mapInArrow(run, "grp string, pos long, block long, n long, witness binary, top string"), "blocks")


def witnesses(nodes: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """``grp, pos, witness, root`` of ``grp, pos, n, node``: a tree for each group, over its nodes by position."""
    size, grown = fan**levels, []
    while True:
        grown.append(_grow(nodes, fan, levels))
        tops = grown[-1].where(F.col("n") > size).select("grp", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("node")).distinct()
        if tops.isEmpty():
            break
        nodes = stage(tops, "roots")
    out = grown.pop().select("grp", "pos", "witness", F.col("top").alias("root"))
    while grown:
        above = stage(out, "witnesses").toDF("grp", "block", "rest_", "root")
        low = grown.pop().join(above, ["grp", "block"], "left")
        out = low.select("grp", "pos", F.concat("witness", F.coalesce("rest_", F.lit(b""))).alias("witness"), F.coalesce("root", "top").alias("root"))
    return out


def manifest(docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, claims: dict[str, Column] | None = None, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """``doc_id, grp, leaf, witness, subroot, root`` of every row, and ``claim``.

    Leaves of a group ascend by ``doc_id`` (null first), rows that repeat an id by their digests; groups ascend bytewise, null
    first. A witness is the steps from the leaf to the root, each one byte for the place in the run, one for the number of
    siblings, and these. ``claim`` is the leaf with some fields replaced by the expressions in ``claims``, to be checked
    against the witness. Texts are read once and never moved: what is sorted and shuffled are digests. No rows: no rows.
    """
    replaced = claims or {}
    both = [leaf([named(c) for c in fields]), leaf([replaced.get(c, named(c)) for c in fields])]
    grp = F.coalesce(F.concat(F.lit("="), named(group).cast("string")), F.lit(""))  # null sorts before all others, and joins
    rows = docs.select(grp.alias("grp"), named(doc_id).cast("long").alias("doc_id"), both[0].alias("leaf"), (both[1] if replaced else both[0]).alias("claim"))
    placed = stage(positions(stage(rows, "leaves"), ["grp"], ["doc_id", "leaf", "claim"]), "placed")
    inner = stage(witnesses(placed.select("grp", "pos", "n", F.col("leaf").alias("node")), fan, levels), "inner")
    subroots = inner.select("grp", F.col("root").alias("node")).distinct().withColumn("all_", F.lit("all"))
    subroots = stage(positions(subroots, ["all_"], ["grp"]), "subroots")
    outer = witnesses(subroots.select(F.col("all_").alias("grp"), "pos", "n", "node"), fan, levels)
    upper = subroots.join(outer.select("pos", F.col("witness").alias("rest_"), F.col("root").alias("whole_")), "pos")
    upper = stage(upper.select("grp", F.col("node").alias("subroot"), "rest_", "whole_"), "upper")
    out = placed.join(inner, ["grp", "pos"]).join(upper, "grp")
    return out.select("doc_id", F.when(F.col("grp") != "", F.substring("grp", 2, 1 << 30)).alias("grp"), "leaf", "claim", F.concat("witness", "rest_").alias("witness"), "subroot", F.col("whole_").alias("root"))


def verify(listed: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of rows of a manifest.

    ``folded_root`` is what the claim and the witness give, ``proof_sha256`` the digest of the witness' siblings from below.
    """
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            proofs = b.column(5).to_pylist()
            folded = [fold(c, w) for c, w in zip(b.column(4).to_pylist(), proofs)]
            proof = [digest([d for _, others in siblings(w) for d in others]) for w in proofs]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(proof, pa.string()), pa.array(folded, pa.string())], names)

    rows = listed.select("doc_id", "leaf", "subroot", "root", "claim", "witness")
    out = rows.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
