"""Exact duplicates by an extendible-hash index on shared files.

A text's key is a 64-bit hash. The directory maps the first bits of a key to a bucket; while a bucket holds too many distinct
keys the directory doubles and the bucket splits. Each bucket, a range of keys, is owned by one task, which reads its entries
in key order, chains texts that share a key and compares their bytes. Copies are combined where they are read, so a text that
fills a third of the table reaches its bucket once per reading task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fold, named, stage, texts, times

#: Distinct keys, at most, of a bucket.
CAPACITY = 16_384
#: Of the hash; the one that Spark's own function has, so that its columns can be joined.
SEED = 42

_ROW = "row long, doc_id long, h long, sha binary"
_ENTRY = "bucket int, h long, sha binary, text binary, doc_id long, n long"
_INDEX = "bucket int, h long, chain int, sha binary, keep_id long, group_size long"


def _normal(text: str) -> bytes:
    return text.encode("utf-8", "replace").lower()  # of bytes: A-Z only


def _greater(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _hashed(docs: DataFrame) -> DataFrame:
    """Key and digest of every row of ``row, doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for b in batches:
            normal = [_normal(t) for t in b.column(2).to_pylist()]
            keys = np.fromiter((xxh64_intdigest(t, SEED) for t in normal), np.uint64, len(normal)).view(np.int64)
            digests = [hashlib.sha256(t).digest() for t in normal]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys), pa.array(digests, pa.binary())], ["row", "doc_id", "h", "sha"])

    return docs.select("row", "doc_id", "text").mapInArrow(run, _ROW)


def grow_directory(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, bool]:
    """The bucket of every prefix, given the keys of each prefix of the deepest level (a power of two of them).

    Starts with one bucket. While one is overfull the directory doubles, and each overfull bucket gives the upper half of its
    keys to a new one. Also returns whether a bucket is overfull that would need a deeper level.
    """
    table = np.zeros(1, np.int32)
    while True:
        load = np.bincount(table, counts.reshape(len(table), -1).sum(1))
        over = load[table] > capacity
        if not over.any() or len(table) == len(counts):
            return table, bool(over.any())
        split = np.repeat(over, 2)
        split[::2] = False  # an overfull bucket has one entry, so two after doubling
        table = np.repeat(table, 2)
        table[split] = len(load) + np.arange(split.sum(), dtype=np.int32)


def directory(keys: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """The directory for the distinct keys ``h``; the driver sees one count per prefix."""
    keys = keys.distinct()
    depth = max(1, keys.count() // capacity).bit_length() + 1
    while True:
        found = keys.groupBy(F.shiftrightunsigned("h", 64 - depth).alias("prefix")).count().toArrow()
        counts = np.zeros(1 << depth, np.int64)
        counts[found.column("prefix").to_numpy()] = found.column("count").to_numpy()
        table, deeper = grow_directory(counts, capacity)
        if not deeper:
            return table
        depth += 1


def _entries(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """Each text once per reading task, with its bucket; more copies follow as counts without their text."""
    shift = np.uint64(64 - (len(table).bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        bucket = lambda h: int(table[np.uint64(h) >> shift]) if len(table) > 1 else 0
        seen: dict[bytes, list] = {}  # digest -> key, greatest id and number of the copies not yet sent
        for b in batches:
            new = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                normal = _normal(text)
                sha = hashlib.sha256(normal).digest()
                if (copies := seen.get(sha)) is None:
                    h = xxh64_intdigest(normal, SEED)
                    seen[sha] = [h, None, 0]
                    new.append((bucket(h), h - (h >> 63 << 64), sha, normal, doc_id, 1))
                else:
                    copies[1] = _greater(copies[1], doc_id)
                    copies[2] += 1
            yield _batch(_ENTRY, new)
        yield _batch(_ENTRY, [(bucket(h), h - (h >> 63 << 64), sha, None, top, n) for sha, (h, top, n) in seen.items() if n])

    return docs.select("doc_id", "text").mapInArrow(run, _ENTRY)


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index entries of a bucket's rows, which come in key order, texts before counts."""
    last, chain = None, []

    def closed() -> list[tuple]:
        return [(*last, i, sha, top, n) for i, (sha, _, top, n) in enumerate(chain)]

    for b in batches:
        out = []
        for bucket, h, sha, text, top, n in zip(*(c.to_pylist() for c in b.columns)):
            if (bucket, h) != last:
                out += closed() if chain else []
                last, chain = (bucket, h), []
            same = next((e for e in chain if (e[0] == sha if text is None else e[1] == text)), None)
            if same is None:
                chain.append([sha, text, top, n])
            else:
                same[2] = _greater(same[2], top)
                same[3] += n
        yield _batch(_INDEX, out)
    yield _batch(_INDEX, closed() if chain else [])


def build_index(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """The index on shared files: per distinct text its bucket, key, place in the chain, digest, greatest id and number."""
    entries = _entries(docs, table).repartitionById(int(table.max()) + 1, F.col("bucket"))
    return stage(entries.sortWithinPartitions("bucket", "h", F.col("text").isNull()).mapInArrow(_owned, _INDEX), "index")


def _decided(docs: DataFrame, capacity: int) -> DataFrame:
    """Per row of ``row, doc_id, text``: its group, and whether it stays."""
    rows = stage(_hashed(docs), "keys")
    index = build_index(docs, directory(rows.select("h"), capacity))
    again = rows.groupBy("h", "sha", "doc_id").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = again.select(F.col("h").alias("h2"), F.col("sha").alias("sha2"), F.col("doc_id").alias("id2"), "first")
    out = rows.join(index.select("h", "sha", "keep_id", "group_size"), ["h", "sha"], "left")
    same = (F.col("h") == F.col("h2")) & (F.col("sha") == F.col("sha2")) & F.col("doc_id").eqNullSafe(F.col("id2"))
    out = out.join(stage(again, "again"), same, "left")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row") == F.coalesce("first", "row"))
    return out.select("row", "h", "doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def exact_dup_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Texts are equal if they are identical after lower-casing A-Z; null counts as empty. Of a group the row with the greatest
    ``doc_id`` stays, which ``keep_id`` names; null ids are below all others, and ``keep_id`` is null if all are. Of rows that
    repeat that id exactly one stays. No rows: no rows.
    """
    docs = texts(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id())
    return _decided(docs, capacity).drop("row", "h")


def drop_exact_dups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs``, all columns, that stay."""
    rows = texts(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id())
    groups = stage(_decided(rows, capacity).where(F.col("doc_id").eqNullSafe(F.col("keep_id"))), "kept")
    keys = groups.groupBy("keep_id", "h").agg(F.count("*").alias("n"), F.lit(1).alias("keep"))
    keys = stage(keys.select(F.struct(F.col("keep_id").alias("doc_id"), "h"), "n", "keep"), "keep")
    key = F.struct(named(doc_id).cast("long").alias("doc_id"), F.xxhash64(fold(F.coalesce(named(text).cast("string"), F.lit("")))).alias("h"))
    return times(docs, keys, key).select(*map(named, docs.columns))
