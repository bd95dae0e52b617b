"""Alignment of two tokenizers' ids over the same bytes.

Each tokenizer's tokens end at cumulative byte offsets. A dictionary from end to index is made for either side, the keys of both
are intersected as sets, and the common ends in order cut both lists of ids into groups. A link joins the two tokens of a
group that end with it. How often two ids are linked is counted over all documents.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import named, stage

#: Characters, about, that are encoded at once; one text is never divided.
AT_ONCE = 1 << 18
#: Tokens of one text whose bytes, or whose written ids, are put together at once.
TOKENS = 1 << 16
#: Fixed value: where byte-level tokenizers cut a text before they merge.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_character() -> dict[str, int]:
    """Byte-level tokenizers write printable bytes as themselves and the others as the next free code points from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level tokenizer from the text of its JSON file; special strings in texts are plain text."""

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        written = json.loads(source)
        byte = byte_of_character()
        vocabulary = written["model"]["vocab"] | {t["content"]: t["id"] for t in written.get("added_tokens") or []}
        self.pieces = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for entry, i in vocabulary.items():
            known = all(c in byte for c in entry)
            self.pieces[i] = bytes(byte[c] for c in entry) if known else entry.encode("utf-8")
        self.ranked = self._ranked(written)
        if self.ranked is None:
            self.inner = Tokenizer.from_str(source)
            self.inner.encode_special_tokens = True

    def _ranked(self, written: dict):
        """A faster encoder of the same ids, where ids are in the order of the merges that make them: then the pair of the
        lowest id is that of the first merge, and neither special strings nor merges need to be known."""
        from tiktoken import Encoding

        model, splits = written["model"], written.get("pre_tokenizer") or {}
        special = {t["id"] for t in written.get("added_tokens") or []}
        made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        in_order = [model["vocab"][m] for m in made] == [i for i in range(256, 256 + len(made))]
        plain = splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space")
        if written.get("normalizer") is not None or not (in_order and plain):
            return None
        ranks = {p: i for i, p in enumerate(self.pieces) if i not in special}
        return Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.ranked is not None:
            return [self.ranked.encode_ordinary(" " + t) for t in texts]
        return [e.ids for e in self.inner.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Piecewise:
    """A sentence-piece tokenizer from the bytes of its model; it puts the space before the text itself."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.inner = SentencePieceProcessor(model_proto=model)
        size = self.inner.get_piece_size()
        raw = [bytes([int(self.inner.id_to_piece(i)[3:-1], 16)]) if self.inner.is_byte(i) else None for i in range(size)]
        self.pieces = [r if r is not None else self.inner.id_to_piece(i).replace("▁", " ").encode("utf-8") for i, r in enumerate(raw)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return list(map(self.inner.encode_as_numpy, texts))


class Spelling:
    """The bytes of a tokenizer's entries, end to end."""

    def __init__(self, pieces: list[bytes]):
        self.lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.joined = np.frombuffer(b"".join(pieces), np.uint8)

    def of(self, ids: np.ndarray) -> bytes:
        return b"".join(self._some(ids[at : at + TOKENS]) for at in range(0, len(ids), TOKENS))

    def _some(self, ids: np.ndarray) -> bytes:
        n = self.lengths[ids]
        ends = np.cumsum(n)
        return self.joined[np.repeat(self.starts[ids] - ends + n, n) + np.arange(ends[-1])].tobytes()


def common_ends(a: list[int] | np.ndarray, b: list[int] | np.ndarray) -> tuple[list[int], list[int]]:
    """Where the groups end: for each byte offset at which tokens of both sides end, the number of tokens up to it.

    ``a`` and ``b`` are the tokens' lengths in bytes, all above zero.
    """
    index_a = dict(zip(np.cumsum(a).tolist(), range(1, len(a) + 1)))
    index_b = dict(zip(np.cumsum(b).tolist(), range(1, len(b) + 1)))
    common = list(filter(index_b.__contains__, index_a))  # in order, as the ends went in
    return list(map(index_a.__getitem__, common)), list(map(index_b.__getitem__, common))


class Aligner:
    def __init__(self, first: ByteLevel, second: Piecewise):
        self.sides = (first, second)
        self.spellings = [Spelling(s.pieces) for s in self.sides]
        sizes = [len(s.pieces) for s in self.sides]
        #: Ids as they are written, each with what follows it: ``a,`` and ``a|`` of the first side, ``b,`` and ``b;`` of the second.
        self.written = np.array([f"{i}{after}" for n, pair in zip(sizes, (",|", ",;")) for after in pair for i in range(n)], "S")
        self.offsets = (sizes[0], 2 * sizes[0], 2 * sizes[0] + sizes[1])

    def align(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text both lists of ids and where its groups end in them; none where either side's bytes differ."""
        none = np.empty(0, np.int32)
        for text, *ids in zip(texts, *(s.encode(texts) for s in self.sides)):
            whole = b" " + text.encode("utf-8")
            ids = [np.asarray(i, np.int32) for i in ids]
            if not text or any(s.of(i) != whole for s, i in zip(self.spellings, ids)):
                yield none, none, none, none
            else:
                yield (*ids, *(np.array(e, np.int32) for e in common_ends(*(s.lengths[i] for s, i in zip(self.spellings, ids)))))

    def groups(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> Iterator[bytes]:
        """The groups as text, part by part: ``a1,a2|b1;a3|b2,b3``."""
        last_a, first_b, last_b = self.offsets
        x, y = a.copy(), b + first_b
        x[ends_a - 1] += last_a
        y[ends_b - 1] += last_b - first_b
        before_a, before_b = (np.concatenate([e[:1] * 0, e[:-1]]) for e in (ends_a, ends_b))
        order = np.empty(len(a) + len(b), np.int32)
        order[np.repeat(before_b, ends_a - before_a) + np.arange(len(a))] = x
        order[np.repeat(ends_a, ends_b - before_b) + np.arange(len(b))] = y
        for at in range(0, len(order), TOKENS):
            part = self.written[order[at : at + TOKENS]].tobytes().translate(None, b"\0")  # shorter ids are filled up with zeros
            yield part if at + TOKENS < len(order) else part[:-1]


def _aligners(docs: DataFrame, a_path: str, b_path: str):
    """A function that gives each task its aligner; the files are read here, on the driver."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))  # as large as the files, whatever the data
    return lambda: Aligner(ByteLevel(files.value[0]), Piecewise(files.value[1]))


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about AT_ONCE characters, with a text of any length alone if need be."""
    for b in batches:
        start, size = 0, 0
        for i, n in enumerate(b.column(2).to_pylist()):
            if size + n > AT_ONCE and i > start:
                yield b.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < b.num_rows:
            yield b.slice(start)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.coalesce(named(text).cast("string"), F.lit(""))
    return docs.select(named(doc_id).cast("long").alias("doc_id"), whole.alias("text"), F.octet_length(whole).cast("long").alias("size"))


def _list(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values), kind))


def alignments(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, a_ids, b_ids, a_ends, b_ends`` of every row: both lists of ids, and where each group ends in them.

    ``a_path`` is a byte-level tokenizer's JSON, ``b_path`` a sentence-piece model, both on the driver. Tokens cover a space and
    the text. A null or empty text, and one whose tokens of either side do not spell these bytes, has empty lists. Texts are
    never cut; repeated rows come back as often as they were given. No rows: no rows.
    """
    make = _aligners(docs, a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = make()
        for b in _some(batches):
            found = zip(*aligner.align(b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), *(_list(list(c), pa.int32()) for c in found)], ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    return _rows(docs, doc_id, text).mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


def _linked(docs: DataFrame, a_path: str, b_path: str, doc_id: str, text: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, groups_sha256, links``; a link is ``(a << 32) + b``."""
    make = _aligners(docs, a_path, b_path)
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        aligner = make()
        for batch in _some(batches):
            out: list[list] = [[] for _ in names[1:]]
            for a, b, ends_a, ends_b in aligner.align(batch.column(1).to_pylist()):
                last_a, last_b = a[ends_a - 1].astype(np.int64), b[ends_b - 1].astype(np.int64)
                sha = sha256()
                for part in aligner.groups(a, b, ends_a, ends_b):
                    sha.update(part)
                for c, value in zip(out, (len(a), len(b), len(ends_a), sha.hexdigest() if len(a) else "", (last_a << 32) + last_b)):
                    c.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string()), _list(out[4], pa.int64())], names)

    return _rows(docs, doc_id, text).mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<long>")


def link_counts(linked: DataFrame) -> DataFrame:
    """``link, n``: how often each pair of ids is linked in all of ``linked`` (column ``links``).

    Two tokens that end together are equal or one ends with the other, so a token has at most as many partners as bytes, times
    the entries with the same bytes: the table is bounded by the two vocabularies, however large the corpus is.
    """
    return linked.select(F.explode("links").alias("link")).groupBy("link").agg(F.count("*").alias("n"))


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """The bound of ``link_counts``: pairs of entries of which one ends with the other."""
    have_a, have_b = Counter(a), Counter(b)
    longer_a = sum(have_b[x[i:]] for x in a for i in range(len(x)))
    return longer_a + sum(have_a[x[i:]] for x in b for i in range(1, len(x)))


def alignment_report(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs``.

    A pair's count is how many links of all documents hold it. ``n_best`` counts the links whose pair is the most frequent of
    its second id (ties included), ``count_sum`` adds up the counts. ``groups_sha256`` is the digest of ``a1,a2|b1;a3|b2,b3``.
    Rows without tokens (see ``alignments``) have zeros and an empty string.
    """
    linked = stage(_linked(docs, a_path, b_path, doc_id, text), "linked")
    found = link_counts(linked).toArrow()  # bounded by the vocabularies, see above
    pairs, n = (found.column(i).to_numpy() for i in range(2))
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order].astype(np.int64)
    second = pairs & 0xFFFFFFFF
    most = np.zeros(int(second.max()) + 1 if len(second) else 1, np.int64)
    np.maximum.at(most, second, n)
    table = docs.sparkSession.sparkContext.broadcast((pairs, n, n == most[second]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = table.value
        for b in batches:
            links = b.column(5)
            at = np.searchsorted(known, links.flatten().to_numpy(zero_copy_only=False))
            sizes = np.asarray(links.value_lengths().fill_null(0))
            ends = np.cumsum(sizes)
            sums = [np.concatenate([[0], np.cumsum(v[at], dtype=np.int64)]) for v in (best, count)]
            made = [pa.array(s[ends] - s[ends - sizes], pa.int64()) for s in sums]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(sizes, pa.int64()), *made, b.column(4)], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return linked.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
