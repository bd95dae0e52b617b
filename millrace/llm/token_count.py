"""Token counts of a byte-pair vocabulary by rank-synchronous merging.

Pre-tokens that a worker has not met yet are merged together: their symbols lie end to end in one ragged array, and in every
round each sequence joins all places of its lowest-ranked pair at once. The symbols left are the tokens. Only vocabulary and
merges come from the tokenizer's file; the library itself is not used.
"""

import json
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain
from operator import mul

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, named

#: Tokens above which ``over_limit`` is set.
LIMIT = 2048
#: Characters of the words that a worker remembers at most (beyond, it starts anew), and the longest such word: text without
#: blanks is one word a line.
REMEMBERED, LONGEST = 16_000_000, 64

_NONE = np.int64(1) << 62


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    return [hidden.get(b, chr(b)) for b in range(256)]


class MergeTable:
    """What merging needs of a tokenizer's file: a symbol for each byte, within and at the end of a word, and ranked pairs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        chars = byte_symbols()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.final = np.array([vocab[c + suffix] for c in chars], np.int64)
        self.base = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.special = [t["content"] for t in spec["added_tokens"]]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``_NONE`` if it does not merge."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE)


def count_symbols(table: MergeTable, words: Sequence[bytes]) -> np.ndarray:
    """The number of symbols left of each word (none is empty)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = lengths.copy()
    if not len(words):
        return counts
    raw = np.frombuffer(b"".join(words), np.uint8)
    sequence = np.repeat(np.arange(len(words)), lengths)
    last = np.cumsum(lengths) - 1
    symbol = table.inner[raw]
    symbol[last] = table.final[raw[last]]
    while len(symbol) > 1:
        inside = sequence[:-1] == sequence[1:]
        rank = np.where(inside, table.ranks(symbol[:-1], symbol[1:]), _NONE)
        lowest = np.full(len(words), _NONE)
        np.minimum.at(lowest, sequence[:-1], rank)
        hit = (rank != _NONE) & (rank == lowest[sequence[:-1]])
        if not hit.any():
            break
        # of places that overlap ("aaa") every other one from the left
        place = np.flatnonzero(hit)
        starts = np.concatenate([[True], np.diff(place) > 1])
        first = place[np.maximum.accumulate(np.where(starts, np.arange(len(place)), 0))]
        place = place[(place - first) % 2 == 0]
        symbol[place] = table.made[rank[place]]
        stays = np.ones(len(symbol), bool)
        stays[place + 1] = False
        stays &= lowest[sequence] != _NONE  # finished sequences go
        np.subtract.at(counts, sequence[place], 1)
        symbol, sequence = symbol[stays], sequence[stays]
    return counts


class Counting:
    """Counts the tokens of texts; remembers the words it has met.

    No pre-token holds white space, so a text is first split at spaces and only new words are cut into pre-tokens.
    """

    def __init__(self, table: MergeTable):
        import regex

        self.table, self.known, self.held = table, {}, 0
        self.parts = regex.compile(table.pattern)
        self.special = regex.compile("|".join(map(regex.escape, table.special)) or r"(?!)")

    def learn(self, words: Sequence[str]) -> None:
        """Count the tokens of words, lower-cased character by character."""
        parts = [self.parts.findall(w.replace("Σ", "σ").lower()) for w in words]
        different = {p: i for i, p in enumerate(dict.fromkeys(chain.from_iterable(parts)))}
        n = count_symbols(self.table, [p.encode("utf-8", "replace") for p in different]).tolist()
        self.known.update((w, sum(n[different[p]] for p in ps)) for w, ps in zip(words, parts))

    def count(self, texts: Sequence[str]) -> list[int]:
        pieces = [self.special.split(t) for t in texts]
        found = [Counter(chain.from_iterable(unicodedata.normalize("NFC", p).split(" ") for p in parts)) for parts in pieces]
        if self.held > REMEMBERED:
            self.known, self.held = {}, 0
        known = self.known
        new = list({w for words in found for w in words if w not in known})
        if new:
            self.learn(new)
        counts = [len(parts) - 1 + sum(map(mul, words.values(), map(known.__getitem__, words))) for parts, words in zip(pieces, found)]
        for w in new:
            if len(w) > LONGEST:
                del known[w]
            else:
                self.held += len(w)
        return counts


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``path`` is a tokenizer's JSON file on the driver. Tokens are those the library gives without adding begin or end; special
    tokens written out in a text are one token each. A null or empty text has no bytes and no tokens; texts are never cut, and
    repeated rows come back as often as they were given. No rows: no rows.
    """
    table = docs.sparkSession.sparkContext.broadcast(MergeTable(path))  # as large as the file, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(table.value)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                n = counting.count(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    whole = F.coalesce(named(text).cast("string"), F.lit(""))
    rows = docs.select(named(doc_id).cast("long"), whole, F.octet_length(whole).cast("long"))
    out = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def drop_over_limit(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has at most ``limit`` tokens; texts stay where they are read."""
    table = docs.sparkSession.sparkContext.broadcast(MergeTable(path))

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counting = Counting(table.value)
        for part in parts:
            yield pd.Series(counting.count(part.tolist()), dtype="int64")

    n = fresh(docs, "n_tokens")
    return docs.withColumn(n, count(F.coalesce(named(text), F.lit("")))).where(named(n) <= limit).drop(n)
