"""Quality classifier from weak labels.

Several heuristic labellers vote on two faults of a text, junk and toxicity, each for, against or not at all. Expectation
maximisation finds how often each labeller is right from how their votes go together over all documents, without labels of
its own, and gives every document a posterior. On a bounded sample the posteriors train a linear scorer over hashed words,
word beginnings and style, which then judges every document.

The toxic word lists are learned on a bounded sample of labelled rows, if there is a label table, beside a short fixed one.
"""

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import named, stage, texts

#: Labelled rows, at most, that word lists are learned on, and words of each list.
LABELLED, LISTED = 6_000, 5_000
#: Documents, at most, of each class that the scorer is trained on: with a fault, and without.
FAULTY, CLEAN = 1_500, 3_000
#: Bits of the feature hash; score from which a document is rejected: below a half, since faults are rarer in the sample
#: than other texts and shrunk weights keep scores apart but low.
BITS, THRESHOLD = 18, 0.3

# Fixed words: common English insults.
INSULTS = frozenset("asshole bastard bitch clown creep disgusting dumb fool freak idiot imbecile jerk loser moron pathetic pig retard scum shit slut stupid trash vermin whore worthless".split())

#: As two labellers, since how often two go together is what tells how often each is right.
HALVES = [frozenset(w for w in INSULTS if crc32(w.encode()) % 2 == i) for i in range(2)]

#: Style labellers: measure, at least this much votes for junk, at most this much against it.
STYLE = (
    ("symbols", 0.10, 0.02),  # of the characters, neither letters, digits, white space nor the usual marks
    ("capitals", 0.50, 0.20),  # of the letters; of texts of LETTERS at least
    ("repeats", 0.20, 0.05),  # words equal to the one before
    ("bare", 0.10, 0.02),  # words without letter or digit
    ("doubled", 0.20, 0.05),  # symbols next to symbols, per word
    ("again", 0.70, 0.50),  # words met before in the text; of texts of LONG words at least
)
LONG, LETTERS = 50, 20
NO, YES, NONE = 0, 1, 2

_WORD = re.compile(r"[^\W\d_]+")
_SPACE, _LOW, _HIGH, _DIGIT, _SYMBOL, _MARK, _OTHER = range(7)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[:128] = _SYMBOL
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[ord("a") : ord("z") + 1] = _LOW
_KIND[ord("A") : ord("Z") + 1] = _HIGH
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[list(b".,;:!?'\"()-")] = _MARK


def style(text: str) -> list[float | None]:
    """The measures of ``STYLE``; None where a text is too short for one."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [None] * len(STYLE)
    kind = _KIND[np.frombuffer(raw, np.uint8)]
    n = np.bincount(kind, minlength=7)
    sign = (kind == _SYMBOL) | (kind == _MARK)
    text_sign = np.concatenate([[False], sign, [False]])
    edge = np.concatenate([[True], kind == _SPACE, [True]])
    starts, ends = np.flatnonzero(edge[:-1] & ~edge[1:]), np.flatnonzero(edge[1:] & ~edge[:-1])  # of words
    upto = np.concatenate([[0], np.cumsum(sign)])
    letters = n[_LOW] + n[_HIGH]
    return [
        n[_SYMBOL] / max(1, n.sum() - n[_SPACE]),
        n[_HIGH] / letters if letters >= LETTERS else None,
        sum(map(eq, words, words[1:])) / len(words),
        float((upto[ends] - upto[starts] == ends - starts).sum()) / len(words),
        int((text_sign[1:] & text_sign[:-1]).sum()) / len(words),
        1 - len(set(words)) / len(words) if len(words) >= LONG else None,
    ]


def style_votes(measures: Sequence[float | None]) -> list[int]:
    return [NONE if m is None else YES if m >= most else NO if m <= least else NONE for m, (_, most, least) in zip(measures, STYLE)]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def beginnings(word: str) -> list[str]:
    """The features of a word: itself and its first four and five characters."""
    return [word, *(f"{n}:{word[:n]}" for n in (4, 5) if len(word) > n)]


def twice(words: set[str]) -> list[str]:
    """The first five characters that several different words share."""
    return [f"+:{w}" for w, n in Counter(w[:5] for w in words if len(w) > 5).items() if n > 1]


def toxic_votes(words: set[str], lists: Sequence[frozenset[str]]) -> list[int]:
    """The halves of the fixed list, then the learned lists of words, of beginnings and of shared beginnings."""
    one, two, whole, four, five, more = lists
    starts = [{f"{n}:{w[:n]}" for w in words if len(w) > n} if part else set() for n, part in ((4, four), (5, five))]
    found = ((words, one), (words, two), (words, whole), (starts[0], four), (starts[1], five), (twice(words) if more else (), more))
    return [int(not listed.isdisjoint(have)) for have, listed in found]


def near(words: set[str]) -> int:
    """The same for copies with few words changed: from the longest word. It only thins samples out."""
    return crc32(max(words, key=lambda w: (len(w), w)).encode()) if words else 0


# Learning the lists.


def learn_lists(docs: DataFrame, labels: DataFrame | None, doc_id: str, text: str, labelled: int = LABELLED, support: int = 8) -> list[frozenset[str]]:
    """The fixed list and the learned ones: words, and beginnings of words, of toxic texts that others hardly have."""
    if labels is None:
        return [*HALVES, *[frozenset()] * 4]
    some = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = stage(some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled), "labelled")
    rows = texts(docs, doc_id, text).join(F.broadcast(some), "doc_id").select("text", F.col("toxic").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [words_of(t) for t in b.column(0).to_pylist()]
            parts = [list(dict.fromkeys(chain(chain.from_iterable(map(beginnings, w)), twice(w)))) for w in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.list_(pa.string())), pa.array([near(w) for w in found], pa.int64()), b.column(1)], ["parts", "near", "toxic"]
            )

    seen = stage(rows.mapInArrow(run, "parts array<string>, near long, toxic long"), "parts")
    # groups of near copies count once
    once = seen.select("near", "toxic", F.explode("parts").alias("part")).groupBy("part", "near").agg(F.max("toxic").alias("toxic"))
    found = once.groupBy("part").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    found = found.where((F.col("toxic") >= support) & (F.col("toxic") >= 0.98 * F.col("n")))
    kind = F.when(F.col("part").rlike("^4:"), 1).when(F.col("part").rlike("^5:"), 2).when(F.col("part").startswith("+:"), 3).otherwise(0)
    found = stage(found.select("part", "toxic", kind.alias("kind")), "lists")
    lists = [found.where(F.col("kind") == k).orderBy(F.col("toxic").desc(), "part").limit(LISTED).toArrow() for k in range(4)]
    return [*HALVES, *(frozenset(x.column("part").to_pylist()) for x in lists)]


# Expectation maximisation over vote patterns.


def posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """The probability of the fault for each pattern of votes (a row of NO, YES, NONE), given how many documents have it.

    Votes are independent given the truth. Starts from "any vote for it"; the steps estimate how often each labeller votes
    which way on faulty and on other documents, and the posteriors that follow.
    """
    p = np.where((patterns == YES).any(1), 0.9, 0.05)
    votes = [patterns == v for v in (NO, YES, NONE)]
    for _ in range(rounds):
        logs = []
        for q in (p, 1 - p):
            w = q * counts
            total = w.sum()
            rate = np.stack([(w[:, None] * v).sum(0) + 1 for v in votes]) / (total + 3)
            logs.append(np.log((total + 1) / (counts.sum() + 2)) + sum(v @ np.log(r) for v, r in zip(votes, rate)))
        p = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -500, 500)))
    return p


# The scorer.


def features(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text: words and beginnings, weighed by how many there are, and style."""
    words = words_of(text)
    mask = (1 << bits) - 1
    index = np.fromiter((crc32(x.encode()) & mask for w in words for x in beginnings(w)), np.int64)
    index, n = np.unique(index, return_counts=True)
    look = np.array(style_features(style(text), bits), np.int64)
    return np.concatenate([index, look]), np.concatenate([n * weight(words), np.ones(len(look))])


def weight(words: set[str]) -> float:
    """Of a word of a text: long texts have more words by chance."""
    return 4 / (1 + len(words)) ** 0.5


def style_features(measures: Sequence[float | None], bits: int) -> list[int]:
    """Each measure as one of a few steps between its two bounds and beyond."""
    mask = (1 << bits) - 1
    steps = ((name, "none" if m is None else min(6, max(-1, int(4 * (m - least) // (most - least))))) for m, (name, most, least) in zip(measures, STYLE))
    return [crc32(f"style:{name}:{step}".encode()) & mask for name, step in steps]


def train(index: np.ndarray, value: np.ndarray, row: np.ndarray, target: np.ndarray, bits: int, l1: float = 1e-4, rounds: int = 120) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer on soft targets, by accelerated proximal steps; ``l1`` empties useless weights.

    Features of fewer than three texts are left out.
    """
    n, size = len(target), 1 << bits
    if not n:
        return np.zeros(size), 0.0
    often = np.bincount(index, minlength=size) >= min(3, n)
    keep = often[index]
    index, value, row = index[keep].astype(np.int64), value[keep].astype(np.float64), row[keep].astype(np.int64)
    reach = 1 + np.bincount(row, value, n)  # steps by feature: rare ones may go far
    step = 4 * n / np.maximum(np.bincount(index, value * reach[row], size), 1e-9)
    pace = 4 * n / reach.sum()
    w, b, z, c, t = np.zeros(size), 0.0, np.zeros(size), 0.0, 1.0
    for _ in range(rounds):
        score = np.bincount(row, z[index] * value, n) + c
        error = (1 / (1 + np.exp(-np.clip(score, -50, 50))) - target) / n
        new = z - step * np.bincount(index, error[row] * value, size)
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        bias = c - pace * error.sum()
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z, c = new + (t - 1) / after * (new - w), bias + (t - 1) / after * (bias - b)
        w, b, t = new, bias, after
    return w, b


class Scorer:
    """Weights of both faults; remembers what words add to the scores."""

    def __init__(self, weights: Sequence[tuple[np.ndarray, float]], bits: int, remembered: int = 1_000_000):
        (junk, self.junk), (toxic, self.toxic) = weights
        # both scores of a feature as one complex number, so that one sum adds both; whole parts of 2 ** 20, so that sums
        # are exact in whatever order a set gives its words
        self.weights = np.round((junk + 1j * toxic) * 2**20) / 2**20
        self.bits, self.known, self.remembered = bits, {}, remembered

    def word(self, w: str) -> complex:
        mask = (1 << self.bits) - 1
        return complex(sum(self.weights[crc32(x.encode()) & mask] for x in beginnings(w)))

    def __call__(self, text: str) -> tuple[float, float]:
        words, known = words_of(text), self.known
        if len(known) > self.remembered:
            known.clear()
        for w in words.difference(known):
            known[w] = self.word(w)
        total = sum(map(known.__getitem__, words)) * weight(words) if words else 0j
        total += complex(self.weights[style_features(style(text), self.bits)].sum())
        return tuple(1 / (1 + np.exp(-np.clip(s, -50, 50))) for s in (total.real + self.junk, total.imag + self.toxic))


_VOTES = "doc_id long, text_hash long, near long, junk string, toxic string"


def _votes(docs: DataFrame, lists: Sequence[frozenset[str]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, ...] = ([], [], [])
            for t in b.column(2).to_pylist():
                words = words_of(t)
                out[0].append(near(words))
                out[1].append("".join(map(str, style_votes(style(t)))))
                out[2].append("".join(map(str, toxic_votes(words, lists))))
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(o, k) for o, k in zip(out, kinds))], ["doc_id", "text_hash", "near", "junk", "toxic"])

    return docs.select("doc_id", F.xxhash64("text"), "text").mapInArrow(run, _VOTES)


def _posterior(votes: DataFrame, trait: str) -> DataFrame:
    """``trait, p_trait`` per pattern of votes; the driver sees one count per pattern."""
    found = votes.groupBy(trait).count().orderBy(trait).toArrow()
    names = found.column(trait).to_pylist()
    patterns = np.array([[int(v) for v in name] for name in names])
    p = posteriors(patterns, found.column("count").to_numpy().astype(np.float64)) if names else []
    rows = pa.table({trait: pa.array(names, pa.string()), f"p_{trait}": pa.array(p, pa.float64())})
    return votes.sparkSession.createDataFrame(rows)


def fit(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", faulty: int = FAULTY, clean: int = CLEAN, bits: int = BITS) -> list[tuple[np.ndarray, float]]:
    """The weights of both scorers, from the votes on all of ``docs``; ``labels`` has ``doc_id, toxic``."""
    lists = learn_lists(docs, labels, doc_id, text)
    docs = texts(docs, doc_id, text)
    votes = stage(_votes(docs, lists), "votes")
    for trait in ("junk", "toxic"):
        votes = votes.join(F.broadcast(_posterior(votes, trait)), trait)  # 3 ** 6 and 2 ** 6 patterns at most
    picks = None
    for of, n in (("p_junk >= 0.5", faulty), ("p_toxic >= 0.5", faulty), ("p_junk < 0.5 AND p_toxic < 0.5", clean)):
        one = votes.where(of).groupBy("near").agg(F.min(F.struct("text_hash", "doc_id", "p_junk", "p_toxic")).alias("one"))
        one = one.orderBy(F.xxhash64("near"), "near").limit(n).select("one.*")
        picks = one if picks is None else picks.union(one)
    picks = stage(picks, "picks").dropDuplicates(["text_hash"]).withColumnsRenamed({"doc_id": "id_", "text_hash": "hash_"})
    same = docs.doc_id.eqNullSafe(F.col("id_")) & (F.xxhash64(docs.text) == F.col("hash_"))
    sample = docs.join(F.broadcast(picks), same).select("hash_", "p_junk", "p_toxic", "text")  # `faulty`, `clean` rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t, bits) for t in b.column(3).to_pylist()]
            index = pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32()))
            value = pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), index, value], ["hash_", "p_junk", "p_toxic", "index", "value"])

    made = stage(sample.mapInArrow(run, "hash_ long, p_junk double, p_toxic double, index array<int>, value array<float>"), "features")
    rows = made.dropDuplicates(["hash_"]).toArrow().sort_by("hash_")
    index, value = (rows.column(k).combine_chunks() for k in ("index", "value"))
    row = np.repeat(np.arange(rows.num_rows, dtype=np.int32), index.value_lengths().to_numpy() if rows.num_rows else [])
    index, value = index.flatten().to_numpy(), value.flatten().to_numpy()
    targets = [rows.column(f"p_{trait}").to_numpy() for trait in ("junk", "toxic")]
    return [train(index, value, row, target, bits) for target in targets]


def judge(docs: DataFrame, weights: Sequence[tuple[np.ndarray, float]], doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, bits: int = BITS) -> DataFrame:
    """``doc_id, junk_score, toxic_score, rejected`` of every row, by trained weights."""
    known = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** bits numbers each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(known.value, bits)
        for b in batches:
            scores = np.array([scorer(t) for t in b.column(1).to_pylist()]).reshape(-1, 2).round(6)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores[:, 0]), pa.array(scores[:, 1])], ["doc_id", "junk_score", "toxic_score"])

    out = texts(docs, doc_id, text).mapInArrow(run, "doc_id long, junk_score double, toxic_score double")
    return out.withColumn("rejected", (F.col("junk_score") >= threshold) | (F.col("toxic_score") >= threshold))


def classify(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, junk_score, toxic_score, rejected`` of every row, by scorers trained on the same rows.

    A score rises with the probability of the fault; a document with one of at least ``THRESHOLD`` is rejected. Null and empty texts have no
    words and no style, and are judged by what the scorer learned of such texts, which is nothing if there are none. Repeated
    rows get equal scores and come back as often as they were given. Without ``labels`` only the fixed list speaks of
    toxicity. No rows: no rows.
    """
    return judge(docs, fit(docs, labels, doc_id, text), doc_id, text)


def drop_rejected(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected."""
    known = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id, text))

    @F.pandas_udf("boolean")
    def good(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(known.value, BITS)
        for part in parts:
            yield pd.Series([max(scorer(t)) < THRESHOLD for t in part], dtype="bool")

    return docs.where(good(F.coalesce(named(text).cast("string"), F.lit(""))))  # texts stay where they are read
