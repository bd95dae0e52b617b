"""Stupid-backoff scores from n-gram counts.

The model has the counts of all words and of all pairs of neighbouring words of the corpus, both in tables. Tasks count before
the shuffle; words and pairs are known by 64-bit hashes, and counts, models and documents meet in joins on those. A score is the
sum of what each word counts for by itself and of what its pair, if seen, puts in the place of that, so both are looked up alike.

    S(w | v) = c(v w) / c(v)        if the pair was seen at least ``least`` times
             = alpha * c(w) / N     otherwise

A text's first word has a begin mark before it. Only if a vocabulary size is asked for, all words but the most frequent ones
are one word, ``<unk>``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import discard, setting, stage, texts
from millrace.session import work_path

#: Occurrences below which a pair does not count as seen, and the factor of backing off.
LEAST, ALPHA = 2, 0.4
#: Words that a reading task counts before it passes them on, and characters of the texts whose words it finds at once.
PACK = 1 << 21
#: Words and pairs, those met most often, whose values every task has: so many at most.
HOT = 1 << 18
#: Parts of the texts that are scored one after the other.
ROUNDS = 2
#: Joins become hash joins if no task's share of the values is larger, as measured; others sort.
HASHED = ("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "16m")
#: Words and pairs that a reading task has counted are so many that Spark's first, small map of them only costs time.
ONE_MAP = ("spark.sql.codegen.aggregate.map.twolevel.enabled", "false")
#: What texts ask for: a row for each text, with what is known of it and a key that only deals it out, and rows with the keys of
#: its other words and pairs.
NAMES = ["row", "about", "keys"]
ABOUT = pa.struct([("doc_id", pa.int64()), ("n_words", pa.int64()), ("base", pa.float64()), ("met", pa.int64())])
#: Keys in such a row; bytes of words hashed eight at a time for all words at once, longer ones singly.
RUN, LONG = 1 << 12, 256

UNK, BEGIN = 0, 1  # ids in a vocabulary; words follow from 2, and also the keys of the two marks

_SPACE = re.compile(r"[^\S\x00-\x7F]")  # white space outside ASCII
_BLANK = np.array([i < 128 and chr(i).isspace() for i in range(256)])


def words_of(text: str) -> list[str]:
    return text.lower().split()


class Model:
    """Counts of words (``w, n``) and pairs (``v, w, n``) as tables, the number of words in all, and a vocabulary if one was asked for."""

    def __init__(self, vocabulary: Broadcast | None, counts: DataFrame, total: int, least: int, alpha: float):
        self.vocabulary, self.total, self.least, self.alpha = vocabulary, total, least, alpha
        self.words, self.pairs = counts.where("v IS NULL").select("w", "n"), counts.where("v IS NOT NULL")


def _vocabulary(docs: DataFrame, size: int) -> tuple[dict[str, int], np.ndarray]:
    """Ids of the most frequent words and the counts by id; all other words count as ``<unk>``.

    Words of equal count are all in or all out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(words_of(t))
            if len(seen) > PACK:  # combine in the task, within bounds
                yield _counted(seen)
                seen = Counter()
        yield _counted(seen)

    words = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = stage(words, "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    top = _commonest(words, size).toArrow().sort_by([("n", "descending"), ("word", "ascending")])  # `size` rows at most
    counts = np.concatenate([[0, docs.count()], top.column("n").to_numpy()]).astype(np.int64)
    counts[UNK] = total - counts[2:].sum()
    return {w: i + 2 for i, w in enumerate(top.column("word").to_pylist())}, counts


def _commonest(counted: DataFrame, size: int) -> DataFrame:
    """The rows with the largest ``n``, ``size`` at most: rows of equal ``n`` are all in or all out. No task sees the others."""
    fewest, room = 1 << 62, size
    for n, different in counted.groupBy("n").count().orderBy(F.col("n").desc()).toLocalIterator():
        if different > room:
            break
        fewest, room = n, room - different
    return counted.where(F.col("n") >= fewest)


def _counted(seen: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def _words(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How many words (as :func:`words_of` finds them) each text has, and the key of each: 64 bits that are neither mark."""
    from xxhash import xxh64_intdigest

    parts = [(t if t.isascii() else _SPACE.sub(" ", t)).encode("utf-8", "replace") for t in map(str.lower, batch)]
    joined = b" ".join([b"", *parts, b" " * 15])  # eight bytes may be read from any place of a word
    eights, blank = np.frombuffer(joined, "<u8", len(joined) >> 3), _BLANK[np.frombuffer(joined, np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    at = np.cumsum([1, *(len(x) + 1 for x in parts)])
    keys, rest = _mixed(sizes.astype(np.uint64)), np.flatnonzero(sizes <= LONG)
    for done in range(0, LONG, 8):
        if done:
            rest = rest[sizes[rest] > done]
        begin, left = starts[rest] + done, np.minimum(sizes[rest] - done, 8).astype(np.uint64)
        i, shift = begin >> 3, (begin & 7).astype(np.uint64) << np.uint64(3)
        eight = eights[i] >> shift | eights[i + 1] << np.uint64(1) << (np.uint64(63) - shift)
        keys[rest] = _mixed(keys[rest] ^ (eight & ~np.uint64(0) >> (np.uint64(64) - (left << np.uint64(3)))))
    for i in np.flatnonzero(sizes > LONG):
        keys[i] = xxh64_intdigest(joined[starts[i] : starts[i] + sizes[i]], 42)
    return np.diff(np.searchsorted(starts, at)), np.where(keys > BEGIN, keys, keys + np.uint64(2)).view(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each of 64 bits changes half of the others (the last steps of SplitMix64); no two values become one."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _chunks(batches: Iterator[pa.RecordBatch], known: Broadcast | None, size: int) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray, np.ndarray]]:
    """Whole batches of about ``size`` words: what the batches have beside texts, the words of each text, and each word's key after that of the one before."""
    ids = known.value[0] if known else None
    kept, counts, held, n = [], [], [], 0

    def chunk() -> tuple:
        sizes, w = np.concatenate(counts), np.concatenate(held)
        counts.clear()
        held.clear()
        v = np.concatenate([[BEGIN], w[:-1]])[: len(w)]
        v[(np.cumsum(sizes) - sizes)[sizes > 0]] = BEGIN
        return kept, sizes, v, w

    for b in batches:
        kept.append(b.select(range(b.num_columns - 1)))
        for part in _parted(b.column(b.num_columns - 1).to_pylist()):
            if ids is None:
                each, keys = _words(part)
            else:
                split = [[ids.get(w, UNK) for w in words_of(t)] for t in part]
                each, keys = np.array([len(x) for x in split], np.int64), np.array([w for x in split for w in x], np.int64)
            counts.append(each)
            held.append(keys)
            n += len(keys)
        if n >= size:
            yield chunk()
            kept, n = [], 0
    if held:
        yield chunk()


def _parted(found: list[str]) -> Iterator[list[str]]:
    """The texts in parts of about ``PACK`` characters, which bounds what is held beside the keys."""
    part, n = [], 0
    for t in found:
        part.append(t)
        n += len(t)
        if n >= PACK:
            yield part
            part, n = [], 0
    if part:
        yield part


def _spread(keys: np.ndarray) -> np.ndarray:
    """Keys, ids in a vocabulary too, told apart by their upper bits."""
    return keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _grouped(spread: np.ndarray) -> np.ndarray:
    """An order that brings equal values together, nearly ascending, and each value's places in theirs.

    One number holds a value's upper bits and its place, which sorts faster than places by value. Where different values
    agree in those bits, one may come in several runs; every use adds such runs up.
    """
    bits = np.uint64(len(spread).bit_length())
    place = np.arange(len(spread), dtype=np.uint64)
    return (np.sort(spread >> bits << bits | place) & (np.uint64(1) << bits) - np.uint64(1)).view(np.int64)


def _runs(*ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    size = len(ordered[0])
    starts = np.flatnonzero(np.concatenate([[True], reduce(np.logical_or, (x[1:] != x[:-1] for x in ordered))])[:size])
    return starts, np.diff(np.append(starts, size))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: int | None = None, least: int = LEAST, alpha: float = ALPHA, fewest: int = 1, at: str | None = None) -> Model:
    """Count the words and pairs of all of ``docs``. Null texts have no words; an empty table gives an empty model.

    With ``vocabulary`` only so many words are told apart, and these are broadcast. All are counted, but pairs with a count below
    ``fewest`` are not kept; up to ``least`` this changes no score. ``at`` names the folder for the counts.
    """
    docs = texts(docs, doc_id, text)
    known = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast(_vocabulary(docs, vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sizes, v, w in _chunks(batches, known, PACK):
            order = _grouped(_spread(v) >> np.uint64(44) << np.uint64(44) | _spread(w) >> np.uint64(20))  # pairs of a word stand together, which packs better
            v, w = v[order], w[order]
            starts, n = _runs(v, w)
            v, w = v[starts], w[starts]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (v, w, n)], ["v", "w", "n"])
            order = _grouped(_spread(w))
            w, n = w[order], n[order]
            starts, _ = _runs(w)
            w, n = np.append(w[starts], BEGIN), np.append(np.add.reduceat(n, starts) if len(n) else n, len(sizes))  # a begin mark for each text
            yield pa.RecordBatch.from_arrays([pa.nulls(len(w), pa.int64()), pa.array(w), pa.array(n)], ["v", "w", "n"])

    counts = docs.select("text").mapInArrow(count, "v long, w long, n long").groupBy("v", "w").agg(F.sum("n").alias("n"))
    with setting(docs.sparkSession, *ONE_MAP):
        counts = stage(counts.where(F.col("v").isNull() | (F.col("n") >= fewest)), "counts", at=at)
    total = counts.where(F.col("v").isNull() & (F.col("w") != BEGIN)).agg(F.sum("n")).first()[0] or 0
    return Model(known, counts, total, least, alpha)


def _pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One key of two: those of words are spread over 64 bits, and ids in a vocabulary stay apart."""
    v = v.view(np.uint64)
    return w ^ (v << np.uint64(31) | v >> np.uint64(33)).view(np.int64)


def _values(model: Model) -> DataFrame:
    """``key, value, seen, n``: what a word (key inverted) or a pair adds to a score, beside what each word counts for if seen once.

    A pair that was seen takes back what its word added. What is not in the table adds nothing.
    """

    def log(n: Column) -> Column:
        return F.log(F.greatest(n, F.lit(1)).cast("double"))

    before, own = (model.words.select(F.col("w").alias(f"{c}_"), F.col("n").alias(f"{c}_n")) for c in "vw")
    words = model.words.where(F.col("n") > 1).select(F.bitwise_not("w").alias("key"), log(F.col("n")).alias("value"), F.lit(0).alias("seen"), "n")
    pairs = model.pairs.where(F.col("n") >= model.least).join(before, F.col("v") == F.col("v_")).join(own, F.col("w") == F.col("w_"))
    left = F.shiftleft("v", 31).bitwiseOR(F.shiftrightunsigned("v", 33))  # as in _pair_keys
    value = log(F.col("n")) - log(F.col("v_n")) - log(F.col("w_n")) - F.lit(_once(model))
    return words.union(pairs.select(F.col("w").bitwiseXOR(left).alias("key"), value.alias("value"), F.lit(1).alias("seen"), "n"))


def _once(model: Model) -> float:
    """The score of a word that was seen once, after one it was not seen after."""
    return math.log(model.alpha) - math.log(max(model.total, 1))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score, n_backed_off`` of every row.

    ``log_score`` is the sum of the natural logarithms of the words' scores, to six decimals; ``n_backed_off`` the words whose
    pair was not seen. A word that the model does not know counts as seen once. Texts without words (null, empty, blank) score
    0 and have a null mean. Words are lower-cased and split at white space. Repeated rows come back as often as they were
    given.
    """
    return _scored(docs, model, stage(_values(model), "values"), doc_id, text)


def _scored(docs: DataFrame, model: Model, values: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The ``HOT`` words and pairs met most often are broadcast and summed where texts are read, so no key is hot in the join that
    gives the others their values. Texts come in ``ROUNDS``, so that only a part of their pairs is on disk at a time."""
    docs = texts(docs, doc_id, text)
    known, once = model.vocabulary, _once(model)
    top = _commonest(values, HOT).select("key", "value", "seen").toArrow()
    top = [top.column(c).to_numpy() for c in range(3)]
    order = np.argsort(_spread(top[0]))
    hot = docs.sparkSession.sparkContext.broadcast([_spread(top[0])[order], top[1][order], top[2][order]])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_keys, hot_values, hot_seen = hot.value
        for kept, sizes, v, w in _chunks(batches, known, max(1, PACK >> 2)):  # twice as many keys, and nothing to combine
            texts_of = np.tile(np.repeat(np.arange(len(sizes)), sizes), 2)
            keys = np.concatenate([~w, _pair_keys(v, w)])
            base, met, cold = sizes * once, np.zeros(len(sizes)), np.ones(len(keys), bool)
            if len(hot_keys) and len(keys):
                spread = _spread(keys)
                order = _grouped(spread)
                spread = spread[order]
                starts, n = _runs(spread)
                at = np.minimum(np.searchsorted(hot_keys, spread[starts]), len(hot_keys) - 1)
                is_hot = hot_keys[at] == spread[starts]
                order, at = order[np.repeat(is_hot, n)], np.repeat(at[is_hot], n[is_hot])
                cold[order] = False
                base += np.bincount(texts_of[order], hot_values[at], len(sizes))
                met += np.bincount(texts_of[order], hot_seen[at], len(sizes))
            row, doc = (pa.chunked_array([b.column(c) for b in kept]).combine_chunks() for c in (0, 1))
            about = pa.StructArray.from_arrays([doc, *map(pa.array, (sizes, base, met.astype(np.int64)))], fields=list(ABOUT))
            own = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32)), row)
            yield pa.RecordBatch.from_arrays([row, about, own], NAMES)
            keys, texts_of = keys[cold], texts_of[cold]
            cuts = np.flatnonzero(np.concatenate([[True], texts_of[1:] != texts_of[:-1]])[: len(keys)])
            cuts = np.union1d(cuts, np.arange(0, len(keys), RUN))  # no row is as long as a long text
            of, lists = row.take(pa.array(texts_of[cuts])), pa.ListArray.from_arrays(pa.array(np.append(cuts, len(keys)).astype(np.int32)), pa.array(keys))
            yield pa.RecordBatch.from_arrays([of, pa.nulls(len(cuts), ABOUT), lists], NAMES)

    parts = []
    for i in range(ROUNDS):
        some = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == i).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        asked = some.mapInArrow(ask, "row long, about struct<doc_id long, n_words long, base double, met long>, keys array<long>")
        asked = asked.select("row", "about", F.explode("keys").alias("key"))
        joined = asked.join(values.select("key", "value", "seen"), "key", "left").where("about IS NOT NULL OR seen IS NOT NULL")
        sums = joined.groupBy("row").agg(
            F.max("about.doc_id").alias("doc_id"),
            F.sum("about.n_words").alias("n_words"),
            F.round(F.sum(F.coalesce("about.base", "value")), 6).alias("log_score"),
            F.sum(F.coalesce(F.expr("about.n_words - about.met"), -F.col("seen"))).alias("n_backed_off"),
        )
        with setting(docs.sparkSession, *HASHED):
            parts.append(stage(sums.drop("row"), "scores"))
    out = reduce(DataFrame.union, parts)
    return out.select("doc_id", "n_words", "log_score", F.round(F.col("log_score") / F.nullif("n_words", F.lit(0)), 6).alias("mean_log_score"), "n_backed_off")


def score_corpus(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all of ``docs`` by a model of all of them, whose counts go once the values are made of them."""
    at = work_path(spark, "counts")
    model = fit(docs, doc_id, text, fewest=LEAST, at=at)
    with setting(spark, *HASHED):
        values = stage(_values(model), "values")
    discard(spark, at)
    return _scored(docs, model, values, doc_id, text)
