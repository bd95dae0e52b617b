"""Benchmark decontamination by a broadcast hash set of normalised test n-grams; DataFrame functions only.

A window of L words holds, wherever it lies in a document, one of the document's probes: the first half of L words (rounded
up) at every step of the rest plus one. So documents are read once, one probe per step is looked up among the hashes of all
test n-grams of that length, and around each find the windows are compared word by word.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, named, row_key, semi, stage, texts

#: Words of a window, and the share of a document's words, as one in so many, that must be hit to call it contaminated.
WINDOW, ONE_IN = 13, 20
#: Bytes, at most, of the n-gram table that is broadcast; beyond it both sides are shuffled by hash.
BROADCAST = 64 << 20

# A-Z are word characters here and are lower-cased after splitting.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _GAP, -1), lambda w: w != "")


def _exact(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, string.ascii_uppercase, string.ascii_lowercase))


def _hash(words: Column) -> Column:
    # lower() also changes other letters than A-Z; that only finds more, and what is found is compared exactly
    return F.xxhash64(F.lower(F.array_join(words, " ")))


def _probe(length: int) -> tuple[int, int]:
    """Words of a probe and the step between probes, so that each window of ``length`` holds a whole one."""
    size = (length + 1) // 2
    return size, length - size + 1


def _around(words: Column, at: Column, length: int) -> tuple[Column, Column]:
    """The words of all windows that hold the probe at ``at``, and where they begin."""
    size, step = _probe(length)
    first = F.greatest(at - (length - size), F.lit(0))
    return F.slice(words, first + 1, at - first + length), first


def ngrams(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, list[int]]:
    """Every probe-sized n-gram of the items with the words around it, and the window lengths that occur (at most ``window``)."""
    items = benchmark.select(named(item_id).alias("item_id"), _exact(_words(F.coalesce(named(text).cast("string"), F.lit("")))).alias("words"))
    items = stage(items.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window))), "items")
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # at most `window` of them
    found = None
    for n in lengths:
        size, _ = _probe(n)
        at = items.where(F.col("length") == n).select("item_id", "words", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("at"))
        around, first = _around(F.col("words"), F.col("at"), n)
        part = at.select(_hash(F.slice("words", F.col("at") + 1, size)).alias("gram"), F.lit(n).alias("length"), "item_id", around.alias("test"), (F.col("at") - first).alias("offset"))
        found = part if found is None else found.union(part)
    if found is None:
        found = items.select(F.lit(0).cast("long").alias("gram"), F.lit(0).alias("length"), "item_id", F.col("words").alias("test"), F.lit(0).alias("offset")).where("false")
    # equal n-grams with equal surroundings are one entry that lists its items
    return stage(found.groupBy("gram", "length", "test", "offset").agg(F.collect_set("item_id").alias("items")), "ngrams"), lengths


def _one_probe(words: Column, length: int) -> Callable[[Column], Column]:
    def probe(at: Column) -> Column:
        around, first = _around(words, at, length)
        return F.struct(_hash(F.slice(words, at + 1, _probe(length)[0])), F.lit(length), at, first, around)

    return probe


def _probes(words: Column, lengths: list[int]) -> Column:
    """The probes of a document, after a first entry that stands for the document itself."""
    kind = "array<struct<gram:bigint,length:int,at:int,first:int,around:array<string>>>"
    parts = [F.array(F.struct(F.lit(None), F.lit(None), F.lit(None), F.lit(None), F.lit(None))).cast(kind)]
    for n in lengths:
        size, step = _probe(n)
        places = F.sequence(F.lit(0), F.size(words) - size, F.lit(step))
        parts.append(F.when(F.size(words) >= size, F.transform(places, _one_probe(words, n)).cast(kind)).otherwise(F.array().cast(kind)))
    return F.concat(*parts)


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast: int = BROADCAST) -> DataFrame:
    """``doc_id, text_hash, copies, n_words, items, hit`` per different row of ``doc_id, text``.

    ``hit`` are the places of the words hit, from 0, in order; ``items`` the items with windows there.
    """
    grams, lengths = ngrams(benchmark, window=window)
    size = grams.agg(F.sum(F.octet_length(F.array_join("test", " ")) + 16 * F.size("test") + 16 * F.size("items") + 64)).first()[0] or 0
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _words(F.col("text")).alias("words"))
    probes = words.select("doc_id", "text_hash", F.size("words").alias("n"), F.inline(_probes(F.col("words"), lengths)))
    grams = grams.select(F.col("gram").alias("gram_"), F.col("length").alias("length_"), "test", "offset", "items")
    same = (F.col("gram") == F.col("gram_")) & (F.col("length") == F.col("length_"))
    if size <= broadcast:
        met = probes.join(F.broadcast(grams), same, "left").where("gram IS NULL OR test IS NOT NULL")
    else:
        met = probes.join(grams, same).unionByName(probes.where("gram IS NULL"), allowMissingColumns=True)
    # the probe lies `at - first` words into `around` and `offset` words into `test`; compare every window that holds it
    here = F.col("at") - F.col("first")

    def equal(start: Column) -> Column:  # of a window in `around`
        there = start - here + F.col("offset")
        inside = (there >= 0) & (there + F.col("length") <= F.size("test"))
        return F.when(inside, _exact(F.slice("around", start + 1, F.col("length"))) == F.slice("test", there + 1, F.col("length"))).otherwise(False)

    starts = F.sequence(F.lit(0), F.size("around") - F.col("length"))
    starts = F.when(F.col("test").isNotNull() & (F.size("around") >= F.col("length")), F.filter(starts, equal))
    places = F.transform(starts, lambda s: F.sequence(F.col("first") + s, F.col("first") + s + F.col("length") - 1))
    met = met.select("doc_id", "text_hash", "n", "items", F.array_distinct(F.flatten(places)).alias("hit"), F.col("gram").isNull().alias("own"))
    return (
        met.where("own OR size(hit) > 0")
        .groupBy("doc_id", "text_hash")
        .agg(
            F.sum(F.col("own").cast("long")).alias("copies"),
            F.max("n").cast("long").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("hit")))).alias("hit"),
        )
    )


def _contaminated(one_in: int) -> Column:
    return (F.size("hit") > 0) & (one_in * F.size("hit") >= F.col("n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, one_in: int = ONE_IN) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row of ``docs``.

    Texts are lower-cased (A-Z) and cut into words of digits, letters and anything outside ASCII. ``window`` consecutive words
    of an item of ``benchmark`` (``item_id, text``) are a window; all words of a shorter item are one. A word of a document
    inside any occurrence of a window is hit. ``n_items`` counts the items with such windows, ``items_sha256`` digests their ids,
    sorted as strings and joined by commas. A document is contaminated if at least one in ``one_in`` of its words is hit, and
    one word at least. Null or empty texts have no words; items without words are ignored, repeated items count once per id.
    Repeated rows come back as often as they were given. No rows: no rows.
    """
    found = find_hits(texts(docs, doc_id, text), benchmark, window)
    items = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    out = found.select(
        "doc_id",
        "n_words",
        F.size("hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        _contaminated(one_in).alias("contaminated"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    )
    return out.drop("copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, one_in: int = ONE_IN) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    found = find_hits(texts(docs, doc_id, text), benchmark, window).where(_contaminated(one_in))
    key = row_key(named(doc_id), named(text))
    bad = stage(found.select("doc_id", "text_hash"), "contaminated").select(F.struct("doc_id", "text_hash"))
    at = fresh(docs, "at")
    return semi(docs.withColumn(at, key), bad, at, "left_anti").drop(at)


def cut_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, without the words hit and the gaps after them."""
    found = stage(find_hits(texts(docs, doc_id, text), benchmark, window).where(F.size("hit") > 0).select("doc_id", "text_hash", "hit"), "hits")
    body = F.col("text_")
    rows = docs.select(F.struct(*map(named, docs.columns)).alias("all_"), named(doc_id).cast("long").alias("id_"), F.coalesce(named(text), F.lit("")).alias("text_"))
    rows = rows.join(found, F.col("id_").eqNullSafe(F.col("doc_id")) & (F.xxhash64("text_") == F.col("text_hash")), "left")
    gaps = F.split(body, _WORD, -1)
    pieces = F.zip_with(_words(body), F.slice(gaps, 2, F.size(gaps) - 1), lambda w, g: F.concat(w, g))
    before = F.concat(F.array(F.lit(-1)), "hit")
    after = F.concat("hit", F.array(F.size(_words(body))))
    rows = rows.withColumns({"pieces_": F.when(F.col("hit").isNotNull(), pieces), "first_": gaps[0]})
    kept = F.flatten(F.zip_with(before, after, lambda a, b: F.slice(F.col("pieces_"), a + 2, b - a - 1)))
    cut = F.when(F.col("hit").isNull(), F.col("all_")[text]).otherwise(F.concat("first_", F.array_join(kept, "")))
    return rows.select(*[cut.alias(c) if c == text else F.col("all_")[c].alias(c) for c in docs.columns])
