"""Nearest-text search at scale (J7, L10, L11).

Close matches come from an index of segments. If two texts are at most ``e`` edits apart and one is cut into ``e + 1``
segments, one segment stands unchanged in the other, shifted by a few places at most. So candidates are stored under the
hashes of their segments, an input looks up the hashes of its own substrings at those places, and only the candidates it
meets are compared. A colliding hash costs a comparison and changes no result.

An input that finds as many candidates as are asked for at a high similarity needs no others, as all left out score lower. So the
search goes down :data:`LEVELS`, each with the inputs that the one before left open. Segments get too short to tell texts
apart below ``LEAST_SIMILAR``, and their number grows with the square of the edits (``MOST_EDITS``); what is left
then is compared with every candidate whose length can still reach the threshold. All ways give the same rows:

* a segment held by many candidates, such as a common beginning, is cut into blocks of bounded size;
* texts whose segments lead to most candidates, as where all share most of their characters, are looked up by what
  remains of them when a few characters are left out: two texts at most ``e`` edits apart, of which the longer has ``n``
  characters, have ``n - e`` characters in common, in the same order. Step ``k`` finds all candidates at a similarity of at
  least ``size / (size + k)``. Only those that still want answers when texts have too many such remainders
  (``MOST_VARIANTS``), or are so few that it does not pay, are compared with each candidate;

* equal inputs are searched once, and an input equal to a candidate is settled by an equi-join;
* candidates are packed by length into blocks of bounded size, and an input meets only the lengths that can reach its
  threshold (similarity is at most shorter / longer);
* an input meets a *block*, not a candidate: the scan of the block is one expression that returns the block's best few,
  so pairs are never rows. Meetings are an equi-join on (length class, block): the blocks are broadcast while their measured
  size is small, and beyond that shuffled, with copies under a salt where there are fewer blocks than tasks.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.sliced import hot_keys, top_per_group
from millrace.session import work_path

BLOCK_ROWS = 512
LENGTH_CLASSES = 512
BROADCAST_BYTES = 64 << 20
LEVELS = (0.9, 0.75)
LEAST_SIMILAR = 0.75
MOST_EDITS = 8
MOST_VARIANTS = 1024  # remainders of one text that are looked up
FEW = 1024  # so few candidates are scanned sooner than indexed


def _check(threshold: float) -> None:
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")


@dataclass(frozen=True)
class _Blocks:
    """Candidates packed by class of length: class c holds lengths from c * width on, in ``counts[c]`` blocks."""

    texts: DataFrame  # value, position
    rows: DataFrame | None  # cls, block, items
    width: int
    counts: list[int]
    total: int
    total_bytes: int
    sizes: list[tuple[int, int, int]]  # size in lower case, size, candidates

    def array(self) -> Column:
        return F.from_json(F.lit(json.dumps(self.counts)), "array<int>")


def _pack(candidates: DataFrame, value: str, position: str, keep: int) -> _Blocks:
    """Blocks of about BLOCK_ROWS candidates of like length.

    Of equal candidates only the first ``keep`` can ever be returned, so further copies are dropped first. The number of
    blocks follows from the candidates per length, which is all that comes to the driver.
    """
    named = candidates.select(F.col(value).alias("value"), F.col(position).alias("position")).filter(F.col("value").isNotNull())
    first = top_per_group(named, ["value"], [F.col("position")], keep, "_copy").drop("_copy")
    octets = F.sum(F.octet_length("value") + F.octet_length(F.lower("value"))).alias("octets")
    found = first.groupBy(F.length("value").alias("len"), F.length(F.lower("value")).alias("low")).agg(F.count("*").alias("n"), octets).collect()
    sizes = [(r["len"], r["n"]) for r in found]
    width = max((length for length, _ in sizes), default=0) // LENGTH_CLASSES + 1
    held = [0] * (max((length // width for length, _ in sizes), default=0) + 1)
    for length, n in sizes:
        held[length // width] += n
    counts = [-(-n // BLOCK_ROWS) for n in held]
    total = sum(r["octets"] + 64 * r["n"] for r in found)
    packed = _Blocks(first, None, width, counts, sum(held), total, [(r["low"], r["len"], r["n"]) for r in found])
    cls = F.floor(F.length("value") / width).cast("int")
    placed = first.withColumn("cls", cls).withColumn(
        "block", F.pmod(F.xxhash64("value", "position"), F.greatest(F.get(packed.array(), F.col("cls")), F.lit(1))).cast("int")
    )
    item = F.struct(F.lower("value").alias("low"), F.length("value").alias("len"), "position", "value")
    return replace(packed, rows=placed.groupBy("cls", "block").agg(F.collect_list(item).alias("items")))


def _meetings(texts: DataFrame, blocks: _Blocks, threshold: float) -> DataFrame:
    """Every input text with every block that holds lengths that can reach the threshold."""
    sized = texts.withColumn("size", F.length("text"))
    last = len(blocks.counts) - 1
    least = F.floor(F.ceil(F.col("size") * threshold - 1e-9) / blocks.width).cast("int")
    most = F.least(F.floor(F.floor(F.col("size") / threshold + 1e-9) / blocks.width), F.lit(last)).cast("int")
    near = sized.filter(least <= last).withColumn("cls", F.explode(F.sequence(least, F.greatest(least, most))))
    held = near.withColumn("_held", F.get(blocks.array(), F.col("cls"))).filter("_held > 0")
    asking = held.select("text", "size", "cls", F.explode(F.sequence(F.lit(0), F.col("_held") - 1)).alias("block"))
    # A few bytes of text cost a whole block of comparisons, so the work is spread by cores and not, as adaptive
    # execution would, by bytes. Small dictionaries go whole to every task; the sizes are measured, not assumed.
    spark = texts.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if blocks.total_bytes <= BROADCAST_BYTES:
        return asking.repartition(parts).join(F.broadcast(blocks.rows), ["cls", "block"])
    copies = -(-parts // max(1, sum(blocks.counts)))
    salted = asking.withColumn("_salt", F.pmod(F.xxhash64("text"), F.lit(copies)).cast("int"))
    copied = blocks.rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return salted.repartition(parts, "cls", "block", "_salt").join(copied, ["cls", "block", "_salt"]).drop("_salt")


def _edits(size: Column, threshold: float) -> Column:
    """Edits that texts of which the longer has ``size`` characters may be apart."""
    return F.floor((1 - threshold) * size + 1e-9).cast("int")


def _shortest(size: Column, threshold: float) -> Column:
    return F.ceil(size * threshold - 1e-9).cast("int")


def _longest(size: Column, threshold: float) -> Column:
    return F.floor(size / threshold + 1e-9).cast("int")


def _cut(size: Column, edits: Column, part: Column) -> tuple[Column, Column]:
    """Place (from 0) and size of one of ``edits + 1`` segments of a text; the last ones are longer by one."""
    parts = edits + 1
    short = F.floor(size / parts).cast("int")
    longer = F.pmod(size, parts)
    place = part * short + F.greatest(F.lit(0), part - (parts - longer))
    return place, short + (part >= parts - longer).cast("int")


def _few_edits(texts: DataFrame, threshold: float) -> Column:
    return _edits(_longest(F.length("text"), threshold), threshold) <= MOST_EDITS


def _index(candidates: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The candidates under each of their segments (seg, block, items), and the segments of several blocks with their number.

    The edits a pair may be apart follow from the longer of the two, so a candidate is cut once for each number that some
    input can bring.
    """
    size, edits, part = F.col("size"), F.col("edits"), F.col("part")
    low = candidates.select("value", "position", F.lower("value").alias("low")).withColumn("size", F.length("low"))
    fewest, most = _edits(size, threshold), F.least(_edits(_longest(size, threshold), threshold), F.lit(MOST_EDITS))
    cut = low.filter(fewest <= MOST_EDITS).withColumn("edits", F.explode(F.sequence(fewest, most)))
    cut = cut.withColumn("part", F.explode(F.sequence(F.lit(0), edits)))
    place, long = _cut(size, edits, part)
    item = F.struct("low", F.length("value").alias("len"), "position", "value")
    held = cut.select(F.xxhash64(size, edits, part, F.substring("low", place + 1, long)).alias("seg"), item.alias("item"))
    many = hot_keys(held, ["seg"], BLOCK_ROWS).withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    placed = held.join(many, "seg", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("item.value", "item.position"), F.col("blocks")).cast("int")
    return placed.groupBy("seg", block.alias("block")).agg(F.collect_list("item").alias("items")), many


def _lookups(texts: DataFrame, blocks: _Blocks, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Every input text with the blocks of candidates that share a segment with it, at a place few edits can move it to.

    Texts whose segments lead to over half as many candidates as there are cannot gain by it; they come second, with no block.
    """
    size, other, edits, part = F.col("size"), F.col("other"), F.col("edits"), F.col("part")
    index, many = _index(blocks.texts, threshold)
    asked = texts.withColumn("size", F.length("text"))
    asked = asked.withColumn("other", F.explode(F.sequence(_shortest(size, threshold), _longest(size, threshold))))
    asked = asked.filter(other.isin(sorted({low for low, _, _ in blocks.sizes})))
    asked = asked.withColumn("edits", _edits(F.greatest(size, other), threshold))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), edits)))
    place, long = _cut(other, edits, part)
    # moved by x, it takes |x| edits before the segment and |x - (size - other)| behind it
    first = F.greatest(F.lit(0), place - F.floor((edits - size + other) / 2).cast("int"))
    last = F.least(size - long, place + F.floor((edits + size - other) / 2).cast("int"))
    asked = asked.withColumn("long", long).withColumn("first", first).withColumn("last", last).filter("first <= last")
    asked = asked.withColumn("at", F.explode(F.sequence("first", "last")))
    seg = F.xxhash64(other, edits, part, F.substring("text", F.col("at") + 1, F.col("long"))).alias("seg")
    asked = asked.select("text", "size", seg).distinct().join(many, "seg", "left")
    wide = asked.filter("n IS NOT NULL").groupBy("text").agg(F.sum("n").alias("n")).filter(F.col("n") > blocks.total / 2).select("text")
    asked = asked.join(wide, "text", "left_anti")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    return asked.select("text", "size", "seg", "block").join(index, ["seg", "block"]), wide


def _apart(size: int, long: int, step: int, threshold: float) -> int:
    """Edits between a text and a candidate of ``long`` characters up to which step ``step`` finds the pair."""
    longer = max(size, long)
    return min(step * longer // (size + step), int((1 - threshold) * longer + 1e-9))


def _pairings(size: int, blocks: _Blocks, step: int, threshold: float) -> dict[tuple[int, int], int]:
    """Sizes (in lower case, as given) of the candidates that a text of this size can meet at a step, with the characters
    they have in common at least."""
    found = {}
    for low, long, _ in blocks.sizes:
        edits = _apart(size, long, step, threshold)
        if abs(size - low) <= edits:
            found[low, long] = max(size, low, edits) - edits
    return found


def _remainders(texts: DataFrame, text: str, common: dict[int, set[int]]) -> DataFrame:
    """``texts`` with ``seg``, the hash of each different remainder of the lengths that ``common`` gives for the size of a text."""
    def shorter(found: Column) -> Column:
        def without(t: Column) -> Column:
            return F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substr(t, i + 1)))

        return F.array_distinct(F.flatten(F.transform(found, without)))

    wanted = F.from_json(F.lit(json.dumps({str(n): sorted(c) for n, c in common.items()})), "map<string,array<int>>")
    sized = texts.withColumn("_common", F.explode(wanted[F.length(text).cast("string")]))
    less, whole = F.length(text) - F.col("_common"), F.array(text)
    left = F.when(less == 0, whole).otherwise(F.aggregate(F.sequence(F.lit(1), less), whole, lambda found, _: shorter(found)))
    return sized.withColumn("_left", F.explode(left)).withColumn("seg", F.xxhash64("_left")).drop("_common", "_left")


def _by_remainders(texts: DataFrame, blocks: _Blocks, threshold: float, strict: bool, limit: int) -> tuple[list[DataFrame], DataFrame]:
    """Answers of the texts that remainders settle, and the other texts.

    A text is settled at the first step that finds it ``limit`` candidates, or that reaches the threshold. Texts and their
    remainders are joined as 64-bit hashes; who meets is compared in full.
    """
    spark, path = texts.sparkSession, work_path(texts.sparkSession, "wide")
    texts.select("text").write.parquet(path)
    left, settled, before = spark.read.parquet(path), [], {}
    open_ = {r["size"]: r["n"] for r in left.groupBy(F.length("text").alias("size")).agg(F.count("*").alias("n")).collect()}
    low = F.lower("value").alias("low")
    known = blocks.texts.select(F.xxhash64("value", "position").alias("id"), "value", "position", low)
    step, last = 0, {size: _pairings(size, blocks, 1 << 40, threshold) for size in open_}
    while open_:
        step += 1
        mine, theirs, asks = {}, {}, {}
        for size in open_:
            met = asks[size] = _pairings(size, blocks, step, threshold)
            if all(comb(n, common) <= MOST_VARIANTS for (other, _), common in met.items() for n in (size, other)):
                if met != before.get(size, {}):  # else it finds no more than the step before
                    mine[size] = set(met.values())
                    for (other, _), common in met.items():
                        theirs.setdefault(other, set()).add(common)
            else:
                del asks[size]
        before = asks
        made = sum(n * comb(at, common) for at, _, n in blocks.sizes for common in theirs.get(at, ()))
        if mine and made >= blocks.total * sum(open_[size] for size in mine):  # a scan compares fewer
            before = {size: met for size, met in asks.items() if size not in mine}
            mine = {}
        # a size that has met all that reach the threshold has nothing more to look for
        done = [size for size, met in before.items() if met == last[size]]
        if mine:
            asked = left.filter(F.length("text").isin(list(mine)))
            index = _remainders(known.filter(F.length("low").isin(list(theirs))), "low", theirs).select("seg", "id")
            hits = _remainders(asked, "text", mine).join(index, "seg").select("text", "id").distinct()
            item = F.struct("low", F.length("value").alias("len"), "position", "value")
            met = hits.join(known, "id").select("text", F.length("text").alias("size"), F.array(item).alias("items"))
            near = _best(met, threshold, strict, limit, False, step)
            path = work_path(spark, "near")
            near = near.withColumn("found", F.max("rank").over(Window.partitionBy("text")))
            near.filter((F.col("found") == limit) | F.length("text").isin(done)).drop("found").write.parquet(path)
            settled.append(spark.read.parquet(path))
            left = left.join(settled[-1], "text", "left_anti")
        left = left.filter(~F.length("text").isin(done)) if done else left
        open_ = {r["size"]: r["n"] for r in left.groupBy(F.length("text").alias("size")).agg(F.count("*").alias("n")).collect() if r["size"] in before}
    return settled, left


def _best(met: DataFrame, threshold: float, strict: bool, limit: int, repeated: bool, step: int | None = None) -> DataFrame:
    """The ``limit`` best candidates of each text: text, score, back, value, rank.

    ``repeated``: a candidate was met by segments, so by several perhaps, and is then found several times. With ``step`` only
    candidates similar enough for that step of :func:`_by_remainders` count.
    """
    few = F.slice(F.sort_array(_ranked_items(threshold, strict), asc=False), 1, limit)
    rows = met.select("text", F.inline(few))
    rows = rows if step is None else rows.filter(F.col("score") * (F.length("text") + step) >= F.length("text") - 1e-9)
    rows = rows.distinct() if repeated else rows
    return top_per_group(rows, ["text"], [F.col("score").desc(), F.col("back").desc()], limit)


def _search(asked: DataFrame, blocks: _Blocks, threshold: float, strict: bool, limit: int) -> DataFrame:
    """The ``limit`` best candidates of each text at or (``strict``) above the threshold, by falling similarity.

    The answers of a level are written to the shared folder, as the next level and the result both start from them.
    """
    if blocks.total <= FEW:
        return _best(_meetings(asked, blocks, threshold), threshold, strict, limit, False)
    spark, left, settled = asked.sparkSession, asked, []
    for level in (x for x in LEVELS if x > threshold):
        met, _ = _lookups(left.filter(_few_edits(left, level)), blocks, level)
        near = _best(met, level, False, limit, True)
        path = work_path(spark, "near")
        near.withColumn("found", F.max("rank").over(Window.partitionBy("text"))).filter(F.col("found") == limit).drop("found").write.parquet(path)
        settled.append(spark.read.parquet(path))
        left = left.join(settled[-1], "text", "left_anti")
    if threshold >= LEAST_SIMILAR:
        short = _few_edits(left, threshold)
        met, wide = _lookups(left.filter(short), blocks, threshold)
        near, wide = _by_remainders(wide, blocks, threshold, strict, limit)
        settled += near
        scanned = _meetings(left.filter(~short).unionByName(wide), blocks, threshold)
        met = met.select("text", "size", "items").unionByName(scanned.select("text", "size", "items"))
    else:
        met = _meetings(left, blocks, threshold)
    rows = _best(met, threshold, strict, limit, threshold >= LEAST_SIMILAR)
    for part in settled:
        rows = rows.unionByName(part)
    return rows


def _ranked_items(threshold: float, strict: bool) -> Column:
    """The block's candidates that pass, as struct(score, back, value); ``back`` grows towards the first position.

    Distances are worked out in a step of their own, once each, and given up when past what the threshold allows.
    """
    def longer(i: Column) -> Column:
        return F.greatest(F.col("size"), i["len"])

    def measure(i: Column) -> Column:
        allowed = F.floor((1 - threshold) * longer(i) + 1e-9).cast("int")
        return F.struct(F.call_function("levenshtein", F.col("text"), i["low"], allowed).alias("d"), i.alias("i"))

    def rate(m: Column) -> Column:
        score = F.when(longer(m["i"]) == 0, F.lit(1.0)).otherwise(1 - m["d"] / longer(m["i"]))
        return F.struct(score.alias("score"), (-m["i"]["position"]).alias("back"), m["i"]["value"].alias("value"))

    scored = F.transform(F.filter(F.transform("items", measure), lambda m: m["d"] >= 0), rate)
    return F.filter(scored, lambda s: s["score"] > threshold if strict else s["score"] >= threshold)


def fuzzy_match_join(
    inputs: DataFrame, text: str, candidates: DataFrame, value: str, position: str, threshold: float = 0.4
) -> DataFrame:
    """J7. Every input row with its best candidate: ``match`` and ``score``, null when none scores above the threshold.

    Ties go to the candidate with the lowest position.
    """
    _check(threshold)
    asked = inputs.select(F.lower(text).alias("text")).filter(F.col("text").isNotNull()).distinct()
    exact = candidates.groupBy(F.lower(value).alias("text")).agg(F.min_by(value, position).alias("match"))
    settled = asked.join(exact, "text").select("text", "match", F.lit(1.0).alias("score"))
    blocks = _pack(candidates, value, position, 1)
    best = _search(asked.join(exact, "text", "left_anti"), blocks, threshold, True, 1)
    found = settled.unionByName(best.select("text", F.col("value").alias("match"), "score"))
    return inputs.join(found, F.lower(inputs[text]) == found["text"], "left").drop(found["text"])


def top_similar(
    inputs: DataFrame, text: str, candidates: DataFrame, value: str, position: str, threshold: float = 0.4, limit: int = 3
) -> DataFrame:
    """L10. Up to ``limit`` candidates per input row at or above the threshold: ``match``, ``position``, ``score``, ``rank``."""
    _check(threshold)
    asked = inputs.select(F.lower(text).alias("text")).filter(F.col("text").isNotNull()).distinct()
    blocks = _pack(candidates, value, position, limit)
    ranked = _search(asked, blocks, threshold, False, limit)
    found = ranked.select("text", F.col("value").alias("match"), (-F.col("back")).alias("position"), "score", "rank")
    return inputs.join(found, F.lower(inputs[text]) == found["text"]).drop(found["text"])


def did_you_mean(
    inputs: DataFrame, text: str, dim: DataFrame, key: str, name: str, aliases: str, threshold: float = 0.3, limit: int = 3
) -> DataFrame:
    """L11. Nearest rows of a dimension by name or alias, each match given as the row's own name."""
    named = dim.select(key, name, F.posexplode(F.concat(F.array(name), F.coalesce(aliases, F.array().cast("array<string>")))).alias("_at", "_alias"))
    # a number that grows with the key, and within it from the name to the last alias
    most = dim.agg(F.max(F.coalesce(F.size(aliases), F.lit(0))) + 1).head()[0] or 1
    placed = named.withColumn("_position", F.col(key).cast("decimal(20,0)") * F.lit(most).cast("decimal(10,0)") + F.col("_at"))
    hits = top_similar(inputs, text, placed, "_alias", "_position", threshold, limit)
    back = placed.select(F.col("_position").alias("position"), F.col(name).alias("suggestion"))
    return hits.join(back, "position").drop("position")
