"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / size of the source`` times on average. The whole part is certain; the
rest is rounded in pairs: mass (words) moves between two documents until one of them is taken or not taken at all, upwards or
downwards with the odds that keep each document's expectation, and the pair's mass stays the same. What is left of a block is
one document; those meet again in blocks of residuals, level by level, until one is left of each source and is rounded alone.
So each source's words miss their target by less than one document.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import named, row_key, stage, times

#: Weights of the sources in order of their names, repeating; share of all words that the mix has; most copies of a document.
WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2
#: Documents of a block, and residuals that meet in one task of the reduction tree.
BLOCK, FAN_IN = 2_000, 64

_WORD = r"[^\x20\x09-\x0D]+"
_OPEN = "source string, blocks long, block long, row long, doc_id long, place long, size long, copies long, mass double, open boolean"


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, n, source_size, target`` (``n`` documents) from ``source, size``.

    Sources in code-point order, null last, get the weights in turn. They divide ``share`` of all words by weight; none gets
    more than ``most`` times its size, and what that leaves over is divided again among the others, until none is above. The
    driver sees only sums over sources.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    of = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).select("source", "n", "source_size", of.cast("double").alias("weight"))
    s = stage(s.withColumn("cap", F.col("source_size") * float(most)), "sources")
    budget = share * (s.agg(F.sum("source_size")).first()[0] or 0)
    capped = F.lit(False)
    while True:  # each round caps at least one more source
        left = s.agg(
            F.sum(F.when(capped, F.col("cap")).otherwise(0.0)), F.sum(F.when(~capped, F.col("weight")).otherwise(0.0)), F.sum(F.when(capped, 1).otherwise(0))
        ).first()
        if not left[1]:
            rate = 0.0
            break
        rate = (budget - left[0]) / left[1]
        above = capped | (F.col("weight") * F.lit(rate) > F.col("cap"))
        if s.where(above).count() == left[2]:
            break
        # a source that is above at some rate stays above, as rates only grow
        capped = F.col("weight") * F.lit(rate) > F.col("cap")
    return s.select("source", "n", "source_size", F.when(capped, F.col("cap")).otherwise(F.col("weight") * F.lit(rate)).alias("target"))


def _draw(seed: int, *key: object) -> float:
    """A number from [0, 1) that depends on its key only, so that reruns agree."""
    digest = hashlib.blake2b(repr((seed, *key)).encode(), digest_size=8).digest()
    return struct.unpack("<Q", digest)[0] / 2.0**64


def _pivot(pdf: pd.DataFrame, seed: int, level: int) -> pd.DataFrame:
    """The rows of a block, all but at most one of them settled; of a source's only block, all."""
    pdf = pdf.sort_values(["place", "doc_id", "size"], kind="stable").reset_index(drop=True)
    size, mass, place = pdf["size"].tolist(), pdf["mass"].tolist(), pdf["place"].tolist()
    still = [False] * len(pdf)
    up = [0] * len(pdf)
    held = None  # the document with open mass

    def settle(i: int) -> bool:
        if mass[i] <= 1e-9 * size[i]:
            return True
        if mass[i] >= size[i] * (1 - 1e-9):
            up[i] = 1
            return True
        return False

    for i in range(len(pdf)):
        if settle(i):
            continue
        if held is None:
            held = i
            continue
        j, down = held, 0.0
        raise_j, lower_j = min(size[j] - mass[j], mass[i]), min(mass[j], size[i] - mass[i])
        if _draw(seed, level, place[i], i, place[j], j) * (raise_j + lower_j) < lower_j:
            mass[j], mass[i] = mass[j] + raise_j, mass[i] - raise_j
        else:
            mass[j], mass[i] = mass[j] - lower_j, mass[i] + lower_j
        open_ = [k for k in (j, i) if not settle(k)]
        held = open_[0] if open_ else None
    if held is not None:
        if pdf["blocks"].iat[0] == 1:
            up[held] = int(_draw(seed, "last", place[held]) * size[held] < mass[held])
        else:
            still[held] = True
    return pdf.assign(copies=pdf["copies"] + up, mass=mass, open=still)


def _rounded(rows: DataFrame, seed: int, fan_in: int) -> DataFrame:
    """``row, copies`` of every row of ``source, row, doc_id, place, size, copies, mass, blocks``.

    ``blocks`` is the number of blocks of the row's source; a block is a part of the places, whatever files or tasks they
    come from.
    """
    todo = rows.withColumn("block", F.pmod("place", "blocks"))
    todo = todo.select("source", "blocks", "block", "row", "doc_id", "place", "size", "copies", "mass", F.lit(False).alias("open"))
    level, done = 0, []

    def at(level: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
        return lambda pdf: _pivot(pdf, seed, level)

    while True:
        out = stage(todo.groupBy("source", "block").applyInPandas(at(level), _OPEN), "rounded")
        done.append(out.where("NOT open").select("row", "copies"))
        todo = out.where("open").withColumns({"block": F.floor(F.col("block") / fan_in), "blocks": F.ceil(F.col("blocks") / fan_in)})
        if todo.isEmpty():
            return reduce(DataFrame.union, done)
        level += 1


def _decided(rows: DataFrame, weights: Sequence[float], share: float, most: int, seed: int, block: int, fan_in: int) -> DataFrame:
    place = F.xxhash64("doc_id", "text").alias("place")  # where a document stands among the others of its source
    size = F.regexp_count("text", F.lit(_WORD)).cast("long").alias("size")
    sizes = stage(rows.select("row", "doc_id", F.xxhash64("text").alias("text_hash"), "source", place, size), "sizes")
    found = stage(targets(sizes, weights, share, most), "targets")
    n_blocks = F.ceil(F.col("n") / block).alias("blocks")
    t = found.select(F.col("source").alias("of"), "source_size", "target", n_blocks)
    # one row per source, so the hot source's rows are what adaptive execution splits
    all_ = sizes.join(t, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    all_ = all_.withColumn("copies", F.floor(rate)).withColumn("mass", (rate - F.floor(rate)) * F.col("size"))
    all_ = stage(all_, "shares")
    copies = _rounded(all_.where("mass > 0"), seed, fan_in).toDF("at", "rounded")
    out = all_.join(copies, all_["row"] == copies["at"], "left").withColumn("copies", F.coalesce("rounded", "copies"))
    return out.select("row", "doc_id", "text_hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _rows(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    body = F.coalesce(named(text).cast("string"), F.lit(""))
    rows = docs.select(named(doc_id).cast("long").alias("doc_id"), body.alias("text"), named(source).cast("string").alias("source"))
    return rows.withColumn("row", F.monotonically_increasing_id())


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 0,
    block: int = BLOCK,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` of every row.

    ``size`` counts the words (anything but ASCII white space) of the text, null: 0; ``copies`` is how often the mix takes the
    document, at most ``most``, and ``taken`` the words that makes. Documents without words are taken as often as the whole
    part of their source's rate says, which adds no words. A null source is a source. Draws depend on ids, texts and
    ``seed`` only, so reruns agree; rows that repeat an id and text are interchangeable. No rows: no rows.
    """
    found = _decided(_rows(docs, doc_id, text, source), weights, share, most, seed, block, fan_in)
    return found.drop("row", "text_hash")


def take_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how: object) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it, with a column ``copy`` that counts from 1."""
    how = {"weights": WEIGHTS, "share": SHARE, "most": MOST, "seed": 0, "block": BLOCK, "fan_in": FAN_IN, **how}
    found = _decided(_rows(docs, doc_id, text, source), **how)
    keys = found.groupBy(F.struct("doc_id", "text_hash").alias("key")).agg(F.count("*").alias("n"), F.sum("copies").alias("keep"))
    return times(docs, stage(keys, "keep"), row_key(named(doc_id), named(text)))
