"""Line de-duplication with levelled sorted runs of line hashes; DataFrame functions only.

Documents come in batches of falling id, so the first batch with a line holds the document that keeps it. A batch's lines,
counted per hash, are anti-joined with the hashes that the runs already know to be repeated often enough, and what remains is
added as a run of its own, sorted by hash. When a level has several runs they are merged into one run of the next level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fold, fresh, named, stage, texts

#: Shortest key, in code points, and fewest documents that make a line repeated.
LEAST_CHARS, LEAST_DOCS = 40, 5
#: Batches of documents, and runs of a level that are merged.
BATCHES, FAN = 4, 2

_BLANK = " \t\n\x0b\f\r"


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(docs: DataFrame, least_chars: int, batches: int) -> DataFrame:
    """``doc_id, text_hash, at, key, batch`` of every line long enough; ``batch`` 0 has the greatest ids."""
    cuts = [i / batches for i in range(batches - 1, 0, -1)]
    found = docs.agg(F.percentile_approx("doc_id", cuts)).first()[0] if cuts else None
    batch = sum((F.coalesce(F.col("doc_id") <= c, F.lit(True)).cast("int") for c in found or []), F.lit(0))
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), batch.cast("int").alias("batch"), F.posexplode(_split(F.col("text"))).alias("at", "line"))
    line = F.btrim("line", F.lit(_BLANK))
    lines = lines.select("doc_id", "text_hash", "at", "batch", line.alias("line")).where(F.char_length("line") >= least_chars)
    key = F.unhex(F.substring(F.sha2(fold(F.col("line")).cast("binary"), 256), 1, 32))  # 128 bits
    return stage(lines.select("doc_id", "text_hash", "at", key.alias("key"), "batch"), "lines", by="batch")


class Runs:
    """Sorted runs of ``key, n, last`` (documents counted, greatest id), in levels."""

    def __init__(self, least_docs: int, fan: int = FAN):
        self.least_docs, self.fan = least_docs, fan
        self.levels: list[list[DataFrame]] = [[]]

    @staticmethod
    def merged(runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for r in runs[1:]:
            out = out.union(r)
        return out.groupBy("key").agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    def settled(self) -> DataFrame | None:
        """Keys in enough documents, with the document that keeps them; later documents cannot change either."""
        runs = [r for level in self.levels for r in level]
        return self.merged(runs).where(F.col("n") >= self.least_docs) if runs else None

    def add(self, batch: DataFrame) -> None:
        """Add the lines of documents whose ids are below all before them."""
        mine = batch.select("key", "doc_id", "text_hash").distinct()  # a document counts once
        mine = mine.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
        known = self.settled()
        if known is not None:
            mine = mine.join(known.select("key"), "key", "left_anti")
        self._put(0, mine)

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(stage(run.sortWithinPartitions("key"), "run"))
        if len(self.levels[level]) == self.fan:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self.merged(full))


def _cleaned(docs: DataFrame, least_chars: int, least_docs: int, batches: int, fan: int) -> DataFrame:
    """Per row of ``doc_id, text, ...`` also ``n_lines, n_dropped, kept``."""
    rows = docs.select("doc_id", "text")
    lines = line_hashes(rows, least_chars, batches)
    runs = Runs(least_docs, fan)
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b))
    settled = stage(runs.settled().select(F.col("key").alias("repeated"), "last"), "settled")
    hit = lines.join(settled, lines["key"] == settled["repeated"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    drops = hit.groupBy(F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_")).agg(F.sort_array(F.collect_set("at")).alias("drops"))
    drops = stage(drops, "drops")
    same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.xxhash64("text") == F.col("hash_"))
    out = docs.join(drops, same, "left").withColumn("lines", _split(F.col("text")))
    none = F.array().cast("array<int>")
    # the lines between one dropped line and the next
    before = F.concat(F.array(F.lit(-1)), F.coalesce("drops", none))
    after = F.concat(F.coalesce("drops", none), F.array(F.size("lines")))
    parts = F.zip_with(before, after, lambda a, b: F.slice(F.col("lines"), a + 2, b - a - 1))
    kept = F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(parts), "\n"))
    n_dropped = F.coalesce(F.size("drops"), F.lit(0))
    out = out.withColumns({"n_lines": F.size("lines").cast("long"), "n_dropped": F.when(F.col("drops").isNull(), 0).otherwise(n_dropped).cast("long"), "kept": kept})
    return out.drop("id_", "hash_", "drops", "lines")


def line_dedup_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every row.

    A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. Lines whose key has at least
    ``least_chars`` code points and is in at least ``least_docs`` documents go, but for those of the greatest ``doc_id`` with
    it (null: below all; all rows that repeat that id keep theirs). Null or empty text is one empty line. Rows that repeat both id and text count
    as one document. Keys are told apart by 128 bits of SHA-256. No rows: no rows.
    """
    out = _cleaned(texts(docs, doc_id, text), least_chars, least_docs, batches, fan)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """The rows of ``docs``, all columns, with the repeated lines taken out of ``text``."""
    rest = fresh(docs, "rest")
    rows = docs.select(named(doc_id).cast("long").alias("doc_id"), F.coalesce(named(text), F.lit("")).alias("text"), F.struct(*map(named, docs.columns)).alias(rest))
    out = _cleaned(rows, least_chars, least_docs, batches, fan)
    kept = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col(rest)[text])
    return out.select(*[kept.alias(c) if c == text else F.col(rest)[c].alias(c) for c in docs.columns])
