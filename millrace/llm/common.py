"""What several operators of this folder share."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import work_path

#: Files a finished write no longer needs: its result is in the shared folder, so a later loss of an executor costs nothing.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows of an Arrow batch: bounds what a Python worker holds when texts are long.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: A code point outside ASCII that lower-casing changes.
_OTHER_UPPER = r"[^\x00-\x7F&&[\p{IsUppercase}\p{Lt}]]"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stage(df: DataFrame, name: str, by: str | None = None, at: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and what follows knows its size.

    With ``by``, the last column, there is a folder for each of its values, so a filter on it reads no other. ``at`` is a path
    of the caller's (:func:`work_path`), to :func:`discard` once nothing reads it any more.
    """
    spark = df.sparkSession
    path = at or work_path(spark, name)
    with setting(spark, SHUFFLE_CLEANUP, "true"), setting(spark, ARROW_ROWS, "1000"):
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete what :func:`stage` wrote to ``path``."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def named(column: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty)."""
    return docs.select(named(doc_id).cast("long").alias("doc_id"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text"))


def times(docs: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """The rows of ``docs``, all columns, whose ``key`` is in ``keys`` (``key, n, keep``; ``n`` rows of ``docs`` have the key,
    and ``keep`` copies of these are wanted in all), as often as that, with a column ``copy`` that counts from 1 per row.

    Texts move once, in the join. Only rows that share their key are numbered.
    """
    names = [fresh(docs, c) for c in ("at_", "key_", "n_", "keep_", "place_")]
    at, k, n, keep, place = map(named, names)
    wanted = keys.where("keep > 0").toDF(*names[1:4])
    rows = docs.withColumn(names[0], key)
    rows = rows.join(wanted, at.eqNullSafe(k))
    if keys.where("n > 1 AND keep > 0").isEmpty():
        rows = rows.withColumn(names[4], F.lit(1))
    else:
        order = Window.partitionBy(names[0]).orderBy(F.lit(1))
        several = rows.where(n > 1).withColumn(names[4], F.row_number().over(order))
        rows = rows.where(n == 1).withColumn(names[4], F.lit(1)).union(several)
    each = (F.floor(keep / n) + (place <= keep % n).cast("int")).cast("int")
    copy = fresh(docs, "copy")
    return rows.where(each > 0).select(*map(named, docs.columns), F.explode(F.sequence(F.lit(1), each)).alias(copy))


def row_key(doc_id: Column, text: Column) -> Column:
    """What tells rows apart by content: rows with the same id and text are interchangeable."""
    return F.struct(doc_id.cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))).alias("text_hash"))


def semi(docs: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose ``key`` is in the only column of ``keys`` (``left_anti``: is not)."""
    other = keys.toDF(fresh(docs, "wanted"))
    return docs.join(other, named(key).eqNullSafe(other[other.columns[0]]), how)


def fold(c: Column) -> Column:
    """A-Z lower-cased, nothing else.

    ``lower`` does the same and is much faster wherever no other code point has a lower case.
    """
    slow = F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(c.rlike(_OTHER_UPPER), slow).otherwise(F.lower(c))
