"""Tables with keys on plain Parquet, and high-water marks.

Each load of a table is a folder of its own, bucketed by the key, so Spark joins the next load's rows to it without moving the
table; within a bucket rows are sorted by the key, which each task's own sort then meets nearly done. Spark's own ``_SUCCESS`` file says that a folder is whole; the newest whole folder is the
table. Nothing else is kept about a table, and a load that died leaves a folder that nobody reads.

Keys are compared null-safely. One writer of a table at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16
KEY = "_key"


# ---- folders -------------------------------------------------------------------------------------------------------


def _files(spark: SparkSession, path: str):
    """Hadoop's view of a path: its file system and the path itself."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _files(spark, path)
    return fs.exists(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder."""
    fs, at = _files(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(at) if f.isDirectory()] if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _files(spark, path)
    fs.delete(at, True)


def whole_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders ``number-...`` below a path that were written to the end, oldest first."""
    found = sorted((f for f in folders(spark, path) if f.split("-")[0].isdigit()), key=lambda f: int(f.split("-")[0]))
    return [f for f in found if exists(spark, f"{path}/{f}/_SUCCESS")]


def _number(folder: str | None) -> int:
    return int(folder.split("-")[0]) if folder else 0


# ---- keys ----------------------------------------------------------------------------------------------------------


def key_text(keys: Sequence[str]) -> Column:
    """One text that is never null and tells any two keys apart, null and empty values too."""
    each = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.concat(*each)


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys, null equal to null; the keys appear once. ``right`` must hold no other column of ``left``."""
    marked = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(marked[f"_right_{k}"])
    out = left.join(marked, same, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_right_{k}" for k in keys])


def wider(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of both. A column that changed its type is an error before anything is written: a table takes another
    type only by being replaced."""
    for f in new:
        if f.name in old.names and old[f.name].dataType != f.dataType:
            raise TypeError(f"column {f.name} is {old[f.name].dataType.simpleString()} in the table and {f.dataType.simpleString()} in the load; replace the table to change it")
    return T.StructType([*old, *[f for f in new if f.name not in old.names]])


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``; those it lacks are null."""
    return df.select(*[F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


class KeyedTable:
    """The table below ``path``. Folder ``n-b`` is the whole table after load n, in b buckets of ``keys``.

    ``keep`` is how many folders stay; readers that began with an older one must end before it goes. An existing table keeps
    its number of buckets.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int | None = None, keep: int = 2):
        self.spark, self.path, self.keys, self.keep = spark, path, list(keys), keep
        self._asked = buckets

    def loads(self) -> list[int]:
        """The numbers of the loads that can be read."""
        return [_number(f) for f in whole_folders(self.spark, self.path)]

    def _folder(self, load: int | None = None) -> str | None:
        found = whole_folders(self.spark, self.path)
        if load is None:
            return found[-1] if found else None
        named = [f for f in found if _number(f) == load]
        if not named:
            raise ValueError(f"there is no load {load} in {self.path}")
        return named[0]

    # ---- read -----------------------------------------------------------------------------------------------------

    def read(self, load: int | None = None) -> DataFrame | None:
        """The table after a load, by default the last; None before the first."""
        folder = self._folder(load)
        return self._open(folder).drop(KEY) if folder else None

    def rows_of(self, keys: DataFrame) -> DataFrame | None:
        """The rows of the given keys; only the keys are shuffled."""
        folder = self._folder()
        if folder is None:
            return None
        wanted = self._keyed(keys.select(*self.keys).distinct()).select(KEY)
        return self._open(folder).join(wanted, KEY, "left_semi").drop(KEY)

    def beside(self, name: str) -> KeyedTable:
        """A table of the same keys that belongs to this one."""
        return KeyedTable(self.spark, f"{self.path}/_beside/{name}", self.keys, self._buckets(), self.keep)

    def _open(self, folder: str) -> DataFrame:
        """The rows of a folder with KEY, known to Spark as bucketed and sorted."""
        path, buckets = f"{self.path}/{folder}", int(folder.split("-")[1])
        schema = self._schema(folder)
        name = f"millrace_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}') CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS")
        found = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # only the name: the files are not Spark's own
        missing = [k for k in self.keys if k not in schema.names]
        if missing:
            raise ValueError(f"the table {self.path} has no columns {missing}")
        return found

    def _schema(self, folder: str) -> T.StructType:
        fs, at = _files(self.spark, f"{self.path}/_schema/{folder}")
        stream = fs.open(at)
        try:
            return T.StructType.fromJson(json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _put_schema(self, folder: str, schema: T.StructType) -> None:
        """Columns and types of a load, in a small file beside it: an empty load has no Parquet file that could tell them."""
        fs, at = _files(self.spark, f"{self.path}/_schema/{folder}")
        out = fs.create(at, True)
        out.write(schema.json().encode())
        out.close()

    # ---- write ----------------------------------------------------------------------------------------------------

    def _buckets(self) -> int:
        folder = self._folder()
        return int(folder.split("-")[1]) if folder else self._asked or BUCKETS

    def _write(self, df: DataFrame) -> int:
        """Write rows with KEY as the next load; the folder counts once it is whole. Returns the number of the load."""
        buckets, number = self._buckets(), _number(self._folder()) + 1
        folder, name = f"{number:09d}-{buckets}", f"millrace_{uuid.uuid4().hex}"
        path = f"{self.path}/{folder}"
        self._put_schema(folder, df.schema)
        # overwrites what a load that died has left
        df.write.format("parquet").mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        if not exists(self.spark, f"{path}/_SUCCESS"):
            raise OSError(f"{path} is not whole; loads need the committer's _SUCCESS files")
        for old in whole_folders(self.spark, self.path)[: -self.keep]:
            remove(self.spark, f"{self.path}/{old}")
            remove(self.spark, f"{self.path}/_schema/{old}")
        return number

    def _keyed(self, df: DataFrame) -> DataFrame:
        """``df`` with KEY, dealt to one task per bucket."""
        return df.withColumn(KEY, key_text(self.keys)).repartition(self._buckets(), KEY)

    def replace(self, df: DataFrame) -> int:
        """W2, W8. New contents, and new columns or types if they differ."""
        return self._write(self._keyed(df))

    def merge(self, source: DataFrame, order: str | None = None) -> int:
        """W3. Rows of the source replace those of their keys; with ``order`` only if they are greater there.

        The source must hold each key once. The old load is joined bucket by bucket: only the source is shuffled.
        """
        folder = self._folder()
        if folder is None:
            return self.replace(source)
        old = self._open(folder)
        schema = wider(T.StructType([f for f in old.schema if f.name != KEY]), source.schema)
        row = lambda df, name: fitted(df, T.StructType([*schema, T.StructField(KEY, T.StringType())])).select(F.col(KEY), F.struct(*[F.col(f"`{c}`") for c in schema.names]).alias(name))
        new = row(self._keyed(source), "_new").withColumnRenamed(KEY, "_new_key")
        met = row(old, "_old").join(new, F.col(KEY) == F.col("_new_key"), "full")
        wins = F.col("_new_key").isNotNull()
        if order:
            newer = F.col("_new")[order] > F.col("_old")[order]
            wins = wins & (F.col(KEY).isNull() | F.coalesce(newer, F.col("_old")[order].isNull() & F.col("_new")[order].isNotNull()))
        chosen = met.select(F.when(wins, F.col("_new")).otherwise(F.col("_old")).alias("_row"), F.coalesce(KEY, "_new_key").alias(KEY))
        return self._write(chosen.select("_row.*", KEY))

    def replace_rows(self, keys: DataFrame, rows: DataFrame | None = None) -> int:
        """Remove the rows of the given keys and add ``rows``; a key may have any number of rows."""
        folder = self._folder()
        if folder is None:
            return 0 if rows is None else self.replace(rows)
        old = self._open(folder)
        gone = self._keyed(keys.select(*self.keys).distinct()).select(KEY)
        left = old.join(gone, KEY, "left_anti")
        if rows is None:
            return self._write(left.select(*old.columns))
        schema = wider(T.StructType([f for f in old.schema if f.name != KEY]), rows.schema)
        both = T.StructType([*schema, T.StructField(KEY, T.StringType())])
        return self._write(fitted(left, both).union(fitted(self._keyed(rows), both)))


class LoadTable:
    """W1. A table that loads are added to: a folder for each load id, so a load that is run again replaces its own rows."""

    LOAD = "_load"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, df: DataFrame, load_id: str) -> None:
        """Columns the table lacks are added to it; a column of another type is refused."""
        before = self.read()
        if before is not None:
            wider(before.schema, df.schema)
        df.write.mode("overwrite").parquet(f"{self.path}/{self.LOAD}={load_id}")

    def read(self) -> DataFrame | None:
        """All loads; columns that a load lacked are null."""
        if not any(f.startswith(f"{self.LOAD}=") for f in folders(self.spark, self.path)):
            return None
        return self.spark.read.option("mergeSchema", "true").parquet(self.path).drop(self.LOAD)


class MarkTable:
    """High-water marks: the newest whole folder of each artifact holds its mark. Loads of different artifacts may run side
    by side."""

    SCHEMA = "artifact string, mark string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def get(self, artifact: str) -> str | None:
        found = whole_folders(self.spark, f"{self.path}/{artifact}")
        return self.spark.read.schema(self.SCHEMA).json(f"{self.path}/{artifact}/{found[-1]}").head().mark if found else None

    def put(self, artifact: str, mark: str) -> None:
        found = whole_folders(self.spark, f"{self.path}/{artifact}")
        row = self.spark.createDataFrame([(artifact, mark)], self.SCHEMA).coalesce(1)
        row.write.mode("overwrite").json(f"{self.path}/{artifact}/{_number(found[-1] if found else None) + 1:09d}-mark")
        for old in found:
            remove(self.spark, f"{self.path}/{artifact}/{old}")

    def read(self) -> DataFrame:
        """``artifact, mark`` of every artifact."""
        marks = [(a, self.get(a)) for a in folders(self.spark, self.path)]
        return self.spark.createDataFrame([m for m in marks if m[1] is not None], self.SCHEMA)
