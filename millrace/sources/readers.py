"""Sources (S1-S12): each returns a DataFrame that Catalyst can still prune and push filters into."""

from __future__ import annotations

import csv
import warnings
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.shape import union_sources

# Defaults of a file source.
DEFAULT_DELIMITER = ","
DEFAULT_HEADER = True


def column_list(columns: str | Sequence[str] | None) -> list[str] | None:
    """``*`` or nothing is all columns (None), text is split on commas, a list is kept."""
    if columns is None or columns == "*":
        return None
    return [c.strip() for c in columns.split(",")] if isinstance(columns, str) else list(columns)


def scan_table(df: DataFrame, columns: str | Sequence[str] | None = None) -> DataFrame:
    """S1. A table with a column list; the scan reads only those columns."""
    wanted = column_list(columns)
    return df if wanted is None else df.select(*wanted)


def scan_query(spark: SparkSession, text: str, **args) -> DataFrame:
    """S2. A source given by SQL, with named parameters such as ``:last_run``."""
    return spark.sql(text, args=args or None)


def header_line(contains_header: bool | None = None, line: int | None = None) -> tuple[bool, int]:
    """Defaults of a delimited file: a header on line 1; without a header, line 0."""
    header = DEFAULT_HEADER if contains_header is None else contains_header
    return header, (1 if header else 0) if line is None else line


def _without_preamble(lines: int, head: str | None = None):
    """Drop the first ``lines`` lines of every file; later blocks of a split file have no preamble. With ``head``, a file
    whose last dropped line is another one fails the read: its columns would come out under wrong names.

    A task reads its files one after the other, so a batch is a few runs of rows of one file each.
    """

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            files, first = batch.column(1).to_numpy(), batch.column(2).to_numpy() == 0
            cuts = np.flatnonzero(np.diff(files) | np.diff(first)) + 1
            keep = np.ones(len(files), dtype=bool)
            for run in np.split(np.arange(len(files)), cuts) if first.any() else []:
                if len(run) and first[run[0]]:
                    at = seen.get(files[run[0]], 0)
                    keep[run[: max(0, lines - at)]] = False
                    if head is not None and at < lines <= at + len(run):
                        found = batch.column(0)[int(run[lines - 1 - at])].as_py()
                        if found.strip() != head.strip():
                            raise ValueError(f"a file has the header {found!r}, another one {head!r}")
                    seen[files[run[0]]] = at + len(run)
            yield batch.filter(pa.array(keep))

    return drop


def _records(begun: set[tuple[int, int]], crossing: bool):
    """Lines of blocks (``value, file, block``) to records (``value, file, block, part``), by the parity of quotes so far.

    ``begun`` holds the blocks whose first line is inside quotes that an earlier block opened. Part 0 is a whole record; a
    block may also have what ends a record of an earlier block (2), what begins one that it does not end (1), and a block
    that is the middle of a record is all of it (2 as well). Parts other than 0 are given only with ``crossing``, part 0 only without.

    The whole records of a batch are joined at once, as lists of lines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["value", "file", "block", "part"]
        at, odd, lead, held = None, 0, False, []

        def piece(part: int) -> Iterator[pa.RecordBatch]:
            text = "\n".join(held)
            held.clear()
            if crossing == (part > 0):
                yield given(pa.array([text], pa.string()), part)

        def given(values: pa.Array, part: int) -> pa.RecordBatch:
            n = len(values)
            return pa.RecordBatch.from_arrays([values, pa.array(np.full(n, at[0])), pa.array(np.full(n, at[1])), pa.array(np.full(n, part, np.int32))], names)

        for batch in batches:
            files, blocks = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(files)]):
                if start == end:
                    continue
                if at != (files[start], blocks[start]):
                    if held:
                        yield from piece(2 if lead else 1)
                    at = (int(files[start]), int(blocks[start]))
                    odd = int(at in begun)
                    lead = bool(odd)
                values = batch.column(0).slice(start, end - start)
                after = (odd + np.cumsum(pc.count_substring(values, '"').to_numpy())) % 2
                ends = np.flatnonzero(after == 0)
                first = 0
                if odd:  # the lines up to the first end go on with a record
                    first = int(ends[0]) + 1 if len(ends) else len(values)
                    held.extend(values.slice(0, first).to_pylist())
                    if len(ends):
                        yield from piece(2 if lead else 0)
                        lead, ends = False, ends[1:]
                last = int(ends[-1]) + 1 if len(ends) else first
                if last > first and not crossing:
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends + 1 - first]), pa.int32()), values.slice(first, last - first))
                    yield given(pc.binary_join(lists, "\n"), 0)
                held.extend(values.slice(last).to_pylist())
                odd = int(after[-1])
        if held:
            yield from piece(2 if lead else 1)

    return run


def _join_lines(lines: DataFrame) -> DataFrame:
    """The records of files given by line (``value, file, block``, in file order within a block).

    A record ends where the quotes up to the end of a line are even in number. What is carried into a block is a prefix sum of
    the quotes of the blocks before, one row per block; only blocks that begin inside quotes come to the driver. Records
    that cross blocks, at most two pieces per block, are joined apart. Files whose lines all have even quotes stay as they are.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "block").agg(F.sum(quotes % 2).alias("odd"))
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = counted.withColumn("open", F.coalesce(before, F.lit(0)) % 2 == 1).filter("open OR odd > 0").collect()
    if not blocks:
        return lines.select("value")
    begun = {(r.file, r.block) for r in blocks if r.open}
    whole, crossing = (lines.mapInArrow(_records(begun, c), "value string, file long, block long, part int") for c in (False, True))
    # within a block what ends a record precedes what begins one
    order = Window.partitionBy("file").orderBy("block", F.desc("part"))
    numbered = crossing.withColumn("record", F.sum((F.col("part") == 1).cast("int")).over(order))
    held = F.array_sort(F.collect_list(F.struct("block", (-F.col("part")).alias("part"), "value")))
    joined = numbered.groupBy("file", "record").agg(F.concat_ws("\n", F.transform(held, lambda x: x["value"])).alias("value"))
    return whole.select("value").unionByName(joined.select("value"))


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    *,
    delimiter: str = DEFAULT_DELIMITER,
    contains_header: bool | None = None,
    header_at: int | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """S3. Delimited text. A header on line N > 1 makes the lines before it preamble, dropped per file.

    Cells of such files may hold line breaks inside quotes, read as ``\\n``, wherever the file is split; the header itself is one
    line, a quote stands only around a cell or doubled inside one, and without a ``schema`` all files have the same header. A
    quote that is never closed takes the rest of its file. This reads the lines once more to count quotes, and where a record goes over a
    line a third time, for what crosses blocks.
    """
    header, line = header_line(contains_header, header_at)
    if line <= 1:
        reader = spark.read.options(sep=delimiter, header=header, quote='"', escape='"', multiLine=False)
        return (reader.schema(schema) if schema is not None else reader).csv(path)
    raw = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    numbered = raw.select("value", F.xxhash64("file_path").alias("file"), "file_block_start")
    head = None
    if schema is None:
        first = raw.agg(F.min("file_path")).scalar()
        head = raw.filter((F.col("file_path") == first) & (F.col("file_block_start") == 0)).take(line)[-1]["value"]
        schema = T.StructType([T.StructField(c.strip(), T.StringType()) for c in next(csv.reader([head], delimiter=delimiter))])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    body = _join_lines(numbered.mapInArrow(_without_preamble(line, head), "value string, file long, block long"))
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    parsed = body.filter(F.trim("value") != "").select(F.from_csv("value", F.lit(ddl), {"sep": delimiter, "escape": '"'}).alias("r"))
    return parsed.select("r.*")


def scan_json(spark: SparkSession, path: str | list[str], *, schema=None, multiline=False, corrupt="_corrupt") -> DataFrame:
    """S4. JSON lines or whole-file JSON; a broken record keeps its text in the corrupt column of the schema."""
    reader = spark.read.options(multiLine=multiline, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def scan_parquet(spark: SparkSession, path: str | list[str], *, merge_schema: bool = False) -> DataFrame:
    """S5. Parquet files."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def scan_files(spark: SparkSession, path: str, file_format: str, *, row_tag: str = "row", schema=None, **options) -> DataFrame:
    """S6. ORC, XML or Avro files; Avro needs the spark-avro package on the cluster."""
    reader = spark.read.format(file_format).options(**options)
    reader = reader.option("rowTag", row_tag) if file_format == "xml" else reader
    return (reader.schema(schema) if schema is not None else reader).load(path)


def scan_object_store(spark: SparkSession, uri: str, file_format: str, *, glob: str | None = None, **options) -> DataFrame:
    """S7. Files below a URI, at any depth, with the file each row came from in ``source_file``."""
    reader = spark.read.format(file_format).options(recursiveFileLookup=True, **options)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    return reader.load(uri).select("*", F.col("_metadata.file_path").alias("source_file"))


def jdbc_options(url: str, table: str, *, key: str, low: int, high: int, rows: int, rows_per_task: int = 1_000_000, fetch: int = 10_000) -> dict:
    """Options that split a table scan into ranges of a numeric key, as many as ``rows`` need; the range only sets bounds."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(max(high, low + 1)),
        "numPartitions": str(max(1, min(high - low + 1, -(-rows // rows_per_task)))),
        "fetchsize": str(fetch),
    }


def scan_jdbc(spark: SparkSession, url: str, table: str, *, key: str, rows_per_task: int = 1_000_000, **options) -> DataFrame:
    """S8. A database table read in parallel key ranges; filters and column lists are pushed to the database."""
    bounds = spark.read.format("jdbc").options(url=url, query=f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT(*) AS n FROM {table}", **options)
    lo, hi, n = bounds.load().head()
    if lo is None:
        return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    split = jdbc_options(url, table, key=key, low=int(lo), high=int(hi), rows=int(n), rows_per_task=rows_per_task)
    return spark.read.format("jdbc").options(**split, **options).load()


def scan_json_path(landed: DataFrame, payload: str, path: str, record: T.StructType | str) -> DataFrame:
    """S10. Landed API payloads: the array at a path such as ``$.data.items``, one row per record.

    A payload whose path holds no array keeps one row of nulls, so that nothing vanishes unseen.
    """
    ddl = record if isinstance(record, str) else record.simpleString()
    records = F.try_variant_get(F.try_parse_json(payload), path, f"array<{ddl}>")
    kept = [c for c in landed.columns if c != payload]
    return landed.select(*kept, F.inline_outer(records))


def scan_all_partitions(spark: SparkSession, paths: Sequence[str], file_format: str = "parquet") -> DataFrame:
    """S11. The same entity from many places as one read of all paths; places that cannot be read are skipped, and named
    in a warning (:func:`scan_places` returns them).

    Only when schemas differ are the places read one by one and united by name.
    """
    found, skipped = scan_places(spark, paths, file_format)
    for path, why in skipped.items():
        warnings.warn(f"{path} was skipped: {why}", stacklevel=2)
    return found


def scan_places(spark: SparkSession, paths: Sequence[str], file_format: str = "parquet") -> tuple[DataFrame, dict[str, str]]:
    """S11. The rows of all places that can be read, and why each of the others cannot. Schemas are read side by side."""
    reader = spark.read.option("ignoreMissingFiles", True).format(file_format)

    def schema(path: str) -> T.StructType | str:
        try:
            return reader.load(path).schema
        except PySparkException as e:
            return str(e).split("\n")[0]

    with ThreadPoolExecutor(max_workers=16) as pool:
        schemas = dict(zip(paths, pool.map(schema, paths)))
    readable = [(p, s) for p, s in schemas.items() if isinstance(s, T.StructType)]
    if not readable:
        raise ValueError("none of the paths can be read")
    skipped = {p: s for p, s in schemas.items() if isinstance(s, str)}
    if len({s.json() for _, s in readable}) == 1:
        return reader.schema(readable[0][1]).load([p for p, _ in readable]), skipped
    return union_sources(*[reader.schema(s).load(p) for p, s in readable]), skipped


CONNECTOR_FILE = "connectorType string, availableConnectors array<struct<connectorName:string,active:boolean>>"


def scan_category_files(spark: SparkSession, paths: Iterable[str], schema: str = CONNECTOR_FILE) -> DataFrame:
    """S12. Category files: each active entry as a row with its file's category. A broken file yields no rows."""
    files = spark.read.options(mode="PERMISSIVE", ignoreMissingFiles=True, ignoreCorruptFiles=True).schema(schema).json(list(paths))
    entries = files.select(F.col("connectorType").alias("category"), F.inline("availableConnectors"))
    return entries.filter("active")
