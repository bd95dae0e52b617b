"""Ingestion modes (I1-I15, V1). Where the published contract names a mode without its algorithm, the rule used here
is stated in the docstring."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.vocabulary import INGESTION_TYPES, MODE_WORDS, TRUE_WORDS
from millrace.operators.shape import added_removed_by_digest, flatten_struct
from millrace.operators.sliced import HOT_ROWS, SLICE, hot_keys, orderable, top_per_group, with_slices
from millrace.session import work_path
from millrace.sinks import writers
from millrace.sources import readers
from millrace.sources.readers import column_list
from millrace.sources.store import KeyedTable, LoadTable, MarkTable, folders, join_keys, remove

FIRST_RUN = "1970-01-01 00:00:00"
SNAPSHOT = "_snapshot_id"
INFER = "*"  # in place of a schema: find it in the documents
Mark = str | Sequence[str]  # one column or several


# ---- configuration -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Artifact:
    """One table of a load. Defaults are the published ones."""

    source: str
    target: str
    columns: list[str] | None = None
    ingestion_type: str = "snapshot"
    merge_columns: list[str] = field(default_factory=list)
    watermark: Mark | None = None
    auto_explode: bool = False
    detect_deletes: bool = False
    priority: bool = False
    replace_table: bool = False
    backload_days: int = 0
    snapshot_retention: int = 3
    cdc_op: str = "op"
    query: str | None = None
    pre_sql: str | None = None
    post_sql: str | None = None
    steps: list[dict] = field(default_factory=list)
    file: str | None = None
    file_format: str = "csv"
    delimiter: str = readers.DEFAULT_DELIMITER
    contains_header: bool | None = None
    header_at: int | None = None
    json_path: str | None = None
    json_column: str = "payload"
    json_record: str | None = None
    flatten: str | None = None
    document: str = "document"
    slots: int | None = None  # buckets of a keyed target
    compression: str | None = None
    distribution_key: list[str] = field(default_factory=list)
    sort_key: list[str] = field(default_factory=list)


# The names under which a configuration may give each setting, the first one given counts.
CONFIG_KEYS = {
    "kind": ("ingestionType", "mode"),
    "keys": ("mergeColumns", "primaryKeys", "primaryKey"),
    "marks": ("watermarkColumnName", "timestampColumn", "incrementalColumn", "cdcColumn"),
    "source": ("sourceTableName", "sourceObjectName", "sourceTable", "sourceCollection", "sourceObject"),
    "target": ("targetTableName", "targetObjectName", "targetTable"),
    "columns": ("sourceColumnNames", "columns"),
    "file": ("sourceFile", "sourceFilePath"),
    "file_format": ("sourceFileFormat", "fileFormat"),
    "delimiter": ("sourceFileDelimiter",),
    "header": ("containsHeader",),
    "header_at": ("columnHeaderLineNumber",),
    "json_path": ("jsonPath",),
    "flatten": ("flatten",),
    "compression": ("compression",),
    "distribution_key": ("distributionKey",),
    "sort_key": ("sortKey",),
    "query": ("sourceQuery",),
    "pre_sql": ("preScript",),
    "post_sql": ("postScript",),
}


def _list(value: Any) -> list[str]:
    return [value] if isinstance(value, str) else list(value or [])


def _flag(value: Any) -> bool:
    return value.lower() in TRUE_WORDS if isinstance(value, str) else value is True or value == 1


def _whole(value: Any, default: int) -> int:
    try:
        return int(float(value))
    except (TypeError, ValueError):
        return default


def artifact_from_config(item: Mapping[str, Any]) -> Artifact:
    """An artifact from its JSON configuration, under any of the published key names."""

    def first(setting: str) -> Any:
        return next((item[n] for n in CONFIG_KEYS[setting] if item.get(n)), None)

    kind = first("kind") or "snapshot"
    marks = _list(first("marks"))
    source = first("source") or ""
    kind = MODE_WORDS.get(kind, kind)
    if kind not in (*INGESTION_TYPES, *MODE_WORDS.values()):
        raise ValueError(f"unknown ingestion type {kind!r}")
    header = item.get("containsHeader")
    flatten = first("flatten")
    return Artifact(
        source=source,
        target=first("target") or source,
        columns=column_list(first("columns")),
        ingestion_type=kind,
        merge_columns=_list(first("keys")),
        watermark=(marks[0] if len(marks) == 1 else tuple(marks)) if marks else None,
        auto_explode=_flag(item.get("autoExplode")),
        detect_deletes=_flag(item.get("detectDeletes")),
        priority=_flag(item.get("priority")),
        replace_table=_flag(item.get("replaceTable")),
        backload_days=_whole(item.get("backloadNumDays"), 0),
        snapshot_retention=_whole(item.get("snapshotRetentionPeriod"), 3),
        query=first("query"),
        pre_sql=first("pre_sql"),
        post_sql=first("post_sql"),
        steps=list(item.get("operations") or []),
        file=first("file"),
        file_format=(first("file_format") or "csv").lower(),
        delimiter=first("delimiter") or readers.DEFAULT_DELIMITER,
        contains_header=None if header is None else _flag(header),
        header_at=_whole(first("header_at"), 1) if first("header_at") else None,
        json_path=first("json_path"),
        json_column=item.get("jsonColumn") or "payload",
        json_record=item.get("jsonRecord"),
        flatten=flatten if isinstance(flatten, str) and flatten.lower() not in TRUE_WORDS else item.get("documentSchema") or INFER if flatten else None,
        document=item.get("documentColumn") or "document",
        compression=first("compression"),
        distribution_key=_list(first("distribution_key")),
        sort_key=_list(first("sort_key")),
    )


# ---- snapshots -----------------------------------------------------------------------------------------------------


def ingest_snapshot(df: DataFrame, path: str, snapshot_id: str) -> None:
    """I1. A full copy as its own partition; loading the same id again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/{SNAPSHOT}={snapshot_id}")


def _natural(c: Column) -> Column:
    """Sorts ids as people do: runs of digits by value, so that s9 comes before s10."""
    runs = F.regexp_extract_all(c.cast("string"), F.lit(r"(\d+|\D+)"))
    return F.transform(runs, lambda x: F.when(x.rlike(r"^\d"), F.lpad(x, 40, "0")).otherwise(x))


def _natural_id(name: str) -> list[str]:
    return [x.zfill(40) if x.isdigit() else x for x in re.findall(r"\d+|\D+", name)]


def snapshot_retention(snapshots: DataFrame, keep: int = 3) -> DataFrame:
    """I2. Rows of the newest ``keep`` snapshots (the unit is taken as snapshots, not days), ids in natural order. The kept
    ids are at most ``keep`` rows, and joining on the partition column lets Spark skip the other folders."""
    newest = snapshots.select(SNAPSHOT).distinct().orderBy(_natural(F.col(SNAPSHOT)).desc()).limit(keep)
    return snapshots.join(newest, SNAPSHOT, "left_semi")


def retain_snapshots(spark: SparkSession, path: str, keep: int = 3) -> list[str]:
    """I2. Remove all but the newest ``keep`` snapshots below ``path``; the ids that went. Reads the list of folders only."""
    ids = sorted((f.partition("=")[2] for f in folders(spark, path) if f.startswith(f"{SNAPSHOT}=")), key=_natural_id)
    gone = ids[: max(0, len(ids) - keep)]
    for i in gone:
        remove(spark, f"{path}/{SNAPSHOT}={i}")
    return gone


# ---- watermarks ----------------------------------------------------------------------------------------------------


def mark_column(watermark: Mark) -> Column:
    """The column by which rows are new; of several the greatest, nulls aside."""
    names = [watermark] if isinstance(watermark, str) else list(watermark)
    return F.col(names[0]) if len(names) == 1 else F.greatest(*names)


def _is_time(df: DataFrame, watermark: Mark) -> bool:
    kind = df.select(mark_column(watermark)).schema[0].dataType
    return isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))


def lower_bound(last: str | None, backload_days: int = 0) -> Column:
    """I4, I7. Where reading by time starts: the last mark, or the epoch on a first run, minus the days to read again."""
    mark = F.lit(last or FIRST_RUN).cast("timestamp_ntz")
    return mark - F.make_interval(days=F.lit(backload_days)) if backload_days else mark


def watermark_filter(df: DataFrame, watermark: Mark, last: str | None, backload_days: int = 0) -> DataFrame:
    """I4, I7. Rows strictly newer than the bound; a plain comparison, so it reaches the scan.

    A mark that is no time (a number, a text) starts with all rows that have one, and knows no days to read again.
    """
    mark = mark_column(watermark)
    if _is_time(df, watermark):
        return df.filter(mark > lower_bound(last, backload_days))
    if backload_days:
        raise ValueError(f"{watermark} is no time, so there are no days to read again")
    return df.filter(mark.isNotNull() if last is None else mark > F.lit(last).cast(df.select(mark).schema[0].dataType))


def watermark_advance(batch: DataFrame, watermark: Mark) -> str | None:
    """I5. The new mark: the greatest value that was loaded. (A wall clock would skip rows committed during the load.)"""
    return batch.agg(_greatest_mark(batch, watermark)).head()[0]


def _greatest_mark(batch: DataFrame, watermark: Mark) -> Column:
    top = F.max(mark_column(watermark))
    return F.date_format(top, "yyyy-MM-dd HH:mm:ss.SSSSSS") if _is_time(batch, watermark) else top.cast("string")


def has_changes(df: DataFrame, watermark: Mark, last: str | None) -> bool:
    """I6. Whether there is anything to load; stops at the first row found."""
    return not watermark_filter(df, watermark, last).isEmpty()


def change_count(df: DataFrame, watermark: Mark, last: str | None) -> DataFrame:
    """I6. How many rows changed since the mark."""
    return watermark_filter(df, watermark, last).agg(F.count("*").alias("changed"))


# ---- merging -------------------------------------------------------------------------------------------------------


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The newest row of each key. Each task keeps one row per key before the shuffle, so a hot key is harmless."""
    return top_per_group(df, keys, [F.col(o).desc() for o in order], 1, "_rank").drop("_rank")


def ingest_delta(
    store: KeyedTable, source: DataFrame, watermark: Mark, marks: MarkTable, artifact: str, backload_days: int = 0, tie: str | None = None
) -> int | None:
    """I3. Rows newer than the mark, newest per key, merged; then the mark moves. The number of the load, None if nothing is new.

    The mark is observed while the rows are written. It moves only after the load is whole, and merging the same rows again
    changes nothing, so a failure in between is repaired by the next run.
    """
    last = marks.get(artifact)
    new = watermark_filter(source, watermark, last, backload_days)
    order = [mark_column(watermark).desc(), *([F.col(tie).desc()] if tie else [])]
    if store.loads() and new.isEmpty():
        return None
    loaded = Observation()
    load = store.merge(top_per_group(new, store.keys, order, 1, "_rank").drop("_rank").observe(loaded, _greatest_mark(new, watermark).alias("mark")))
    mark = loaded.get["mark"]
    if mark is not None:
        # reading days again can end below the mark; the texts of times sort like the times
        marks.put(artifact, max(mark, last or mark) if backload_days else mark)
    return load


def detect_deletes(target: DataFrame, source: DataFrame, keys: Sequence[str], mark: str | None = None) -> DataFrame:
    """I10. The target without rows whose key left the source; with ``mark``, all rows and a flag instead. Null is a key."""
    present = source.select(*keys).distinct()
    if mark is None:
        return join_keys(target, present, keys, "left_semi")
    flagged = join_keys(target, present.withColumn("_here", F.lit(True)), keys, "left")
    return flagged.withColumn(mark, F.col("_here").isNull()).drop("_here")


def detect_deletes_by_digest(
    target: DataFrame, source: DataFrame, keys: Sequence[str], mark: str | None = None, slices: int = 1024
) -> DataFrame:
    """I10 for large tables of which few keys left: :func:`detect_deletes`, with the keys looked for only in those slices of the
    key whose digests differ. A key that the target repeats makes its slice differ, and is found there all the same."""
    gone = added_removed_by_digest(target, source, keys, slices).filter("status = 'removed'").select(*keys).distinct()
    if mark is None:
        return join_keys(target, gone, keys, "left_anti")
    flagged = join_keys(target, gone.withColumn("_gone", F.lit(True)), keys, "left")
    return flagged.withColumn(mark, F.col("_gone").isNotNull()).drop("_gone")


def scd2(changes: DataFrame, keys: Sequence[str], watermark: str, tracked: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """I8. History of each key: one row per run of equal values with valid_from, valid_to and is_current.

    A version begins where the tracked columns differ (null-safe) from the key's row before, and ends where the next
    one begins; of several rows of a key at one time the greatest counts. Keys with more than ``hot_rows`` rows are
    worked on in slices, the others in one window per key.
    """
    k = list(keys)
    if not orderable(changes.schema[watermark].dataType):
        raise ValueError(f"{watermark} must be a number or a time")
    rows = changes.select(*k, watermark, F.struct(*tracked).alias("_val"))
    hot = hot_keys(rows, k, hot_rows)
    total = hot.agg(F.sum("n")).head()[0]
    if not total:
        found = _versions(rows, k, watermark)
    else:
        # the few hot keys are written down, so that their size is known when the joins are planned
        path = work_path(changes.sparkSession, "hot_keys")
        hot.write.parquet(path)
        known = changes.sparkSession.read.schema(hot.schema).parquet(path).select(*k)
        spread = _sliced_versions(rows.join(known, k, "left_semi"), k, watermark, -(-total // hot_rows))
        found = spread.unionByName(_versions(rows.join(known, k, "left_anti"), k, watermark))
    return found.select(
        *k, *[F.col("_val")[c].alias(c) for c in tracked], "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current")
    )


def _versions(rows: DataFrame, keys: Sequence[str], watermark: str) -> DataFrame:
    """Begin and end of each run of equal values, by windows over the key that share one shuffle and one sort."""
    order = Window.partitionBy(*keys).orderBy(watermark, "_val")
    last = rows.withColumn("_again", F.lead(watermark).over(order))
    last = last.filter(F.col("_again").isNull() | (F.col("_again") != F.col(watermark))).drop("_again")
    began = last.withColumn("_before", F.lag(F.struct("_val")).over(order))
    began = began.filter(F.col("_before").isNull() | ~F.col("_before")["_val"].eqNullSafe(F.col("_val")))
    return began.select(*keys, "_val", F.col(watermark).alias("valid_from"), F.lead(watermark).over(order).alias("valid_to"))


def _sliced_versions(hot: DataFrame, keys: Sequence[str], watermark: str, slices: int) -> DataFrame:
    """As :func:`_versions`, by windows over (key, slice). Each slice's summary row says whether the slice opens with a
    change, given the last value before it, and where the first change after it lies. Copies of a row are combined
    first, in the tasks that read them, because no slice can split them."""
    k = list(keys)
    sliced = with_slices(hot, watermark, slices).distinct()
    inside = Window.partitionBy(*k, SLICE)
    forward = inside.orderBy(watermark, "_val")
    rows = sliced.withColumn("_again", F.lead(watermark).over(forward))
    rows = rows.filter(F.col("_again").isNull() | (F.col("_again") != F.col(watermark))).drop("_again")
    rows = rows.withColumn("_before", F.lag(F.struct("_val")).over(forward))
    differs = F.col("_before").isNotNull() & ~F.col("_before")["_val"].eqNullSafe(F.col("_val"))
    rows = rows.withColumn("_start", F.when(differs, F.col(watermark)))
    later = inside.orderBy(F.col(watermark).desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_next", F.min("_start").over(later))

    summary = rows.groupBy(*k, SLICE).agg(
        F.min(F.struct(watermark, F.struct("_val").alias("v"))).alias("_first"),
        F.max(F.struct(watermark, F.struct("_val").alias("v"))).alias("_last"),
        F.min("_start").alias("_inner"),
    )
    order = Window.partitionBy(*k).orderBy(SLICE)
    summary = summary.withColumn("_carried", F.lag(F.col("_last.v")).over(order))
    opens = ~F.col("_carried").eqNullSafe(F.col("_first.v"))
    summary = summary.withColumn("_opens", opens).withColumn(
        "_begin", F.when(opens, F.col("_first")[watermark]).otherwise(F.col("_inner"))
    )
    after = Window.partitionBy(*k).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_following", F.min("_begin").over(after)).select(*k, SLICE, "_opens", "_following")

    joined = rows.join(summary, [*k, SLICE])
    starts = F.col("_start").isNotNull() | (F.col("_before").isNull() & F.col("_opens"))
    return joined.filter(starts).select(
        *k, "_val", F.col(watermark).alias("valid_from"), F.coalesce("_next", "_following").alias("valid_to")
    )


def ingest_historical(store: KeyedTable, changes: DataFrame, watermark: str, tracked: Sequence[str]) -> int:
    """I8. Add changes to a stored history; the versions of the keys that changed are made anew.

    What was observed is kept in a table beside the history, each observation once, so that the result does not depend on how
    the changes were split into loads, in which order they came, or whether one came twice. Rows without a time cannot be
    placed; they go to a table of their own (:func:`undated`).
    """
    rows = changes.select(*store.keys, *tracked, watermark)
    _add_distinct(undated(store), rows.filter(F.col(watermark).isNull()))
    dated = rows.filter(F.col(watermark).isNotNull())
    seen, touched = observations(store), dated.select(*store.keys).distinct()
    _add_distinct(seen, dated)
    return store.replace_rows(touched, scd2(seen.rows_of(touched), store.keys, watermark, tracked))


def _add_distinct(table: KeyedTable, rows: DataFrame) -> None:
    """Add the rows that the table does not have yet."""
    keys = rows.select(*table.keys).distinct()
    old = table.rows_of(keys)
    table.replace_rows(keys, (rows if old is None else old.unionByName(rows)).distinct())


def observations(store: KeyedTable) -> KeyedTable:
    """All that :func:`ingest_historical` has seen of each key."""
    return store.beside("observations")


def undated(store: KeyedTable) -> KeyedTable:
    """The rows that :func:`ingest_historical` could not place for want of a time."""
    return store.beside("undated")


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], op: str, order: str, deleted: str = "D") -> DataFrame:
    """I9. Target after a batch of inserts, updates and deletes: the last change of each key decides. Null is a key."""
    last = latest_per_key(changes, keys, order)
    kept = join_keys(target, last.select(*keys), keys, "left_anti")
    live = last.filter(F.col(op) != deleted).select(*target.columns)
    return kept.unionByName(live)


def ingest_cdc(store: KeyedTable, changes: DataFrame, op: str, order: str) -> int:
    """I9 on a stored table. Deleted keys stay as tombstones (op ``D``), so that a late change cannot revive them; a change
    that is not newer than the stored row is ignored."""
    return store.merge(latest_per_key(changes, store.keys, order), order)


def live_rows(stored: DataFrame, op: str, order: str, deleted: str = "D") -> DataFrame:
    """The visible rows of a table kept by :func:`ingest_cdc`."""
    return stored.filter(F.col(op) != deleted).drop(op, order)


# ---- nested data ---------------------------------------------------------------------------------------------------


def array_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]


def auto_explode(df: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """I11. One child table (keys, pos, element) per array column; struct elements become columns."""
    out = {}
    for name in array_columns(df):
        child = df.select(*keys, F.posexplode(F.col(f"`{name}`")).alias("pos", "element"))
        element = child.schema["element"].dataType
        if isinstance(element, T.StructType):
            taken = {*keys, "pos"}
            child = child.select(*keys, "pos", *[F.col("element")[f].alias(f"element_{f}" if f in taken else f) for f in element.names])
        out[name] = child
    return out


def explode_in_place(df: DataFrame, column: str) -> DataFrame:
    """I11. One row per element, rows with an empty or missing array kept with null."""
    return df.withColumn(column, F.explode_outer(F.col(f"`{column}`")))


def inferred_schema(documents: DataFrame, document: str) -> str:
    """I12. The schema of JSON texts, as DDL, by one mergeable aggregate over all of them; texts that are no JSON are passed over.

    Numbers with a fraction are doubles, and what was never seen with a value is a string.
    """
    found = documents.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(f"`{document}`")))).head()[0]
    for pattern, kind in ((r"(^|<|: )OBJECT<", r"\1STRUCT<"), (r"(^|<|: )DECIMAL\(\d+, ?\d+\)", r"\1DOUBLE"), (r"(^|<|: )VOID(?=$|>|,)", r"\1STRING")):
        found = re.sub(pattern, kind, found)
    return found


def flatten_documents(df: DataFrame, document: str, schema: T.StructType | str, keys: Sequence[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """I12. JSON documents as a flat table with ``a.b`` columns, and a child table per top-level array."""
    parsed = df.select(*keys, F.from_json(document, schema).alias("_doc")).select(*keys, "_doc.*")
    flat = flatten_struct(parsed)
    arrays = array_columns(flat)
    return flat.drop(*arrays), auto_explode(flat, keys)


# ---- row outcomes --------------------------------------------------------------------------------------------------


def with_errors(df: DataFrame, casts: Mapping[str, str], required: Sequence[str] = ()) -> DataFrame:
    """I15. Cast columns without failing; ``_errors`` lists what was wrong with a row, with the texts that did not fit."""
    problems = [F.when(F.col(c).isNull(), F.lit(f"{c} is required")) for c in required]
    problems += [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.concat(F.lit(f"{c} is not {t}: "), F.col(c).cast("string")))
        for c, t in casts.items()
    ]
    kept = [F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns]
    return df.select(*kept, F.array_compact(F.array(*problems)).alias("_errors"))


def split_outcome(df: DataFrame, casts: Mapping[str, str], required: Sequence[str] = (), fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """I15. (good rows, bad rows with their errors). With ``fail_fast`` the first bad row ends the job."""
    checked = with_errors(df, casts, required)
    bad = F.size("_errors") > 0
    if fail_fast:
        checked = checked.withColumn("_errors", F.when(bad, F.raise_error(F.array_join("_errors", "; "))).otherwise(F.col("_errors")))
    return checked.filter(~bad).drop("_errors"), checked.filter(bad)


def outcome_counts(df: DataFrame, casts: Mapping[str, str], required: Sequence[str] = ()) -> DataFrame:
    """I15. Items, good and bad, in one pass."""
    bad = F.size("_errors") > 0
    checked = with_errors(df, casts, required)
    return checked.agg(F.count("*").alias("items"), F.count_if(~bad).alias("ok"), F.count_if(bad).alias("failed"))


# ---- transforms and multi-table loads ------------------------------------------------------------------------------


def apply_steps(df: DataFrame, steps: Sequence[Mapping[str, Any]]) -> DataFrame:
    """V1. Declarative steps in order: select, rename, cast, filter, with_column, drop_duplicates."""
    actions: dict[str, Callable[[DataFrame, Any], DataFrame]] = {
        "select": lambda d, a: d.select(*a),
        "rename": lambda d, a: d.withColumnsRenamed(a),
        "cast": lambda d, a: d.withColumns({c: F.col(c).try_cast(t) for c, t in a.items()}),
        "filter": lambda d, a: d.filter(F.expr(a)),
        "with_column": lambda d, a: d.withColumns({c: F.expr(e) for c, e in a.items()}),
        "drop_duplicates": lambda d, a: d.dropDuplicates(a),
    }
    for step in steps:
        ((name, argument),) = step.items()
        if name not in actions:
            raise ValueError(f"unknown step {name!r}")
        df = df.transform(actions[name], argument)
    return df


OUTCOME = "target string, success boolean, mode string, row_count bigint, message string"


def read_source(spark: SparkSession, a: Artifact) -> DataFrame:
    """What an artifact reads: a query, a file, or a registered view or table; JSON payloads taken apart, documents flattened."""
    if a.query:
        source = spark.sql(a.query)
    elif a.file is None:
        source = spark.table(a.source)
    elif a.file_format in ("csv", "txt", "delimited"):
        source = readers.scan_delimited(spark, a.file, delimiter=a.delimiter, contains_header=a.contains_header, header_at=a.header_at)
    elif a.file_format == "json":
        source = readers.scan_json(spark, a.file)
    elif a.file_format == "parquet":
        source = readers.scan_parquet(spark, a.file)
    else:
        source = readers.scan_files(spark, a.file, a.file_format)
    if a.json_path:
        record = a.json_record
        if not record:
            inside = source.select(F.get_json_object(a.json_column, a.json_path).alias("inside"))
            found = re.fullmatch(r"ARRAY<(STRUCT<.*>)>", inferred_schema(inside, "inside"))
            if not found:
                raise ValueError(f"there is no array of records at {a.json_path}")
            record = found[1]
        source = readers.scan_json_path(source, a.json_column, a.json_path, record)
    return source


def _load_child(spark: SparkSession, a: Artifact, name: str, child: DataFrame, parents: DataFrame, root: str, load_id: str) -> None:
    """I11. A child table in the mode of its parent: added to, or the rows of the loaded parents replaced.

    It is keyed by the parent, so a parent whose array became shorter leaves nothing behind.
    """
    keys, path = a.merge_columns, f"{root}/{a.target}__{name}"
    if a.ingestion_type == "append":
        LoadTable(spark, path).add(child, load_id)
        return
    table = KeyedTable(spark, path, keys or ["pos"], a.slots)
    if a.ingestion_type in ("delta", "upsert", "cdc", "historical") and keys:
        known = parents.select(*keys).distinct()
        table.replace_rows(known, join_keys(child, known, keys, "left_semi"))
    else:
        table.replace(child)


def stored(spark: SparkSession, a: Artifact, root: str) -> DataFrame | None:
    """What an artifact's target holds; None before the first load."""
    path = f"{root}/{a.target}"
    if a.ingestion_type == "append":
        return LoadTable(spark, path).read()
    if a.ingestion_type == "snapshot" and not a.replace_table:
        return spark.read.parquet(path)
    table = KeyedTable(spark, path, a.merge_columns, a.slots)
    return table.read()


def load_artifact(spark: SparkSession, a: Artifact, root: str, load_id: str) -> int:
    """One artifact end to end; returns the rows of the target afterwards. Sources are files, registered views or tables."""
    if a.ingestion_type in ("delta", "historical", "cdc") and not a.watermark:
        raise ValueError(f"{a.ingestion_type} needs a watermark column")
    if a.ingestion_type in ("delta", "historical", "cdc", "upsert") and not a.merge_columns:
        raise ValueError(f"{a.ingestion_type} needs merge columns")
    if a.ingestion_type in ("historical", "cdc") and not isinstance(a.watermark, str):
        raise ValueError(f"{a.ingestion_type} takes one watermark column")
    if a.pre_sql:
        spark.sql(a.pre_sql)
    source = read_source(spark, a)
    children: dict[str, DataFrame] = {}
    if a.flatten:
        schema = inferred_schema(source, a.document) if a.flatten == INFER else a.flatten
        source, children = flatten_documents(source, a.document, schema, [c for c in source.columns if c != a.document])
    source = apply_steps(source.select(*a.columns) if a.columns else source, a.steps)
    path = f"{root}/{a.target}"
    if a.ingestion_type == "snapshot" and (a.distribution_key or a.sort_key or a.compression):
        folder = f"{path}/{SNAPSHOT}={load_id}"
        writers.write_layout(source, folder, a.distribution_key, a.sort_key, a.compression)
        retain_snapshots(spark, path, a.snapshot_retention)
        rows = spark.read.parquet(path)
    elif a.ingestion_type == "snapshot" and not a.replace_table:
        ingest_snapshot(source, path, load_id)
        retain_snapshots(spark, path, a.snapshot_retention)
        rows = spark.read.parquet(path)
    elif a.ingestion_type == "append":
        table = LoadTable(spark, path)
        table.add(source, load_id)
        rows = table.read()
    else:
        store = KeyedTable(spark, path, a.merge_columns or [source.columns[0]], a.slots)
        if a.replace_table or a.ingestion_type in ("snapshot", "overwrite", "stored_procedure"):
            store.replace(source)
        elif a.ingestion_type == "upsert":
            # without a mark any row of a key will do; the one with the greatest text is the same on every run
            order = [mark_column(a.watermark)] if a.watermark else [F.to_json(F.struct(*source.columns))]
            store.merge(top_per_group(source, store.keys, [c.desc() for c in order], 1, "_rank").drop("_rank"))
        elif a.ingestion_type == "cdc":
            ingest_cdc(store, source, a.cdc_op, a.watermark)
        elif a.ingestion_type == "historical":
            ingest_historical(store, source, a.watermark, [c for c in source.columns if c not in (*store.keys, a.watermark)])
        else:
            ingest_delta(store, source, a.watermark, MarkTable(spark, f"{root}/_marks"), a.target, a.backload_days)
        if a.detect_deletes and a.ingestion_type in ("delta", "upsert"):
            store.replace_rows(join_keys(store.read(), source.select(*store.keys).distinct(), store.keys, "left_anti"))
        rows = store.read()
    if a.auto_explode:
        children |= auto_explode(source, a.merge_columns)
    for name, child in children.items():
        _load_child(spark, a, name, child, source, root, load_id)
    if a.post_sql:
        spark.sql(a.post_sql)
    return rows.count()


def multi_table_sync(
    spark: SparkSession, artifacts: Sequence[Artifact], root: str, load_id: str, concurrency: int = 5, fail_fast: bool = False
) -> DataFrame:
    """I14. Load many artifacts, priority ones first; one outcome row each. A failure does not stop the others unless
    asked to. Within each of the two groups up to ``concurrency`` loads share the cluster."""

    def run(a: Artifact) -> tuple:
        try:
            return a.target, True, a.ingestion_type, load_artifact(spark, a, root, load_id), None
        except Exception as e:  # whatever it is, it is this artifact's outcome
            if fail_fast:
                raise
            return a.target, False, a.ingestion_type, None, str(e).split("\n")[0]

    outcomes: list[tuple] = []
    for first in (True, False):
        group = [a for a in artifacts if a.priority is first]
        with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
            outcomes += list(pool.map(run, group))
    return spark.createDataFrame(outcomes, OUTCOME)
