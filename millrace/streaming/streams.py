"""Structured Streaming forms of the loads and run reports (T1-T7). Every query takes a checkpoint folder; with the
default trigger it works off what is there and stops, so the same code serves scheduled and continuous use."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from millrace.operators.ingest import ingest_cdc, with_errors
from millrace.operators.runs import newest
from millrace.sources.store import KeyedTable

LOG_DAY = "log_day"
PACK = 1 << 17  # rows of which a reading task picks the newest of each entity before it passes them on


def read_files(spark: SparkSession, path: str, schema, files_per_batch: int = 1000, file_format: str = "parquet") -> DataFrame:
    """A stream of the files that land in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(file_format).load(path)


def _writer(stream: DataFrame, checkpoint: str, continuous: str | None):
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)


def stream_cdc_apply(
    changes: DataFrame, store: KeyedTable, op: str, order: str, checkpoint: str, continuous: str | None = None
) -> StreamingQuery:
    """T1. Apply a change stream to a stored table. Within a batch the last change of a key counts; against the table,
    only a newer one. Replaying a batch therefore changes nothing."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        ingest_cdc(store, batch, op, order)

    return _writer(changes, checkpoint, continuous).foreachBatch(apply).start()


def stream_append(
    rows: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), continuous: str | None = None
) -> StreamingQuery:
    """T2. Append what arrives; the checkpoint remembers how far the load got."""
    return _writer(rows, checkpoint, continuous).partitionBy(*partition_by).format("parquet").outputMode("append").start(path)


_UTC = "UTC"


def _instant(rows: DataFrame, ts: str) -> Column:
    """Event time as an instant, which is what a watermark needs; a time without zone is read as UTC."""
    c = F.col(ts)
    if isinstance(rows.schema[ts].dataType, T.TimestampNTZType):
        c = F.convert_timezone(F.lit(_UTC), F.current_timezone(), c).cast("timestamp")
    return c


def _clock(instant: Column) -> Column:
    """The UTC clock time of an instant."""
    return F.convert_timezone(F.current_timezone(), F.lit(_UTC), instant.cast("timestamp_ntz"))


def stream_dedup(rows: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """T3. Drop repeated deliveries of a key that come within ``delay``; state older than that is forgotten.

    Copies that arrive together are dropped in the task that reads them, so a key that floods the stream is not sent
    whole to the one task that keeps its state.
    """
    names = list(keys)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeated = batch.select(names).to_pandas().duplicated().to_numpy()
            yield batch.filter(pa.array(~repeated)) if repeated.any() else batch

    rows = rows.mapInArrow(once, rows.schema)
    timed = rows.withColumn("_event_time", _instant(rows, ts)).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark(names).drop("_event_time")


def stream_log_tail(logs: DataFrame, path: str, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """T4. Follow log rows into a table that :func:`log_tail` reads."""
    return stream_append(logs, path, checkpoint, continuous=continuous)


def log_tail(logs: DataFrame, ts: str, tie: str, n: int = 20) -> DataFrame:
    """T4. The last n log rows; each task keeps n before anything moves."""
    return logs.orderBy(*newest(ts, tie)).limit(n)


def stream_log_by_day(logs: DataFrame, path: str, checkpoint: str, ts: str, continuous: str | None = None) -> StreamingQuery:
    """T4. Follow log rows into a table split by the day of ``ts``, so that :func:`newest_logged` need not read old days."""
    return stream_append(logs.withColumn(LOG_DAY, F.to_date(ts)), path, checkpoint, [LOG_DAY], continuous)


def newest_logged(spark: SparkSession, path: str, schema: T.StructType, ts: str, tie: str, n: int = 20) -> DataFrame:
    """T4. The last n rows of a table split by day, read from the newest day backwards: one day, then two, four and so on.

    Only the days' folders are listed, and only the days read are opened. Rows without a time count as the oldest. A log
    without rows, or not written yet, gives none.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{LOG_DAY}=*")
    listed = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(folder)
    days = sorted((f.getPath().getName().split("=", 1)[1] for f in listed or []), reverse=True)
    if not days:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema, T.StructField(LOG_DAY, T.DateType())])).parquet(path)
    dated = [d for d in days if d[0].isdigit()]  # the folder of rows without a time is named otherwise
    take = 1
    while take < len(dated):
        recent = rows.filter(F.col(LOG_DAY) >= F.to_date(F.lit(dated[take - 1])))
        if recent.limit(n).count() == n:
            rows = recent
            break
        take *= 2
    return log_tail(rows.drop(LOG_DAY), ts, tie, n)


def health_counts(runs: DataFrame, entity: str, ts: str, every: str, delay: str) -> DataFrame:
    """T5. Runs and successes per entity and time window. Rows later than the watermark are dropped."""
    timed = runs.withColumn("_event_time", _instant(runs, ts)).withWatermark("_event_time", delay)
    counted = timed.groupBy(F.window("_event_time", every).alias("w"), entity).agg(
        F.count("*").alias("runs"), F.count_if(F.col("status") == "success").alias("success")
    )
    return counted.select(_clock(F.col("w.start")).alias("window_start"), entity, "runs", "success")


def stream_health(
    runs: DataFrame, store: KeyedTable, entity: str, ts: str, every: str, delay: str, checkpoint: str, continuous: str | None = None
) -> StreamingQuery:
    """T5. Keep a table of :func:`health_counts`; each batch replaces the windows it changed."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        store.merge(batch)

    counted = health_counts(runs, entity, ts, every, delay)
    return _writer(counted, checkpoint, continuous).outputMode("update").foreachBatch(apply).start()


class _LastRuns(StatefulProcessor):
    """Keeps the newest ``n`` runs of an entity, and gives them out whenever they change."""

    def __init__(self, schema: T.StructType, ts: str, tie: str, n: int):
        self.schema, self.order, self.n = schema, (ts, tie), n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.runs = handle.getListState("runs", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # rows and not frames: an entity brings a few of them, and a frame costs more than they do
        old = [tuple(r) for r in self.runs.get()]
        at = [self.schema.names.index(c) for c in self.order]
        # a run that is delivered again takes its own place
        known = {r[at[1]]: r for r in [*map(tuple, rows), *old]}
        kept = sorted(known.values(), key=lambda r: [(r[i] is not None, r[i]) for i in at], reverse=True)[: self.n]
        if kept != old:
            self.runs.put(kept)
            for r in kept:
                yield Row(**dict(zip(self.schema.names, r)))

    def close(self) -> None:
        pass


def _few(entity: str, ts: str, tie: str, n: int):
    """Pass on the newest ``n`` runs of each entity of every ``PACK`` rows."""

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PACK:
                yield from newest_of(held)
                held, size = [], 0
        if held:
            yield from newest_of(held)

    def newest_of(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        places = rows.select([entity, ts, tie]).to_pandas().sort_values([ts, tie], ascending=False, na_position="last")
        keep = places.groupby(entity, dropna=False, sort=False).head(n).index.to_numpy()
        return rows.take(pa.array(np.sort(keep))).to_batches(max_chunksize=10_000)

    return few


def stream_alerts(
    runs: DataFrame, path: str, entity: str, ts: str, tie: str, checkpoint: str, n: int = 5, continuous: str | None = None
) -> StreamingQuery:
    """T6. Each entity's last n runs, kept as its state; alerts are a query over :func:`last_runs`.

    Of each ``PACK`` rows a task passes on n runs per entity, so an entity with most of the traffic is no bottleneck. A
    batch's changes go to a folder of its own: nothing that was written is written again, and a replayed batch overwrites its own
    folder.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    schema = runs.schema
    kept = runs.mapInArrow(_few(entity, ts, tie, n), schema).groupBy(entity).transformWithState(
        _LastRuns(schema, ts, tie, n), schema, "Update", "None"
    )
    spark = runs.sparkSession
    with _setting(spark, "spark.sql.streaming.stateStore.providerClass", _ROCKS):  # the one that can hold lists
        return _writer(kept, checkpoint, continuous).outputMode("update").foreachBatch(apply).start()


_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def last_runs(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """T6. What :func:`stream_alerts` gave out last for each entity."""
    all_ = spark.read.parquet(path)
    newest_batch = all_.groupBy(F.col(entity).alias("_of")).agg(F.max("batch").alias("_last"))
    return all_.join(newest_batch, F.col(entity).eqNullSafe(F.col("_of")) & (F.col("batch") == F.col("_last"))).drop("_of", "_last", "batch")


def stream_quarantine(
    rows: DataFrame, casts: Mapping[str, str], required: Sequence[str], ok_path: str, bad_path: str, checkpoint: str, continuous: str | None = None
) -> StreamingQuery:
    """T7. Good and bad rows to two folders, one sub-folder per batch, so a replayed batch overwrites its own output."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        checked = with_errors(batch, casts, required)
        bad = F.size("_errors") > 0
        checked.filter(~bad).drop("_errors").write.mode("overwrite").parquet(f"{ok_path}/batch={batch_id}")
        checked.filter(bad).write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")

    return _writer(rows, checkpoint, continuous).foreachBatch(apply).start()
