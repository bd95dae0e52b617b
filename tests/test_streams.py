"""Streams drained to the end give the batch answer, also when split into many batches or run again."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.operators.runs import failure_alerts
from millrace.sources.store import KeyedTable
from millrace.streaming import streams as op

RUNS = "id int, entity string, ts timestamp_ntz, status string, error_message string"


def runs(spark, n, first=0):
    start = datetime(2024, 1, 1)
    rows = [
        (i, "hot" if i % 3 else f"e{i % 4}", start + timedelta(minutes=(i * 37) % 500), "failed" if i % 5 == 0 else "success", None if i % 2 else "boom")
        for i in range(first, first + n)
    ]
    return spark.createDataFrame(rows, RUNS)


def land(df, path, files):
    df.repartition(files).write.mode("append").parquet(path)


def test_alerts_over_two_runs_of_the_stream(spark, folder):
    """State goes on where the stream stopped, and what a batch wrote is never written again."""
    path, wanted = f"{folder}/recent", failure_alerts(runs(spark, 120), "entity", "ts", "id", "error_message")
    times = {}
    for first in (0, 60, 0):  # the last runs come a second time
        land(runs(spark, 60, first), f"{folder}/in", 3)
        stream = op.read_files(spark, f"{folder}/in", RUNS, files_per_batch=1)
        op.stream_alerts(stream, path, "entity", "ts", "id", f"{folder}/check").awaitTermination()
        at = {f: os.path.getmtime(f"{path.removeprefix('file:')}/{f}") for f in os.listdir(path.removeprefix("file:"))}
        assert all(at[f] == t for f, t in times.items())
        times = at
    kept = op.last_runs(spark, path, "entity")
    found = failure_alerts(kept, "entity", "ts", "id", "error_message")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert kept.groupBy("entity").count().agg(F.max("count")).head()[0] == 5


def test_a_task_passes_on_few_runs_of_many_rows(spark, folder):
    """Runs are picked over many Arrow batches before they are shuffled; rows without a time or an entity are kept apart."""
    start = F.lit(datetime(2024, 1, 1))
    rows = spark.range(30_000, numPartitions=1).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("e"), F.col("id") % 40)).alias("entity"),
        F.when(F.col("id") % 11 != 0, F.timestamp_add("MINUTE", (F.col("id") * 37 % 500).cast("int"), start)).cast("timestamp_ntz").alias("ts"),
        F.lit("failed").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )
    batches = rows.toArrow().combine_chunks().to_batches(max_chunksize=1000)
    passed = list(op._few("entity", "ts", "id", 5)(iter(batches)))
    assert len(batches) == 30 and sum(b.num_rows for b in passed) == 41 * 5
    land(rows, f"{folder}/in", 2)
    stream = op.read_files(spark, f"{folder}/in", rows.schema, files_per_batch=1)
    op.stream_alerts(stream, f"{folder}/recent", "entity", "ts", "id", f"{folder}/check").awaitTermination()
    wanted = failure_alerts(rows, "entity", "ts", "id", "error_message")
    found = failure_alerts(op.last_runs(spark, f"{folder}/recent", "entity"), "entity", "ts", "id", "error_message")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)


def test_cdc_stream_replayed_from_scratch_changes_nothing(spark, folder):
    schema = "k int, v string, op string, seq int"
    land(spark.createDataFrame([(i % 7, f"v{i}", "D" if i % 6 == 0 else "U", i) for i in range(50)], schema), f"{folder}/in", 4)
    store = KeyedTable(spark, f"{folder}/t", ["k"], buckets=2)
    tables = []
    for attempt in range(2):
        stream = op.read_files(spark, f"{folder}/in", schema, files_per_batch=1)
        op.stream_cdc_apply(stream, store, "op", "seq", f"{folder}/check{attempt}").awaitTermination()
        tables.append(sorted(map(tuple, store.read().collect())))
    assert tables[0] == tables[1] and [r[3] for r in tables[0]] == [49, 43, 44, 45, 46, 47, 48]


def test_dedup_with_a_key_that_floods_the_stream(spark, folder):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts")
    )
    land(rows, f"{folder}/in", 3)
    stream = op.stream_dedup(op.read_files(spark, f"{folder}/in", rows.schema, 1), ["k"], "ts", "1 hour")
    op.stream_append(stream, f"{folder}/out", f"{folder}/check").awaitTermination()
    back = spark.read.parquet(f"{folder}/out")
    assert back.count() == 2001 and back.select("k").distinct().count() == 2001


def test_quarantine_and_tail(spark, folder):
    rows = spark.createDataFrame([(i, str(i) if i % 4 else "x") for i in range(20)], "id int, n string")
    land(rows, f"{folder}/in", 2)
    stream = op.read_files(spark, f"{folder}/in", rows.schema, 1)
    op.stream_quarantine(stream, {"n": "int"}, [], f"{folder}/ok", f"{folder}/bad", f"{folder}/check").awaitTermination()
    assert spark.read.parquet(f"{folder}/ok").count() == 15
    assert {r._errors[0] for r in spark.read.parquet(f"{folder}/bad").collect()} == {"n is not int: x"}
    assert [r.id for r in op.log_tail(rows, "id", "id", 3).collect()] == [19, 18, 17]


def test_newest_lines_leave_old_days_closed(spark, folder):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(hours=5 * i)) for i in range(40)] + [(90, None), (91, start)]
    logs = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    land(logs, f"{folder}/in", 3)
    path = f"{folder}/log"

    def tail(n):
        return [r.id for r in op.newest_logged(spark, path, logs.schema, "ts", "id", n).collect()]

    assert tail(3) == []
    for _ in range(2):  # the second run finds nothing new
        stream = op.read_files(spark, f"{folder}/in", logs.schema)
        op.stream_log_by_day(stream, path, f"{folder}/check", "ts").awaitTermination()
    assert tail(60) == [*range(39, 0, -1), 91, 0, 90]
    for day in ("2024-01-01", "2024-01-02", "__HIVE_DEFAULT_PARTITION__"):  # files that cannot be read
        for name in os.listdir(f"{path}/log_day={day}"):
            with open(f"{path}/log_day={day}/{name}", "wb") as f:
                f.write(b"broken")
    assert tail(12) == list(range(39, 27, -1))
