"""Streaming operators T1-T7: each streams files written from the given tables and returns the final table."""

from pyspark.sql import functions as F

from millrace.operators.ingest import ingest_cdc, live_rows
from millrace.operators.runs import failure_alerts
from millrace.plans.plan_columns import _DIRTY, dirty
from millrace.plans.plan_ingest import _TARGET, _V2, order_changes
from millrace.plans.plan_runs import _RANKED
from millrace.plans.registry import query
from millrace.session import work_path
from millrace.sources.store import KeyedTable
from millrace.streaming import streams as op


def landed(t, df, name, files=4, order=None):
    """Write rows as several files and open them as a stream of small batches."""
    path = work_path(t.spark, name)
    (df.repartitionByRange(files, order) if order else df.repartition(files)).write.parquet(path)
    return op.read_files(t.spark, path, df.schema, files_per_batch=2)


def checkpoint(t):
    return work_path(t.spark, "checkpoint")


@query("T1_stream_cdc_apply", _V2, "orders_v2")
def t1(t):
    store = KeyedTable(t.spark, work_path(t.spark, "cdc"), ["o_orderkey"], buckets=4)
    ingest_cdc(store, t.orders_v1.select(*_TARGET, F.lit("I").alias("op"), F.lit(0).cast("bigint").alias("seq")), "op", "seq")
    stream = landed(t, order_changes(t), "changes")
    op.stream_cdc_apply(stream, store, "op", "seq", checkpoint(t)).awaitTermination()
    return live_rows(store.read(), "op", "seq")


@query("T2_stream_append", "SELECT event_id, user_id, event_type FROM events")
def t2(t):
    path = work_path(t.spark, "appended")
    stream = landed(t, t.events.select("event_id", "user_id", "event_type"), "arrivals")
    op.stream_append(stream, path, checkpoint(t), ["event_type"]).awaitTermination()
    return t.spark.read.parquet(path).select("event_id", "user_id", "event_type")


@query("T3_stream_dedup", "SELECT event_id, user_id, value FROM events")
def t3(t):
    rows = t.events.select("event_id", "user_id", "value", "ts")
    twice = rows.unionByName(rows.filter(F.col("event_id") % 3 == 0))
    path = work_path(t.spark, "deduped")
    stream = op.stream_dedup(landed(t, twice, "deliveries", order="ts"), ["event_id"], "ts", "60 days")
    op.stream_append(stream, path, checkpoint(t)).awaitTermination()
    return t.spark.read.parquet(path).select("event_id", "user_id", "value")


@query("T4_stream_log_tail", "SELECT conv_id, turn, role FROM conversations ORDER BY turn DESC, conv_id DESC LIMIT 20")
def t4(t):
    path = work_path(t.spark, "log")
    stream = landed(t, t.conversations.select("conv_id", "turn", "role"), "lines")
    op.stream_log_tail(stream, path, checkpoint(t)).awaitTermination()
    return op.log_tail(t.spark.read.schema("conv_id bigint, turn bigint, role string").parquet(path), "turn", "conv_id", 20)


@query("T4_log_by_day", "SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def t4_by_day(t):
    path, logs = work_path(t.spark, "log_by_day"), t.events.select("event_id", "event_type", "ts")
    op.stream_log_by_day(landed(t, logs, "events"), path, checkpoint(t), "ts").awaitTermination()
    last = op.newest_logged(t.spark, path, logs.schema, "ts", "event_id", 20)
    return last.select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "T5_stream_health",
    """SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS window_start, entity, count(*) AS runs,
       count(*) FILTER (status = 'success') AS success FROM runs GROUP BY 1, 2""",
    "runs",
)
def t5(t):
    store = KeyedTable(t.spark, work_path(t.spark, "health"), ["window_start", "entity"], buckets=4)
    stream = landed(t, t.runs, "runs", order="ts")
    op.stream_health(stream, store, "entity", "ts", "1 day", "40 days", checkpoint(t)).awaitTermination()
    return store.read().withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query(
    "T5_stream_health_null_entity",
    """, r AS (SELECT ts, status, CASE WHEN entity % 3 <> 0 THEN entity END AS entity FROM runs)
       SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS window_start, entity, count(*) AS runs,
       count(*) FILTER (status = 'success') AS success FROM r GROUP BY 1, 2""",
    "runs",
)
def t5_null(t):
    """A third of the runs have no entity; their windows are one row each, however many batches touch them."""
    store = KeyedTable(t.spark, work_path(t.spark, "health_null"), ["window_start", "entity"], buckets=4)
    runs = t.runs.withColumn("entity", F.when(F.col("entity") % 3 != 0, F.col("entity")))
    stream = landed(t, runs, "runs_null", order="ts")
    op.stream_health(stream, store, "entity", "ts", "1 day", "40 days", checkpoint(t)).awaitTermination()
    return store.read().withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query(
    "T6_stream_alerts",
    f""", {_RANKED} SELECT entity, count(*) AS failures, string_agg(strftime(ts, '%Y-%m-%d %H:%M:%S') || ': ' ||
        coalesce(error_message, 'Unknown error'), ' | ' ORDER BY rank) AS lines
        FROM ranked WHERE rank <= 5 AND status = 'failed' GROUP BY entity""",
    "runs",
)
def t6(t):
    path = work_path(t.spark, "recent")
    stream = landed(t, t.runs, "runs")
    op.stream_alerts(stream, path, "entity", "ts", "id", checkpoint(t)).awaitTermination()
    alerts = failure_alerts(op.last_runs(t.spark, path, "entity"), "entity", "ts", "id", "error_message")
    return alerts.withColumn("lines", F.array_join("lines", " | "))


@query(
    "T7_stream_quarantine",
    f"""WITH {_DIRTY} SELECT c_custkey, coalesce(regexp_matches(trim(number), '^[+-]?[0-9]+$'), false) AS ok FROM dirty""",
)
def t7(t):
    ok, bad = work_path(t.spark, "ok"), work_path(t.spark, "bad")
    stream = landed(t, dirty(t), "rows")
    op.stream_quarantine(stream, {"number": "bigint"}, ["number"], ok, bad, checkpoint(t)).awaitTermination()
    good = t.spark.read.parquet(ok).select("c_custkey", F.lit(True).alias("ok"))
    return good.unionByName(t.spark.read.parquet(bad).select("c_custkey", F.lit(False).alias("ok")))
