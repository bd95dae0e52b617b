"""Run history: A1-A11, N1-N4, L7."""

from pyspark.sql import functions as F

from millrace.operators import runs as op
from millrace.operators import shape
from millrace.plans.registry import query

_RANKED = "ranked AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ts DESC, id DESC) AS rank FROM runs)"


@query("A1_count_only", "SELECT count(*) AS count FROM lineitem")
def a1(t):
    return op.count_only(t.lineitem)


@query(
    "A2_summary_sample",
    "SELECT count(*) AS total, (SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_totalprice DESC, o_orderkey) FROM "
    "(SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3)) AS sample FROM orders",
)
def a2(t):
    summary = op.summary_sample(t.orders, [F.col("o_totalprice").desc(), "o_orderkey"], ["o_orderkey"])
    return summary.select("total", F.array_join(F.col("sample.o_orderkey").cast("array<string>"), ",").alias("sample"))


@query("A3_count_by_status", "SELECT status, count(*) AS count FROM runs GROUP BY status", "runs")
def a3(t):
    return op.count_by_status(t.runs)


_RATE = "count(*) AS total, count(*) FILTER (status = 'success') AS success, floor(count(*) FILTER (status = 'success') * 10000 / count(*)) / 100 AS rate"


@query("A4_success_rate", f"SELECT entity, {_RATE} FROM runs GROUP BY entity", "runs")
def a4(t):
    return op.success_rate(t.runs, "entity")


_STATS = (
    "CAST(sum(duration) AS DOUBLE) / count(*) AS avg_duration, min(duration) AS min_duration, max(duration) AS max_duration"
)


@query("A5_duration_stats", f"SELECT entity, {_STATS} FROM runs GROUP BY entity", "runs")
def a5(t):
    return op.duration_stats(t.runs, "duration", "entity")


@query("A6_duration_total", "SELECT CAST(sum(duration) AS BIGINT) AS total_duration FROM runs", "runs")
def a6(t):
    return op.duration_total(t.runs, "duration")


@query(
    "A7_error_patterns",
    "SELECT error_message, count(*) AS count FROM runs WHERE error_message IS NOT NULL GROUP BY error_message",
    "runs",
)
def a7(t):
    return op.error_patterns(t.runs, "error_message")


@query(
    "A8_run_stats_by_entity",
    """SELECT entity, count(*) AS total_runs, count(*) FILTER (status = 'success') AS success_count,
       count(*) FILTER (status = 'failed') AS failure_count, count(*) FILTER (status = 'success') * 100 / count(*) AS success_rate
       FROM runs GROUP BY entity""",
    "runs",
)
def a8(t):
    return op.run_stats(t.runs, "entity")


@query(
    "A9_state_counts",
    """SELECT connectorType, count(*) AS total, count(*) FILTER (status = 'active') AS active,
       count(*) FILTER (status = 'running') AS running FROM connectors GROUP BY connectorType""",
    "connectors",
)
def a9(t):
    return op.state_counts(t.connectors, "connectorType")


_HEALTH = """SELECT entity, success, total, CASE WHEN success = total THEN 'HEALTHY' WHEN success = 0 THEN 'FAILING' ELSE 'DEGRADED' END AS health
  FROM (SELECT u.entity, count(r.id) FILTER (r.status = 'success') AS success, count(r.id) AS total FROM
    (SELECT c_custkey AS entity FROM customer) u LEFT JOIN (SELECT * FROM ranked WHERE rank <= 5) r ON r.entity = u.entity GROUP BY u.entity)"""


@query("A10_health_status", f", {_RANKED} {_HEALTH}", "runs")
def a10(t):
    entities = t.customer.select(F.col("c_custkey").alias("entity"))
    return op.health_status(t.runs, "entity", "ts", "id", 5, entities)


@query(
    "A11_failure_alerts",
    f""", {_RANKED} SELECT entity, count(*) AS failures, string_agg(strftime(ts, '%Y-%m-%d %H:%M:%S') || ': ' ||
        coalesce(error_message, 'Unknown error'), ' | ' ORDER BY rank) AS lines
        FROM ranked WHERE rank <= 5 AND status = 'failed' GROUP BY entity""",
    "runs",
)
def a11(t):
    alerts = op.failure_alerts(t.runs, "entity", "ts", "id", "error_message")
    return alerts.withColumn("lines", F.array_join("lines", " | "))


@query(
    "N1_recent_vs_previous",
    f""", {_RANKED} SELECT entity, CAST(sum(duration) FILTER (rank <= 10) AS DOUBLE) / nullif(count(*) FILTER (rank <= 10), 0) AS recent_avg,
        CAST(sum(duration) FILTER (rank > 10) AS DOUBLE) / nullif(count(*) FILTER (rank > 10), 0) AS previous_avg
        FROM ranked WHERE rank <= 20 GROUP BY entity""",
    "runs",
)
def n1(t):
    return op.recent_vs_previous(t.runs, "entity", "ts", "id", "duration")


@query("N2_last_n_runs", f", {_RANKED} SELECT entity, id, status, rank FROM ranked WHERE rank <= 10", "runs")
def n2(t):
    return op.last_n_runs(t.runs, "entity", "ts", "id", 10).select("entity", "id", "status", F.col("rank").cast("bigint").alias("rank"))


@query(
    "N3_latest_run",
    f""", {_RANKED} SELECT u.entity, coalesce(r.status, 'never run') AS last_status
        FROM (SELECT c_custkey AS entity FROM customer) u LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) r ON r.entity = u.entity""",
    "runs",
)
def n3(t):
    return op.latest_run(t.customer.select(F.col("c_custkey").alias("entity")), t.runs, "entity", "ts", "id")


@query(
    "N4_slowest_run",
    """SELECT entity, id, duration FROM runs
       QUALIFY row_number() OVER (PARTITION BY entity ORDER BY duration DESC NULLS LAST, ts DESC, id DESC) = 1""",
    "runs",
)
def n4(t):
    return op.slowest_run(t.runs, "entity", "ts", "id", "duration").select("entity", "id", "duration")


@query("L7_top_k_slowest", "SELECT id, duration, status FROM runs ORDER BY duration DESC NULLS LAST, ts, id LIMIT 5", "runs")
def l7(t):
    return shape.top_k_slowest(t.runs, "duration", 5, "ts", "id").select("id", "duration", "status")
