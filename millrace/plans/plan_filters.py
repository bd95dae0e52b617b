"""Filters F1-F20."""

from pyspark.sql import functions as F

from millrace.operators import filters as op
from millrace.plans.registry import query

_SHOWN = ["connectorId", "connectorName", "connectorType", "status"]
_SELECT = "SELECT connectorId, connectorName, connectorType, status FROM connectors WHERE "


def now_events():
    return F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")


@query("F1_filter_name", _SELECT + "contains(lower(trim(connectorName)), 'ring')", "connectors")
def f1(t):
    return op.filter_name(t.connectors, " RING ").select(*_SHOWN)


@query("F2_filter_name_regex", _SELECT + "regexp_matches(trim(connectorName), '^(red|small) .*t$', 'i')", "connectors")
def f2(t):
    return op.filter_name(t.connectors, "^(RED|small) .*t$", use_regex=True).select(*_SHOWN)


@query("F2_filter_name_bad_regex", _SELECT.replace("connectorName", "'(' || connectorName AS connectorName", 1) + "contains(lower(trim('(' || connectorName)), '(red')", "connectors")
def f2_bad(t):
    """A pattern that is no regular expression is looked for as it stands."""
    named = t.connectors.withColumn("connectorName", F.concat(F.lit("("), "connectorName"))
    return op.filter_name(named, "(red", use_regex=True).select(*_SHOWN)


@query("F3_filter_field", _SELECT + "size = 42", "connectors")
def f3(t):
    return op.filter_field(t.connectors, "size", 42).select(*_SHOWN)


@query("F3_filter_field_null", _SELECT + "status IS NULL", "connectors")
def f3_null(t):
    return op.filter_field(t.connectors, "status", None).select(*_SHOWN)


@query("F4_filter_type", _SELECT + "contains(lower(connectorType), 'm')", "connectors")
def f4(t):
    return op.filter_type(t.connectors, "M").select(*_SHOWN)


@query("F5_filter_status", _SELECT + "contains(lower(trim(status)), 'active')", "connectors")
def f5(t):
    return op.filter_status(t.connectors, "ACTIVE").select(*_SHOWN)


@query("F5_status_equals", _SELECT + "lower(trim(status)) = 'inactive'", "connectors")
def f5_exact(t):
    return op.status_equals(t.connectors, "Inactive").select(*_SHOWN)


@query("F6_filter_project", _SELECT + "internalID = 'proj-7'", "connectors")
def f6(t):
    return op.filter_project(t.connectors, "proj-7").select(*_SHOWN)


@query("F7_filter_regex", _SELECT + "regexp_matches(CAST(size AS VARCHAR), '^[12]3$')", "connectors")
def f7(t):
    return op.filter_regex(t.connectors, "size", "^[12]3$").select(*_SHOWN)


@query("F7_filter_regex_null", _SELECT + "regexp_matches(coalesce(status, 'null'), 'nu', 'i')", "connectors")
def f7_null(t):
    return op.filter_regex(t.connectors, "status", "NU").select(*_SHOWN)


@query(
    "F8_filter_all",
    _SELECT + "contains(lower(connectorType), 'promo') AND contains(lower(trim(connectorName)), 'red') AND isActive = 1",
    "connectors",
)
def f8(t):
    steps = [
        lambda d: op.filter_type(d, "PROMO"),
        lambda d: op.filter_name(d, "red"),
        lambda d: op.filter_field(d, "isActive", 1),
    ]
    return op.filter_all(t.connectors, steps).select(*_SHOWN)


@query(
    "F9_filter_build",
    _SELECT + "regexp_matches(trim(connectorName), '^[a-r]', 'i') AND contains(lower(connectorType), 'o') "
    "AND contains(lower(trim(status)), 'inactive') AND internalID = 'proj-3'",
    "connectors",
)
def f9(t):
    wanted = op.build_filter(name_pattern="^[A-R]", type="o", status="inactive", project="proj-3", name="")
    return wanted(t.connectors).select(*_SHOWN)


@query("F10_search_connectors", _SELECT + "contains(lower(trim(connectorName)), 'bolt') AND contains(lower(connectorType), 'small')", "connectors")
def f10(t):
    return op.search_connectors(t.connectors, "bolt", name="ignored", type="small").select(*_SHOWN)


@query(
    "F10_search_report",
    "SELECT count(*) FILTER (contains(lower(trim(connectorName)), 'ring')) AS matched, count(*) AS total FROM connectors",
    "connectors",
)
def f10_report(t):
    return op.search_report(t.connectors, op.name_predicate(t.connectors, "ring"))


@query(
    "F11_filter_default_status",
    _SELECT + "lower(coalesce(nullif(status, ''), CASE WHEN deleted THEN 'inactive' ELSE 'active' END)) = 'active'",
    "connectors",
)
def f11(t):
    return op.filter_default_status(t.connectors, "Active").select(*_SHOWN)


@query("F12_filter_flags", _SELECT + "isActive = 1 AND NOT deleted AND connectorType = 'PROMO'", "connectors")
def f12(t):
    return op.filter_flags(t.connectors, isActive=1, deleted=False, connectorType="PROMO", brand=None).select(*_SHOWN)


@query(
    "F13_filter_run_logs",
    """SELECT conv_id AS artifact_id, turn AS run_id, role FROM conversations
       WHERE (conv_id, turn) IN (SELECT conv_id, max(turn) FROM conversations GROUP BY conv_id)""",
)
def f13(t):
    logs = t.conversations.selectExpr("conv_id AS artifact_id", "turn AS run_id", "turn AS logged", "role")
    return op.filter_run_logs(logs, "artifact_id", "run_id", "logged").drop("logged")


@query("F13_filter_run_logs_by_id", "SELECT conv_id AS artifact_id, turn AS run_id, role FROM conversations WHERE turn = 2")
def f13_id(t):
    logs = t.conversations.selectExpr("conv_id AS artifact_id", "turn AS run_id", "role")
    return op.filter_run_logs(logs, "artifact_id", "run_id", "run_id", run_id=2)


@query("F14_filter_failures", "SELECT id, entity, duration FROM runs WHERE status = 'failed'", "runs")
def f14(t):
    return op.filter_failures(t.runs).select("id", "entity", "duration")


@query("F15_filter_since", "SELECT id, entity, status FROM runs WHERE ts >= TIMESTAMP '2024-01-24 00:00:00'", "runs")
def f15(t):
    since = now_events() - F.make_interval(days=F.lit(7))
    return op.filter_since(t.runs, "ts", since).select("id", "entity", "status")


_LAST = "SELECT c_custkey AS user_id, max(o_orderdate) AS last_activity FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"


def last_activity(t):
    last = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.max("o_orderdate").alias("last_activity"))
    return t.users.select("user_id").join(last, "user_id", "left")


@query(
    "F16_filter_inactive",
    f"SELECT user_id FROM ({_LAST}) WHERE last_activity IS NULL OR last_activity < TIMESTAMP '2001-06-01 00:00:00'",
)
def f16(t):
    return op.filter_inactive(last_activity(t), "last_activity", F.lit("2001-06-01 00:00:00").cast("timestamp_ntz")).select("user_id")


@query(
    "F17_filter_recent_active",
    f"SELECT user_id FROM ({_LAST}) WHERE last_activity > TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 30 DAY",
)
def f17(t):
    now = F.lit("2001-08-02 00:00:00").cast("timestamp_ntz")
    return op.filter_recent_active(last_activity(t), "last_activity", now).select("user_id")


@query("F18_filter_error_status", "SELECT event_id, user_id FROM events WHERE event_type = 'error'")
def f18(t):
    return op.filter_error_status(t.events, "event_type").select("event_id", "user_id")


@query("F19_fuzzy_subsequence", _SELECT + "lower(connectorName) LIKE '%r%d%g%t%'", "connectors")
def f19(t):
    return op.filter_fuzzy(t.connectors, "connectorName", "RDgt").select(*_SHOWN)


@query(
    "F20_capability_filter",
    _SELECT + "lower(trim(connectorSubType)) IN ('postgres', 'mysql', 'snowflake')",
    "connectors",
)
def f20(t):
    return op.capability_filter(t.connectors, "connectorSubType").select(*_SHOWN)
