"""Usage roll-ups, lookups and top-k: A12-A18, J1-J8, L6-L9, N5."""

from pyspark.sql import functions as F

from millrace.operators import joins, shape
from millrace.operators import usage as op
from millrace.plans.registry import query

_COUNTERS = """count(f.id) AS total_runs, count(*) FILTER (f.status = 'success') AS successful_runs,
  count(*) FILTER (f.status = 'failed') AS failed_runs, CAST(coalesce(sum(CAST(f.cost AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_cost,
  strftime(max(f.ts), '%Y-%m-%d') AS last_activity"""
_JOINED = "FROM users u LEFT JOIN facts f ON f.user_id = u.user_id"


def plain(df):
    """Counters in types both engines print alike."""
    return df.withColumn("total_cost", F.col("total_cost").cast("double")).withColumn(
        "last_activity", F.date_format("last_activity", "yyyy-MM-dd")
    )


def user_usage(t):
    return op.usage_by_user(t.facts, t.users, "user_id")


@query("A12_usage_rollup_user", f"SELECT u.user_id, u.user_name, u.project_id, {_COUNTERS} {_JOINED} GROUP BY ALL", "users facts")
def a12(t):
    return plain(user_usage(t))


_GROUPED = f"{_COUNTERS}, count(DISTINCT u.user_id) AS total_users, count(DISTINCT f.user_id) AS active_users"


@query("A13_usage_rollup_project", f"SELECT u.project_id, {_GROUPED} {_JOINED} GROUP BY u.project_id", "users facts")
def a13(t):
    return plain(op.usage_by_group(user_usage(t), "project_id"))


def by_institution(t):
    places = t.nation.select(F.col("n_nationkey").alias("project_id"), F.col("n_regionkey").alias("institution_id"))
    return user_usage(t).join(places, "project_id")


@query(
    "A14_usage_rollup_institution",
    f"SELECT n_regionkey AS institution_id, {_GROUPED} {_JOINED} JOIN nation ON n_nationkey = u.project_id GROUP BY n_regionkey",
    "users facts",
)
def a14(t):
    return plain(op.usage_by_group(by_institution(t), "institution_id"))


@query(
    "A14_usage_levels",
    f"""SELECT n_regionkey AS institution_id, u.project_id, u.user_id, {_COUNTERS}, count(DISTINCT u.user_id) AS total_users,
        CAST(3 - grouping(n_regionkey) - grouping(u.project_id) - grouping(u.user_id) AS INTEGER) AS level
        {_JOINED} JOIN nation ON n_nationkey = u.project_id GROUP BY ROLLUP (n_regionkey, u.project_id, u.user_id)""",
    "users facts",
)
def a14_levels(t):
    return plain(op.usage_levels(by_institution(t), "institution_id", "project_id", "user_id"))


@query(
    "A15_usage_totals",
    "SELECT count(*) AS total_total_runs, CAST(sum(CAST(cost AS DECIMAL(18,2))) AS DOUBLE) AS total_total_cost FROM facts",
    "facts",
)
def a15(t):
    totals = op.usage_totals(user_usage(t), "total_runs", "total_cost")
    return totals.withColumn("total_total_cost", F.col("total_total_cost").cast("double"))


@query(
    "A16_avg_per_active",
    """SELECT count(*) AS active, round(avg(n), 2) AS avg_metric FROM
       (SELECT user_id, count(*) AS n FROM facts GROUP BY user_id HAVING max(ts) > TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 30 DAY)""",
    "facts",
)
def a16(t):
    return op.avg_per_active(user_usage(t), "last_activity", "total_runs", F.lit("2001-08-02 00:00:00").cast("timestamp_ntz"))


@query(
    "A17_daily_revenue",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, count(*) AS order_count,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders
       WHERE o_orderdate >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 30 DAY GROUP BY 1""",
)
def a17(t):
    daily = op.daily_revenue(t.orders, "o_orderdate", "o_totalprice", F.lit("2001-08-02 00:00:00").cast("timestamp_ntz"))
    return daily.select(F.date_format("order_date", "yyyy-MM-dd").alias("order_date"), "order_count", F.col("revenue").cast("double").alias("revenue"))


@query(
    "A18_project_stats",
    """SELECT n_nationkey AS project_id, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers,
       (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers,
       (SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey = n_nationkey) AS orders FROM nation""",
)
def a18(t):
    key = lambda c: F.col(c).alias("project_id")
    per_user = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("n"))
    owned = per_user.join(t.users.select("user_id", "project_id"), "user_id").select("project_id", "n")
    facts = {"customers": t.customer.select(key("c_nationkey")), "suppliers": t.supplier.select(key("s_nationkey")), "orders": owned}
    return op.project_stats(t.nation.select(key("n_nationkey")), "project_id", facts)


@query(
    "N5_growth_over_time",
    """, d AS (SELECT entity, CAST(ts AS DATE) AS day, CAST(sum(duration) AS BIGINT) AS amount FROM runs GROUP BY 1, 2)
       SELECT entity, strftime(day, '%Y-%m-%d') AS day, amount, amount - lag(amount) OVER w AS change,
       CAST(sum(amount) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_total FROM d WINDOW w AS (PARTITION BY entity ORDER BY day)""",
    "runs",
)
def n5(t):
    return op.growth_over_time(t.runs, ["entity"], "ts", F.col("duration")).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


# ---- lookups -------------------------------------------------------------------------------------------------------


@query(
    "J1_enrich_usage",
    """SELECT s.s_suppkey AS usage_id, CAST(s_nationkey AS BIGINT) AS projectId, p.internalId AS projectInternalId
       FROM supplier s LEFT JOIN projects p ON p.id = s.s_nationkey AND p.id <> 0""",
    "projects",
)
def j1(t):
    usage = t.supplier.select(F.col("s_suppkey").alias("usage_id"), F.col("s_nationkey").cast("bigint").alias("projectId"))
    return joins.enrich_usage(usage, t.projects)


_MIXED = """(SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN CAST(c_nationkey AS VARCHAR) WHEN 1 THEN 'prj-nation_' || CAST(c_nationkey AS VARCHAR)
  ELSE CAST(c_custkey AS VARCHAR) END AS id FROM customer)"""


def mixed_ids(t):
    text = F.col("c_nationkey").cast("string")
    third = F.col("c_custkey") % 3
    mixed = F.when(third == 0, text).when(third == 1, F.concat(F.lit("prj-nation_"), text)).otherwise(F.col("c_custkey").cast("string"))
    return t.customer.select("c_custkey", mixed.alias("id"))


@query(
    "J2_resolve_ids",
    f"""SELECT c_custkey, m.id, coalesce(p.internalId, m.id) AS resolved FROM {_MIXED} m
        LEFT JOIN projects p ON p.id = TRY_CAST(m.id AS BIGINT) AND p.id <> 0""",
    "projects",
)
def j2(t):
    return joins.resolve_ids(mixed_ids(t), t.projects)


@query(
    "J3_validate_ids",
    f"SELECT c_custkey, m.id, m.id IN (SELECT internalId FROM projects) OR m.id IN (SELECT CAST(id AS VARCHAR) FROM projects) AS valid FROM {_MIXED} m",
    "projects",
)
def j3(t):
    return joins.validate_ids(mixed_ids(t), t.projects)


@query(
    "J4_connector_usage",
    """SELECT connector, role, count(*) AS uses FROM (
         SELECT l_partkey AS connector, 'Source' AS role FROM lineitem UNION ALL
         SELECT l_suppkey, 'Target' FROM lineitem WHERE l_suppkey <> l_partkey)
       WHERE connector IN (SELECT p_partkey FROM part) GROUP BY ALL""",
)
def j4(t):
    uses = joins.connector_usage(
        t.lineitem.select("l_partkey", "l_suppkey"),
        t.part.select(F.col("p_partkey").alias("connector")),
        source="l_partkey",
        target="l_suppkey",
        connector="connector",
    )
    return uses.groupBy("connector", "role").agg(F.count("*").alias("uses"))


def _asked(t):
    """Ids that events refer to; some are customers and some are not."""
    return t.events.select((F.col("user_id") * 13).alias("c_custkey"))


@query("J6_bulk_get", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id * 13 FROM events)")
def j6(t):
    return joins.bulk_get(t.customer, _asked(t), "c_custkey")[0].select("c_custkey", "c_name")


@query("J6_bulk_get_missing", "SELECT DISTINCT user_id * 13 AS c_custkey FROM events WHERE user_id * 13 NOT IN (SELECT c_custkey FROM customer)")
def j6_missing(t):
    return joins.bulk_get(t.customer, _asked(t), "c_custkey")[1]


@query(
    "J8_failure_with_name",
    """SELECT entity, user_name, count(*) AS failures FROM runs LEFT JOIN users ON user_id = entity
       WHERE status = 'failed' GROUP BY ALL""",
    "runs users",
)
def j8(t):
    names = t.users.select(F.col("user_id").alias("entity"), "user_name")
    return joins.failure_with_name(t.runs, names, entity="entity", name="user_name")


# ---- top k ---------------------------------------------------------------------------------------------------------


@query("L6_top_k_users", "SELECT user_id, count(*) AS total_runs FROM facts GROUP BY user_id ORDER BY total_runs DESC, user_id LIMIT 5", "facts")
def l6(t):
    return shape.top_k(user_usage(t), "total_runs", 5, "user_id").select("user_id", "total_runs")


_PROJECT_COST = """SELECT u.project_id, CAST(sum(CAST(f.cost AS DECIMAL(18,2))) AS DOUBLE) AS total_cost FROM users u
  JOIN facts f ON f.user_id = u.user_id GROUP BY u.project_id ORDER BY total_cost DESC, project_id"""


@query("L8_top_k_projects", f"{_PROJECT_COST} LIMIT 10", "users facts")
def l8(t):
    top = shape.top_k(op.usage_by_group(user_usage(t), "project_id"), "total_cost", 10, "project_id")
    return plain(top).select("project_id", "total_cost")


@query("L9_most_active", f"{_PROJECT_COST} LIMIT 1", "users facts")
def l9(t):
    top = shape.top_k(op.usage_by_group(user_usage(t), "project_id"), "total_cost", 1, "project_id")
    return plain(top).select("project_id", "total_cost")
