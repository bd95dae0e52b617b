"""Column shapes, paging, sorting, set operations: P1-P7, L1-L12, U1-U3."""

from pyspark.sql import functions as F

from millrace.operators import shape as op
from millrace.plans.registry import query


def nested(t):
    """Events as nested rows: a user struct with a role struct, and an array of structs."""
    role = F.struct(F.col("event_type").alias("title"), (F.col("user_id") % 5).alias("level"))
    user = F.struct(F.col("user_id").alias("id"), role.alias("role"))
    points = F.array(F.struct(F.col("value").alias("v"), F.lit("a").alias("tag")), F.struct((F.col("value") * 2).alias("v"), F.lit("b").alias("tag")))
    return t.events.select("event_id", user.alias("user"), points.alias("points"))


@query("P1_select_fields", "SELECT o_orderstatus, o_orderkey FROM orders")
def p1(t):
    return op.select_fields(t.orders, "o_orderstatus, missing, o_orderkey")


@query(
    "P2_select_nested_fields",
    """SELECT user_id AS id, user_id % 5 AS level, event_id,
       CAST(value AS DOUBLE) AS v1, value * 2 AS v2 FROM events""",
)
def p2(t):
    kept = op.select_nested_fields(nested(t), "user.role.level,user.id,points.v,event_id,user.none")
    return kept.select(F.col("user.id").alias("id"), F.col("user.role.level").alias("level"), "event_id", F.col("points")[0]["v"].alias("v1"), F.col("points")[1]["v"].alias("v2"))


@query(
    "P3_flatten_struct",
    'SELECT event_id, user_id AS "user.id", event_type AS "user.role.title", user_id % 5 AS "user.role.level" FROM events',
)
def p3(t):
    return op.flatten_struct(nested(t)).drop("points")


@query("P4_reorder_drop", "SELECT internalId, projectName, institutionId FROM projects", "projects")
def p4(t):
    return op.reorder_drop(t.projects, "internalId", "id")


@query(
    "P5_record_to_rows",
    """SELECT c_custkey, 'c_acctbal' AS "Metric", coalesce(c_acctbal, 0) AS "Count" FROM customer
       UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer""",
)
def p5(t):
    return op.record_to_rows(t.customer, ["c_custkey"], ["c_acctbal", "c_nationkey"])


_DIFF = """, j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_orderkey IS NULL AS added, b.o_orderkey IS NULL AS removed,
           a.o_totalprice AS p1, b.o_totalprice AS p2, a.o_custkey AS c1, b.o_custkey AS c2
         FROM orders_v1 a FULL JOIN orders_v2 b ON a.o_orderkey = b.o_orderkey)
       SELECT o_orderkey, 'o_custkey' AS field, CAST(c1 AS VARCHAR) AS old, CAST(c2 AS VARCHAR) AS new,
         CASE WHEN added THEN 'added' WHEN removed THEN 'removed' ELSE 'changed' END AS status FROM j WHERE c1 IS DISTINCT FROM c2 OR added OR removed
       UNION ALL SELECT o_orderkey, 'o_totalprice', CAST(CAST(p1 AS DECIMAL(18,2)) AS VARCHAR), CAST(CAST(p2 AS DECIMAL(18,2)) AS VARCHAR),
         CASE WHEN added THEN 'added' WHEN removed THEN 'removed' ELSE 'changed' END FROM j WHERE p1 IS DISTINCT FROM p2 OR added OR removed"""


@query(
    "P7_config_diff",
    _DIFF,
    "orders_v1 orders_v2",
)
def p7(t):
    exact = lambda d: d.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return op.table_diff(exact(t.orders_v1), exact(t.orders_v2), ["o_orderkey"], ["o_custkey", "o_totalprice"])


@query("P7_diff_by_digest", _DIFF, "orders_v1 orders_v2")
def p7_digest(t):
    exact = lambda d: d.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return op.table_diff_by_digest(exact(t.orders_v1), exact(t.orders_v2), ["o_orderkey"], ["o_custkey", "o_totalprice"])


@query("L1_limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def l1(t):
    return op.limit_rows(t.orders, 25, [F.col("o_totalprice").desc(), "o_orderkey"], "o_orderkey,o_totalprice")


@query("L2_page_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20 OFFSET 40")
def l2(t):
    return op.page_rows(t.orders, ["o_orderdate", "o_orderkey"], 40, 20, "o_orderkey,o_custkey")


@query("L2_deep_page", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber LIMIT 20 OFFSET (SELECT count(*) - 40 FROM lineitem)")
def l2_deep(t):
    near_the_end = t.lineitem.count() - 40
    return op.page_rows(t.lineitem, ["l_shipdate", "l_orderkey", "l_linenumber"], near_the_end, 20, "l_orderkey,l_linenumber,l_shipdate", most=1000)


@query("L2_deep_page_by_text", "SELECT doc_id, lang FROM documents ORDER BY text NULLS FIRST, doc_id LIMIT 20 OFFSET (SELECT count(*) // 2 FROM documents)")
def l2_deep_text(t):
    return op.page_rows(t.documents, ["text", "doc_id"], t.documents.count() // 2, 20, "doc_id,lang", most=100)


@query("L2_page_after", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 20")
def l2_after(t):
    return op.page_after(t.orders, "o_orderkey", 500, 20).select("o_orderkey", "o_custkey")


@query("L4_sort_two_keys", "SELECT p_type, p_name, p_partkey FROM part ORDER BY p_type, p_name, p_partkey")
def l4(t):
    return op.sort_two_keys(t.part.select("p_type", "p_name", "p_partkey"), "p_type", "p_name", "p_partkey")


@query("L5_sort_option", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def l5(t):
    return op.sort_option(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "desc", "c_custkey")


@query(
    "L12_top_per_group_with_rest",
    """SELECT o_orderstatus, o_orderkey, rank, greatest(n - 5, 0) AS more FROM (
         SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS rank,
                count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) WHERE rank <= 5""",
)
def l12(t):
    best = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    top = op.top_per_group_with_rest(t.orders, ["o_orderstatus"], best, 5)
    return top.select("o_orderstatus", "o_orderkey", F.col("rank").cast("bigint").alias("rank"), "more")


@query(
    "U1_union_sources",
    """SELECT 'c' AS kind, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT 's', s_nationkey, s_acctbal, NULL FROM supplier""",
)
def u1(t):
    customers = t.customer.select(F.lit("c").alias("kind"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(F.lit("s").alias("kind"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return op.union_sources(customers, suppliers)


@query("U2_distinct_ids", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def u2(t):
    return op.distinct_ids(t.events, "user_id", "event_id")


_ADDED = """SELECT o_orderkey, 'added' AS status FROM orders_v2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v1)
       UNION ALL SELECT o_orderkey, 'removed' FROM orders_v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v2)"""


@query(
    "U3_added_removed",
    _ADDED,
    "orders_v1 orders_v2",
)
def u3(t):
    return op.added_removed(t.orders_v1, t.orders_v2, ["o_orderkey"])


@query("U3_added_removed_by_digest", _ADDED, "orders_v1 orders_v2")
def u3_digest(t):
    return op.added_removed_by_digest(t.orders_v1, t.orders_v2, ["o_orderkey"])
