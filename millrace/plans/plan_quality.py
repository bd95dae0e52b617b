"""Data quality D1-D7."""

from pyspark.sql import functions as F

from millrace.operators import quality as op
from millrace.plans.plan_columns import _DIRTY, dirty
from millrace.plans.registry import query


@query(
    "D1_null_check",
    f"WITH {_DIRTY} SELECT count(*) AS total_rows, count(*) - count(flag) AS null_flag, count(*) - count(number) AS null_number FROM dirty",
)
def d1(t):
    return op.null_check(dirty(t), ["flag", "number"])


@query("D2_find_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def d2(t):
    return op.find_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "D3_freshness",
    """SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_update,
       CAST(floor(epoch(TIMESTAMP '2024-01-31 00:00:00' - max(ts)) / 3600) AS BIGINT) AS hours_since_update FROM events""",
)
def d3(t):
    fresh = op.freshness(t.events, "ts", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))
    return fresh.withColumn("last_update", F.date_format("last_update", "yyyy-MM-dd HH:mm:ss"))


@query(
    "D4_validate_rules",
    """SELECT o_orderkey, 'o_totalprice' AS field, 'price too high' AS message, 'error' AS severity FROM orders WHERE o_totalprice > 400000
       UNION ALL SELECT o_orderkey, 'o_orderpriority', 'not specified', 'warning' FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
       UNION ALL SELECT o_orderkey, 'o_orderdate', 'open order in the past', 'error' FROM orders
         WHERE o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1996-01-01 00:00:00'""",
)
def d4(t):
    return op.validate_rules(t.orders, ["o_orderkey"], order_rules())


def order_rules():
    old = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    return [
        op.Rule("o_totalprice", "price too high", F.col("o_totalprice") > 400000),
        op.Rule("o_orderpriority", "not specified", F.col("o_orderpriority") == "4-NOT SPECIFIED", "warning"),
        op.Rule("o_orderdate", "open order in the past", (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < old)),
    ]


@query(
    "D4_valid_rows",
    """SELECT NOT (o_totalprice > 400000 OR (o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1996-01-01 00:00:00')) AS valid,
       count(*) AS orders FROM orders GROUP BY 1""",
)
def d4_valid(t):
    return op.mark_valid(t.orders, order_rules()).groupBy("valid").agg(F.count("*").alias("orders"))


_D5 = "(SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'ab' WHEN 2 THEN repeat('x', 101) ELSE c_name END AS name, c_nationkey AS a, c_custkey % 30 AS b FROM customer)"


@query(
    "D5_required_length_rules",
    f"""SELECT c_custkey, 'name' AS field, 'Name is required' AS message, 'error' AS severity FROM {_D5} WHERE name = ''
        UNION ALL SELECT c_custkey, 'name', 'Name must be at least 3 characters', 'error' FROM {_D5} WHERE name = 'ab'
        UNION ALL SELECT c_custkey, 'name', 'Name must be less than 100 characters', 'error' FROM {_D5} WHERE length(name) > 100
        UNION ALL SELECT c_custkey, 'a, b', 'Source and target are the same', 'warning' FROM {_D5} WHERE a = b
        UNION ALL SELECT c_custkey, 'b', 'Target not found or inaccessible', 'error' FROM {_D5} WHERE b NOT IN (SELECT n_nationkey FROM nation)""",
)
def d5(t):
    kind = F.col("c_custkey") % 5
    name = F.when(kind == 0, "").when(kind == 1, "ab").when(kind == 2, F.repeat(F.lit("x"), F.lit(101))).otherwise(F.col("c_name"))
    rows = t.customer.select("c_custkey", name.alias("name"), F.col("c_nationkey").alias("a"), (F.col("c_custkey") % 30).cast("int").alias("b"))
    rows = op.with_reference(rows, "b", t.nation, "n_nationkey", "b_known")
    rules = [
        op.required("name", "Name"),
        *op.length_between("name", "Name"),
        op.not_the_same("a", "b", "Source and target are the same"),
        op.must_exist("b", "b_known", "Target"),
    ]
    return op.validate_rules(rows, ["c_custkey"], rules)


_STEPS = "(SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_name END AS name, [p_size % 8, p_partkey % 7, 3] AS s FROM part)"


@query(
    "D6_config_row_checks",
    f"""SELECT p_partkey, 'name is required' AS message FROM {_STEPS} WHERE name IS NULL
        UNION ALL SELECT p_partkey, 'catalogs excludes database' FROM {_STEPS} WHERE list_contains(s, 1) AND list_contains(s, 6)
        UNION ALL SELECT p_partkey, 'database needs schema' FROM {_STEPS} WHERE list_contains(s, 6) AND NOT list_contains(s, 7)
        UNION ALL SELECT p_partkey, 'schema needs catalogs or database' FROM {_STEPS} WHERE list_contains(s, 7) AND NOT list_contains(s, 6) AND NOT list_contains(s, 1)
        UNION ALL SELECT p_partkey, 'artifacts needs catalogs or schema' FROM {_STEPS} WHERE list_contains(s, 2) AND NOT list_contains(s, 1) AND NOT list_contains(s, 7)
        UNION ALL SELECT p_partkey, 'screens must be positive numbers' FROM {_STEPS} WHERE list_contains(s, 0)
        UNION ALL SELECT p_partkey, 'screens has repeats' FROM {_STEPS} WHERE len(list_distinct(s)) < 3""",
)
def d6(t):
    screens = F.array(F.col("p_size").cast("bigint") % 8, F.col("p_partkey") % 7, F.lit(3).cast("bigint"))
    rows = t.part.select("p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.col("p_name")).alias("name"), screens.alias("screens"))
    return op.validate_rules(rows, ["p_partkey"], op.list_rules("name", "screens")).select("p_partkey", "message")


@query(
    "D7_ok_failed_report",
    f"""WITH {_DIRTY}, o AS (SELECT c_custkey AS id, coalesce(regexp_matches(trim(number), '^[0-9]+$'), false) AS ok, number FROM dirty)
        SELECT CASE WHEN ok THEN 'ok' ELSE 'failed' END AS outcome, id, CASE WHEN NOT ok THEN coalesce(number, 'missing') END AS message,
        count(*) OVER (PARTITION BY ok) AS items FROM o""",
)
def d7(t):
    rows = dirty(t)
    ok = F.trim("number").rlike("^[0-9]+$")
    return op.ok_failed_report(rows, "c_custkey", F.coalesce(ok, F.lit(False)), F.coalesce("number", F.lit("missing")))
