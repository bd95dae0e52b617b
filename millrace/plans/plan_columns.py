"""Column functions X1-X20 over whole tables."""

from pyspark.sql import functions as F

from millrace.functions import columns as op
from millrace.functions.similarity import string_similarity
from millrace.plans.registry import query


def dirty(t):
    """Customer numbers and flags as the mixed text that arrives from files."""
    kind, key = F.col("c_custkey") % 7, F.col("c_custkey").cast("string")
    flag = F.array(*map(F.lit, ["TRUE", "yes", "on", "0", " t", "1", None]))
    number = (
        F.when(kind == 0, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(kind == 1, F.concat(key, F.lit("abc")))
        .when(kind == 2, F.concat(F.lit("-"), key, F.lit(".7")))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.lit("n/a"))
        .when(kind == 5, key)
    )
    return t.customer.select("c_custkey", "c_acctbal", "c_nationkey", F.get(flag, kind.cast("int")).alias("flag"), number.alias("number"))


_DIRTY = """dirty AS (SELECT c_custkey, c_acctbal, c_nationkey, ['TRUE', 'yes', 'on', '0', ' t', '1', NULL][1 + c_custkey % 7] AS flag,
  CASE c_custkey % 7 WHEN 0 THEN ' ' || CAST(c_custkey AS VARCHAR) || ' ' WHEN 1 THEN CAST(c_custkey AS VARCHAR) || 'abc'
  WHEN 2 THEN '-' || CAST(c_custkey AS VARCHAR) || '.7' WHEN 3 THEN '' WHEN 4 THEN 'n/a' WHEN 5 THEN CAST(c_custkey AS VARCHAR) END AS number FROM customer)"""


@query(
    "X1_normalize_bool",
    f"WITH {_DIRTY} SELECT c_custkey, coalesce(lower(flag) IN ('true', 't', 'on', '1'), false) AS by_text, coalesce(c_nationkey = 1, false) AS by_number FROM dirty",
)
def x1(t):
    d = dirty(t)
    return d.select("c_custkey", op.normalize_bool(d, "flag").alias("by_text"), op.normalize_bool(d, "c_nationkey").alias("by_number"))


@query(
    "X2_normalize_int",
    f"""WITH {_DIRTY} SELECT c_custkey, coalesce(TRY_CAST(regexp_extract(trim(number), '^([+-]?[0-9]+)', 1) AS BIGINT), 9) AS from_text,
        CAST(floor(c_acctbal) AS BIGINT) AS from_number FROM dirty""",
)
def x2(t):
    d = dirty(t)
    return d.select("c_custkey", op.normalize_int(d, "number", 9).alias("from_text"), op.normalize_int(d, "c_acctbal", 0).alias("from_number"))


@query(
    "X3_normalize_string",
    f"WITH {_DIRTY} SELECT c_custkey, coalesce(number, 'none') AS from_text, CAST(c_nationkey AS VARCHAR) AS from_number, 'none' AS from_bool FROM dirty",
)
def x3(t):
    d = dirty(t).withColumn("b", F.col("c_nationkey") > 3)
    made = [op.normalize_string(d, c, "none").alias(a) for c, a in (("number", "from_text"), ("c_nationkey", "from_number"), ("b", "from_bool"))]
    return d.select("c_custkey", *made)


@query(
    "X4_string_similarity",
    """SELECT p_partkey, CASE WHEN greatest(length(p_name), length(p_type)) = 0 THEN 1.0
       ELSE 1 - CAST(levenshtein(lower(p_name), lower(p_type)) AS DOUBLE) / greatest(length(p_name), length(p_type)) END AS similarity FROM part""",
)
def x4(t):
    return t.part.select("p_partkey", string_similarity(F.col("p_name"), F.col("p_type")).alias("similarity"))


_SECONDS = "(event_id * 37 - 100)"


@query(
    "X5_format_duration",
    f"""WITH s AS (SELECT event_id, {_SECONDS} AS s FROM events)
        SELECT event_id, CASE WHEN s < 0 THEN '0s' WHEN s >= 86400 THEN concat(s // 86400, 'd ', s % 86400 // 3600, 'h ', s % 3600 // 60, 'm')
          WHEN s >= 3600 THEN concat(s // 3600, 'h ', s % 3600 // 60, 'm') WHEN s >= 60 AND s % 60 = 0 THEN concat(s // 60, 'm')
          WHEN s >= 60 THEN concat(s // 60, 'm ', s % 60, 's') ELSE concat(s, 's') END AS duration FROM s""",
)
def x5(t):
    return t.events.select("event_id", op.format_duration(F.expr(_SECONDS)).alias("duration"))


@query(
    "X6_format_number_money",
    """SELECT o_orderkey, format('{:,}', o_orderkey * 1000) AS shown, '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS cost,
       '$0.00' AS no_cost, '0' AS no_count FROM orders""",
)
def x6(t):
    none = F.lit(None).cast("bigint")
    return t.orders.select(
        "o_orderkey",
        op.format_count(F.col("o_orderkey") * 1000).alias("shown"),
        op.format_money(F.col("o_totalprice")).alias("cost"),
        op.format_money(none).alias("no_cost"),
        op.format_count(none).alias("no_count"),
    )


@query("X7_decode_nested_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def x7(t):
    escaped = F.concat(F.lit('"'), F.replace(F.col("props"), F.lit('"'), F.lit('\\"')), F.lit('"'))
    twice = F.when(F.col("event_id") % 3 == 0, escaped).otherwise(F.col("props"))
    return t.events.select("event_id", op.decode_nested_json(twice, "k bigint")["k"].alias("k"))


@query(
    "X8_classify_connector",
    """SELECT connectorId, CASE lower(trim(connectorSubType)) WHEN 'postgres' THEN 1 WHEN 'mysql' THEN 1 WHEN 'snowflake' THEN 2
       WHEN 'csv' THEN 3 WHEN 'salesforce' THEN 4 WHEN 'hubspot' THEN 5 ELSE -1 END AS category,
       CASE lower(trim(connectorSubType)) WHEN 'postgres' THEN 'RDBMS' WHEN 'mysql' THEN 'RDBMS' WHEN 'snowflake' THEN 'BigDataNoSQL'
       WHEN 'csv' THEN 'FileAPI' WHEN 'salesforce' THEN 'CRMERP' WHEN 'hubspot' THEN 'Marketing' ELSE 'Unknown' END AS word FROM connectors""",
    "connectors",
)
def x8(t):
    number = op.classify_connector(F.col("connectorSubType"))
    return t.connectors.select("connectorId", number.alias("category"), op.category_name(number).alias("word"))


@query(
    "X9_normalize_status",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'p' END AS status FROM orders",
)
def x9(t):
    raw = F.when(F.col("o_orderstatus") == "F", "Successful").when(F.col("o_orderstatus") == "O", " FAILED").otherwise(F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", op.normalize_status(raw).alias("status"))


@query(
    "X10_split_ids",
    """SELECT c_custkey, unnest(list_distinct([CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), CAST(c_custkey % 10 AS VARCHAR)])) AS id FROM customer""",
)
def x10(t):
    key, nation, digit = (F.expr(e).cast("string") for e in ("c_custkey", "c_nationkey", "c_custkey % 10"))
    text = F.concat(F.lit(" "), key, F.lit(", "), nation, F.lit("\t"), digit, F.lit(" ,, "), key)
    return t.customer.select("c_custkey", F.explode(op.split_ids(text)).alias("id"))


@query(
    "X11_split_columns",
    """SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name || '|' || p_type END AS columns FROM part""",
)
def x11(t):
    text = F.when(F.col("p_partkey") % 4 == 0, "*").otherwise(F.concat("p_name", F.lit(" , "), "p_type"))
    return t.part.select("p_partkey", F.array_join(op.split_columns(text), "|").alias("columns"))


@query(
    "X12_display_value",
    """SELECT connectorId, coalesce(status, '-') AS status, CASE WHEN price = floor(price) THEN CAST(CAST(price AS BIGINT) AS VARCHAR) ELSE CAST(price AS VARCHAR) END AS price,
       '[' || connectorId || ',' || size || ']' AS pair, CASE WHEN deleted THEN 'true' ELSE 'false' END AS deleted FROM connectors""",
    "connectors",
)
def x12(t):
    d = t.connectors.withColumn("pair", F.array("connectorId", "size"))
    return d.select("connectorId", *[op.display_value(d, c).alias(c) for c in ("status", "price", "pair", "deleted")])


@query("X12_display_time", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(extract('ms' FROM ts) % 1000 AS VARCHAR), 3, '0') || 'Z' AS ts FROM events")
def x12_time(t):
    d = t.events
    return d.select("event_id", op.display_value(d, "ts").alias("ts"))


@query(
    "X13_entity_identity",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'User' WHEN 1 THEN 'Project' WHEN 2 THEN 'Institution' ELSE 'Usage' END AS kind,
       CASE WHEN c_custkey % 4 < 3 THEN c_custkey END AS id,
       CASE c_custkey % 4 WHEN 0 THEN CASE WHEN c_custkey % 8 = 0 THEN 'mail' ELSE c_name END WHEN 1 THEN c_mktsegment ELSE 'N/A' END AS name FROM customer""",
)
def x13(t):
    key, part = F.col("c_custkey"), F.col("c_custkey") % 4
    only = lambda n: F.when(part == n, key)
    full = F.when(key % 8 == 0, "").otherwise(F.col("c_name"))
    who = op.entity_identity(only(0), full, F.lit("mail"), only(1), F.col("c_mktsegment"), only(2), F.lit(""))
    return t.customer.select("c_custkey", who.alias("w")).select("c_custkey", "w.*")


@query(
    "X14_compute_storage_ratio",
    "SELECT p_partkey, p_retailprice / greatest(CASE WHEN p_size % 5 = 0 THEN 1 ELSE p_size % 5 END, 1) AS ratio FROM part",
)
def x14(t):
    storage = F.nullif(F.col("p_size") % 5, F.lit(0)).cast("double")
    return t.part.select("p_partkey", op.compute_storage_ratio(F.col("p_retailprice"), storage).alias("ratio"))


@query(
    "X15_hours_since",
    "SELECT user_id, CAST(floor(epoch(TIMESTAMP '2024-01-31 00:00:00' - max(ts)) / 3600) AS BIGINT) AS hours FROM events GROUP BY user_id",
)
def x15(t):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return t.events.groupBy("user_id").agg(op.hours_between(F.max("ts"), now).alias("hours"))


_UNITS = "length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g'))"


@query(
    "X16_text_size_budget",
    f"""SELECT doc_id, u AS chars, CAST(floor(u * 0.25 + 0.5) AS BIGINT) AS tokens,
        CASE WHEN u < 50000 THEN 'OK' WHEN u > 100000 THEN 'HIGH' ELSE 'MODERATE' END AS level FROM (SELECT doc_id, {_UNITS} AS u FROM documents)""",
)
def x16(t):
    units = op.utf16_length(F.col("text"))
    return t.documents.select("doc_id", units.alias("chars"), op.text_tokens(units).alias("tokens"), op.text_level(units).alias("level"))


@query(
    "X16_text_budget_by_source",
    f"""SELECT source, lang, count(*) AS texts, CAST(sum(u) AS BIGINT) AS chars, CAST(floor(sum(u) * 0.25 + 0.5) AS BIGINT) AS tokens,
        CASE WHEN sum(u) < 50000 THEN 'OK' WHEN sum(u) > 100000 THEN 'HIGH' ELSE 'MODERATE' END AS level
        FROM (SELECT source, lang, {_UNITS} AS u FROM documents) GROUP BY source, lang""",
)
def x16_source(t):
    sized = t.documents.select("source", "lang", op.utf16_length(F.col("text")).alias("u"))
    total = sized.groupBy("source", "lang").agg(F.count("*").alias("texts"), F.sum("u").alias("chars"))
    return total.select("*", op.text_tokens(F.col("chars")).alias("tokens"), op.text_level(F.col("chars")).alias("level"))


@query(
    "X17_health_active",
    "SELECT connectorId, coalesce(status = 'active', false) OR isActive = 1 AS active FROM connectors",
    "connectors",
)
def x17(t):
    health = F.when(F.col("size") % 2 == 0, F.col("status")).otherwise("")
    return t.connectors.select("connectorId", op.health_active(health, F.col("status"), F.col("isActive")).alias("active"))


@query(
    "X20_log_line",
    """SELECT conv_id, turn, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(turn), '%Y-%m-%d %H:%M:%S') AS ts, upper(role) AS level, text AS message FROM conversations""",
)
def x20(t):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(secs=F.col("turn"))
    lines = t.conversations.select("conv_id", "turn", op.format_log_line(at, F.col("role"), F.col("text")).alias("line"))
    parsed = lines.select("conv_id", "turn", op.parse_log_line(F.col("line")).alias("p")).select("conv_id", "turn", "p.*")
    return parsed.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
