"""Discovery, profiling and recommendations: Q1-Q12, I16, I17."""

from itertools import combinations

from pyspark.sql import functions as F

from millrace.operators import discover as op
from millrace.operators.profiles import LoadProfiles
from millrace.plans.registry import TABLE_NAMES, query
from millrace.session import work_path

# The given tables' columns with their types, for the checking SQL (see TESTDATA.md).
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
COLUMNS = {t: [tuple(c.split(" ")) for c in text.split(", ")] for t, text in _COLUMNS.items()}

PLACES = {
    name: ("lake", "text" if name in ("documents", "pages", "benchmark", "labels", "conversations") else "ops" if name in ("events", "embeddings") else "sales")
    for name in TABLE_NAMES
}
_COUNTED = " UNION ALL ".join(
    f"SELECT '{PLACES[t][0]}' AS catalog, '{PLACES[t][1]}' AS schema, '{t}' AS \"table\", count(*) AS row_count, {len(COLUMNS[t])} AS columns FROM {t}"
    for t in TABLE_NAMES
)


@query("Q1_run_sql", "SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY o_orderpriority")
def q1(t):
    t.orders.createOrReplaceTempView("millrace_orders")
    return op.run_sql(t.spark, " SELECT o_orderpriority, count(*) AS orders FROM millrace_orders GROUP BY o_orderpriority ; ")


@query("Q2_run_sql_limited", "SELECT o_orderkey AS credit_limit FROM orders ORDER BY o_orderkey LIMIT 7")
def q2(t):
    t.orders.createOrReplaceTempView("millrace_orders")
    return op.run_sql(t.spark, "SELECT o_orderkey AS credit_limit FROM millrace_orders ORDER BY o_orderkey;", 7)


@query(
    "Q7_column_inventory",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", {i} AS ordinal, '{c}' AS \"column\", '{k}' AS type, 'YES' AS nullable, count(*) - count({c}) AS null_count, "
        f"count(*) AS row_count FROM {t}"
        for t in TABLE_NAMES
        for i, (c, k) in enumerate(COLUMNS[t])
    ),
)
def q7(t):
    return op.column_inventory(t.every())


@query("Q8_discover_structure", f"SELECT * FROM ({_COUNTED}) WHERE schema = 'sales' AND regexp_matches(\"table\", 'r', 'i')")
def q8(t):
    return op.discover_structure(op.discover_counts(PLACES, t.every()), catalog="lake", schema="sales", table_pattern="R")


@query("Q8_discover_schemas", f"SELECT DISTINCT catalog, schema FROM ({_COUNTED})")
def q8_schemas(t):
    return op.discover_structure(op.discover_counts(PLACES, t.every()), table_pattern="nothing", depth=2)


@query("Q9_discover_counts", _COUNTED)
def q9(t):
    return op.discover_counts(PLACES, t.every())


def _text(column: str, kind: str, which: str) -> str:
    if kind == "timestamp_ntz":
        return f"strftime({which}({column}), '%Y-%m-%d %H:%M:%S')"
    return "NULL" if kind.startswith("array") else f"CAST({which}({column}) AS VARCHAR)"


def _profile_sql(table: str, i: int, column: str, kind: str) -> str:
    unique = f"count(*) > 0 AND count(DISTINCT {column}) = count(*)" if kind in ("string", "int", "bigint") else "false"
    least, most = (_text(column, kind, w) for w in ("min", "max"))
    return (
        f"SELECT '{table}' AS \"table\", count(*) AS row_count, {i} AS ordinal, '{column}' AS \"column\", count(*) - count({column}) AS null_count, "
        f"{least} AS min_value, {most} AS max_value, {unique} AS is_unique, '{kind}' AS type, {str(kind.startswith('timestamp')).lower()} AS is_time FROM {table}"
    )


@query("Q10_profile_table", " UNION ALL ".join(_profile_sql("orders", i, c, k) for i, (c, k) in enumerate(COLUMNS["orders"])))
def q10(t):
    return op.profile_tables({"orders": t.orders}).drop("approx_distinct", "tested")


def _loads(t, table: str, key: str):
    """A table loaded in three parts, one of them twice, and each part summarised once."""
    profiles = LoadProfiles(t.spark, work_path(t.spark, f"profile_{table}"))
    rows = getattr(t, table)
    for load in (0, 1, 2, 1):
        profiles.add(str(load), rows.filter(F.col(key) % 3 == load))
    return profiles.profile().withColumn("table", F.lit(table))


def _by_load_sql(table: str) -> str:
    every = " UNION ALL ".join(_profile_sql(table, i, c, k) for i, (c, k) in enumerate(COLUMNS[table]))
    return f"SELECT * EXCLUDE (is_unique, is_time) FROM ({every})"


@query("Q10_profile_by_load", _by_load_sql("orders"))
def q10_by_load(t):
    return _loads(t, "orders", "o_orderkey").drop("approx_distinct", "quartiles")


@query("Q7_inventory_by_load", f"SELECT \"table\", ordinal, \"column\", type, null_count, row_count FROM ({_by_load_sql('lineitem')})")
def q7_by_load(t):
    return _loads(t, "lineitem", "l_orderkey").select("table", "ordinal", "column", "type", "null_count", "row_count")


@query("Q11_schema_index", f"SELECT catalog || '.' || schema || '.' || \"table\" AS path, 'table' AS type FROM ({_COUNTED}) WHERE \"table\" LIKE '%o%'")
def q11(t):
    found = op.discover_counts(PLACES, t.every())
    schemas = found.groupBy("catalog", "schema").agg(F.collect_list("table").alias("tables"))
    catalogs = schemas.groupBy("catalog").agg(F.collect_list(F.struct(F.col("schema").alias("name"), "tables")).alias("schemas"))
    nested = catalogs.agg(F.collect_list(F.struct(F.col("catalog").alias("name"), "schemas")).alias("catalogs"))
    return op.schema_index(nested, search="o").filter("type = 'table' AND split(path, '[.]')[2] LIKE '%o%'")


@query("Q12_table_row_counts", f'SELECT "table", row_count FROM ({_COUNTED})')
def q12(t):
    return op.table_row_counts(t.every())


_RECOMMENDED = list(TABLE_NAMES)


def _recommendation_sql(table: str, columns: list[tuple[str, ...]] | None = None) -> str:
    columns = columns or COLUMNS[table]
    may = [c for c, k in columns if k in ("string", "int", "bigint")]
    keys = " ".join(f"WHEN count(*) > 0 AND count(DISTINCT {c}) = count(*) THEN '{c}'" for c in may)
    for width in (2, 3, 4):
        for some in combinations(may, width):
            full = " AND ".join(f"count({c}) = count(*)" for c in some)
            keys += f" WHEN count(*) > 0 AND {full} AND count(DISTINCT ({', '.join(some)})) = count(*) THEN '{','.join(some)}'"
    times = [c for c, k in columns if k == "timestamp_ntz"]
    mark = f"CASE WHEN count(*) > 0 AND count({times[0]}) = count(*) THEN '{times[0]}' END" if times else "NULL"
    return f"SELECT '{table}' AS \"table\", CASE {keys} END AS k, {mark} AS w FROM {table}"


@query(
    "I16_recommend_ingestion",
    f"""WITH r AS ({" UNION ALL ".join(_recommendation_sql(t) for t in _RECOMMENDED)})
        SELECT "table", CASE WHEN k IS NOT NULL AND w IS NOT NULL THEN 'delta' WHEN w IS NOT NULL THEN 'historical' ELSE 'snapshot' END AS "ingestionType",
          CASE WHEN k IS NOT NULL AND w IS NOT NULL THEN 90 WHEN w IS NOT NULL THEN 70 WHEN k IS NOT NULL THEN 80 ELSE 60 END AS confidence,
          k AS merge_column, w AS watermark, false AS "cdcSupported" FROM r""",
)
def i16(t):
    profiles = op.profile_tables(t.every())
    found = op.recommend_ingestion(profiles, op.key_columns(t.every(), profiles))
    return found.select(
        "table",
        "ingestionType",
        "confidence",
        F.array_join("mergeColumns", ",").alias("merge_column"),
        F.array_join("watermarkColumnName", ",").alias("watermark"),
        "cdcSupported",
    )


_DAILY = "user_id bigint, kind string, day string, hour string, last_seen timestamp_ntz"
_DAILY_SQL = _recommendation_sql("daily", [tuple(c.split(" ")) for c in _DAILY.split(", ")])


@query(
    "I16_wide_key",
    f"""WITH daily AS (SELECT user_id, event_type AS kind, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hour, max(ts) AS last_seen
          FROM events GROUP BY ALL), r AS ({_DAILY_SQL})
        SELECT "table", k AS merge_column, w AS watermark, CASE WHEN k IS NOT NULL THEN 'delta' ELSE 'historical' END AS "ingestionType" FROM r""",
)
def i16_wide(t):
    parts = [F.col("event_type").alias("kind"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "HH").alias("hour")]
    tables = {"daily": t.events.groupBy("user_id", *parts).agg(F.max("ts").alias("last_seen"))}
    profiles = op.profile_tables(tables)
    found = op.recommend_ingestion(profiles, op.key_columns(tables, profiles))
    merge, mark = F.array_join("mergeColumns", ",").alias("merge_column"), F.array_join("watermarkColumnName", ",").alias("watermark")
    return found.select("table", merge, mark, "ingestionType")


@query(
    "I17_apply_recommendation",
    f"""WITH r AS ({" UNION ALL ".join(_recommendation_sql(t) for t in _RECOMMENDED)}),
        a AS ({_COUNTED}) SELECT a."table" AS "sourceObjectName", a.row_count,
          CASE WHEN k IS NOT NULL AND w IS NOT NULL THEN 'delta' WHEN w IS NOT NULL THEN 'historical' ELSE 'snapshot' END AS "ingestionType",
          coalesce(k, 'old_key') AS "primaryKeys", w AS "timestampColumn", w AS "incrementalColumn" FROM a LEFT JOIN r ON r."table" = a."table" """,
)
def i17(t):
    artifacts = op.table_row_counts(t.every()).select(
        F.col("table").alias("sourceObjectName"),
        "row_count",
        F.lit("snapshot").alias("ingestionType"),
        F.array(F.lit("old_key")).alias("primaryKeys"),
        F.lit(None).cast("string").alias("timestampColumn"),
        F.lit(None).cast("string").alias("incrementalColumn"),
    )
    profiles = op.profile_tables(t.every())
    applied = op.apply_recommendation(artifacts, op.recommend_ingestion(profiles, op.key_columns(t.every(), profiles)))
    return applied.withColumn("primaryKeys", F.array_join("primaryKeys", ","))
