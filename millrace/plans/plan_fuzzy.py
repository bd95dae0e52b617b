"""Nearest-text search: J7, L10, L11."""

from pyspark.sql import functions as F

from millrace.operators import fuzzy as op
from millrace.plans.registry import query


def misspelled(t):
    """Part names with one character lost, by position of the part number."""
    at = (F.col("p_partkey") % 5 + 2).cast("int")
    name = F.concat(F.substring("p_name", F.lit(1), at - 1), F.substr("p_name", at + 1))
    return t.part.select("p_partkey", F.when(F.col("p_partkey") % 4 == 0, F.upper("p_name")).otherwise(name).alias("typed"))


_TYPED = """typed AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN upper(p_name) ELSE
  substring(p_name, 1, CAST(p_partkey % 5 + 1 AS INTEGER)) || substring(p_name, CAST(p_partkey % 5 + 3 AS INTEGER)) END AS typed FROM part)"""
_NAMES = "names AS (SELECT p_name AS value, min(p_partkey) AS position FROM part GROUP BY p_name)"
_SCORED = """scored AS (SELECT i.typed, value, position, 1 - CAST(levenshtein(lower(i.typed), lower(value)) AS DOUBLE) /
  greatest(length(i.typed), length(value)) AS score FROM (SELECT DISTINCT typed FROM typed) i, names)"""


@query(
    "J7_fuzzy_match_join",
    f"""WITH {_TYPED}, {_NAMES}, {_SCORED}, best AS (SELECT * FROM scored WHERE score > 0.4
          QUALIFY row_number() OVER (PARTITION BY typed ORDER BY score DESC, position) = 1)
        SELECT p_partkey, t.typed, b.value AS match, b.score FROM typed t LEFT JOIN best b ON b.typed = t.typed""",
)
def j7(t):
    return op.fuzzy_match_join(misspelled(t), "typed", t.part, "p_name", "p_partkey")


@query(
    "J7_fuzzy_match_customers",
    """WITH i AS (SELECT c_custkey, 'Custmer#' || substring(c_name, 11) AS typed FROM customer),
         s AS (SELECT i.c_custkey, c.c_name AS match, c.c_custkey AS position,
           1 - CAST(levenshtein(lower(typed), lower(c_name)) AS DOUBLE) / greatest(length(typed), length(c_name)) AS score FROM i, customer c)
       SELECT c_custkey, match, score FROM s WHERE score > 0.8 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY score DESC, position) = 1""",
)
def j7_customers(t):
    typed = t.customer.select("c_custkey", F.concat(F.lit("Custmer#"), F.substr("c_name", F.lit(11))).alias("typed"))
    candidates = t.customer.select("c_name", F.col("c_custkey").alias("position"))
    return op.fuzzy_match_join(typed, "typed", candidates, "c_name", "position", 0.8).drop("typed")


_TOP = """QUALIFY row_number() OVER (PARTITION BY typed ORDER BY score DESC, position) <= 3"""


@query(
    "L10_top_similar",
    f"""WITH {_TYPED}, {_NAMES}, {_SCORED}, best AS (SELECT *, row_number() OVER (PARTITION BY typed ORDER BY score DESC, position) AS rank
          FROM scored WHERE score >= 0.4 {_TOP})
        SELECT p_partkey, t.typed, b.value AS match, b.position, b.score, b.rank FROM typed t JOIN best b ON b.typed = t.typed""",
)
def l10(t):
    names = t.part.groupBy("p_name").agg(F.min("p_partkey").alias("position"))
    found = op.top_similar(misspelled(t), "typed", names, "p_name", "position")
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "L11_did_you_mean",
    f"""WITH {_TYPED}, alias AS (SELECT n_nationkey * 1000 AS position, n_name, n_name AS value FROM nation
          UNION ALL SELECT n_nationkey * 1000 + 1, n_name, 'land ' || CAST(n_nationkey AS VARCHAR) FROM nation),
        i AS (SELECT s_suppkey, CASE s_suppkey % 2 WHEN 0 THEN 'Naton_' ELSE 'lnd ' END || CAST(s_nationkey AS VARCHAR) AS typed FROM supplier),
        s AS (SELECT i.*, n_name, position, 1 - CAST(levenshtein(lower(typed), lower(value)) AS DOUBLE) / greatest(length(typed), length(value)) AS score FROM i, alias)
        SELECT s_suppkey, n_name AS suggestion, score, row_number() OVER w AS rank FROM s WHERE score >= 0.3
        WINDOW w AS (PARTITION BY s_suppkey ORDER BY score DESC, position) QUALIFY row_number() OVER w <= 3""",
)
def l11(t):
    half = F.when(F.col("s_suppkey") % 2 == 0, "Naton_").otherwise("lnd ")
    typed = t.supplier.select("s_suppkey", F.concat(half, F.col("s_nationkey").cast("string")).alias("typed"))
    aliases = F.array(F.concat(F.lit("land "), F.col("n_nationkey").cast("string")))
    dim = t.nation.select("n_nationkey", "n_name", aliases.alias("aliases"))
    hits = op.did_you_mean(typed, "typed", dim, "n_nationkey", "n_name", "aliases")
    return hits.select("s_suppkey", "suggestion", "score", F.col("rank").cast("bigint").alias("rank"))
