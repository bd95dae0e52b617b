"""Lookups, run reports, quality rules and discovery on small cases."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import discover, joins, quality
from millrace.operators import runs as run_op


def test_resolve_and_validate_ids(spark):
    projects = spark.createDataFrame([(1, "abc"), (2, ""), (0, "zero"), (3, "7")], "id bigint, internalId string")
    ids = spark.createDataFrame([("1",), ("01",), ("2",), ("abc",), ("99",), ("7",), ("0",), ("",)], "id string")
    found = {r.id: r.resolved for r in joins.resolve_ids(ids, projects).collect()}
    assert found == {"1": "abc", "01": "abc", "2": "2", "abc": "abc", "99": "99", "7": "7", "0": "0", "": ""}
    valid = {r.id: r.valid for r in joins.validate_ids(ids, projects).collect()}
    assert valid == {"1": True, "01": True, "2": True, "abc": True, "99": False, "7": True, "0": True, "": True}


def test_the_last_of_equal_projects_wins(spark):
    projects = spark.createDataFrame([(1, "new", 9), (1, "old", 3)], "id bigint, internalId string, at int")
    usage = spark.createDataFrame([(1,), (0,), (None,), (5,)], "projectId bigint")
    found = {r.projectId: r.projectInternalId for r in joins.enrich_usage(usage, projects, order="at").collect()}
    assert found == {1: "new", 0: None, None: None, 5: None}


def test_connector_that_is_both_ends_counts_once_as_source(spark):
    pipelines = spark.createDataFrame([(1, "a", "b"), (2, "a", "a"), (3, None, "a")], "id int, s string, t string")
    uses = joins.connector_usage(pipelines, spark.createDataFrame([("a",)], "c string"), source="s", target="t", connector="c")
    assert sorted((r.id, r.role) for r in uses.collect()) == [(1, "Source"), (2, "Source"), (3, "Target")]


def test_rate_is_cut_not_rounded(spark):
    rows = spark.createDataFrame([("success",)] * 2 + [("failed",)], "status string")
    assert run_op.success_rate(rows).head().rate == 66.66
    assert run_op.success_rate(rows.filter("false")).head().rate is None


def test_health_words(spark):
    rows = spark.createDataFrame([(0, 0), (5, 5), (0, 5), (2, 5)], "s int, t int")
    assert [r[0] for r in rows.select(run_op.health_word(F.col("s"), F.col("t"))).collect()] == ["HEALTHY", "HEALTHY", "FAILING", "DEGRADED"]


def test_summary_sample(spark):
    row = run_op.summary_sample(spark.createDataFrame([(i,) for i in (5, 3, 1, 4, 2)], "id int"), ["id"], ["id"]).head()
    assert row.total == 5 and [r.id for r in row.sample] == [1, 2, 3]


def test_rules(spark):
    df = spark.createDataFrame([(1, None), (2, "ab"), (3, "fine")], "id int, name string")
    rules = [quality.required("name", "Name"), *quality.length_between("name", "Name")]
    assert {(r.id, r.message) for r in quality.validate_rules(df, ["id"], rules).collect()} == {
        (1, "Name is required"),
        (2, "Name must be at least 3 characters"),
    }
    assert [r.valid for r in quality.mark_valid(df, rules).orderBy("id").collect()] == [False, False, True]
    warned = [quality.Rule("id", "odd", F.col("id") == 1, "warning")]
    assert quality.mark_valid(df, warned).filter("valid").count() == 3


@pytest.mark.parametrize(
    "steps, messages",
    [
        ([1, 2], set()),
        ([], {"screens is empty"}),
        (None, {"screens is required"}),
        ([1, 6, 7], {"catalogs excludes database"}),
        ([6, 2], {"database needs schema", "artifacts needs catalogs or schema"}),
        ([7], {"schema needs catalogs or database"}),
        ([1, 0, 1], {"screens must be positive numbers", "screens has repeats"}),
        ([1, None], {"screens must be positive numbers"}),
    ],
)
def test_screen_lists(spark, steps, messages):
    df = spark.createDataFrame([(1, "n", steps)], "id int, name string, screens array<int>")
    found = quality.validate_rules(df, ["id"], quality.list_rules("name", "screens")).collect()
    assert {r.message for r in found} == messages


def test_recommendations(spark):
    now = datetime(2024, 1, 1)
    rows = spark.range(50).select(
        F.col("id").alias("k"), F.lit("x").alias("op"), (F.lit(now) + F.make_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("updated_at")
    )
    tables = {"changes": rows, "facts": rows.select("op", "updated_at").drop("op").withColumn("n", F.lit(1)), "dim": rows.select("k"), "empty": rows.filter("k < 0"), "plain": rows.select(F.lit(1).alias("c"))}
    found = {r.table: r for r in discover.recommend_ingestion(discover.profile_tables(tables)).collect()}
    assert {t: (r.ingestionType, r.confidence) for t, r in found.items()} == {
        "changes": ("cdc", 95),
        "facts": ("historical", 70),
        "dim": ("snapshot", 80),
        "empty": ("snapshot", 0),
        "plain": ("snapshot", 60),
    }
    assert found["changes"].mergeColumns == ["k"] and found["facts"].watermarkColumnName == ["updated_at"]


def test_structure_prunes_only_at_full_depth(spark):
    meta = spark.createDataFrame([("c", "s1", "orders"), ("c", "s2", "users"), ("d", "s3", "x")], "catalog string, schema string, table string")
    names = lambda **o: sorted(tuple(r) for r in discover.discover_structure(meta, **o).collect())
    assert names(table_pattern="ORD") == [("c", "s1", "orders")]
    assert names(table_pattern="ORD", depth=2) == [("c", "s1"), ("c", "s2"), ("d", "s3")]
    assert names(catalog="d", schema="nothing", depth=1) == [("d",)]


def test_inventory_and_drift(spark):
    df = spark.createDataFrame([(1, None), (2, "it's")], "`a b` int, `c'd` string")
    rows = {r.column: (r.type, r.null_count, r.approx_distinct) for r in discover.column_inventory({"t": df}, distinct=True).collect()}
    assert rows == {"a b": ("int", 0, 2), "c'd": ("string", 1, 1)}
    new = spark.createDataFrame([], "`a b` bigint, e int")
    assert discover.schema_drift(df.schema, new.schema) == [("a b", "type changed"), ("c'd", "removed"), ("e", "added")]


def test_limit_whatever_the_text_says(spark):
    spark.range(9).withColumnRenamed("id", "credit_limit").createOrReplaceTempView("limits")
    assert discover.run_sql(spark, "SELECT credit_limit FROM limits;", 4).count() == 4
    assert discover.run_sql(spark, "SELECT * FROM limits WHERE credit_limit < :x", None, x=3).count() == 3
