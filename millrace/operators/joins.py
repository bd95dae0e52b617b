"""Lookups (J1-J8). No join carries a broadcast hint: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, splitting skewed partitions of the fact side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key: the value that comes last in ``order``, the greatest of those that tie."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(order, value)).alias(value))


def enrich_usage(usage: DataFrame, projects: DataFrame, *, order: str = "id") -> DataFrame:
    """J1. Add ``projectInternalId`` by ``projectId``. A missing or zero id finds nothing; of equal ids the last wins."""
    lookup = last_per_key(projects.filter(F.col("id") != 0), "id", "internalId", order)
    lookup = lookup.select(F.col("id").alias("projectId"), F.col("internalId").alias("projectInternalId"))
    return usage.join(lookup, "projectId", "left")


def numeric_id(c: Column) -> Column:
    """The number of an all-digit id, else null."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))


def resolve_ids(ids: DataFrame, projects: DataFrame, *, column: str = "id", out: str = "resolved", order: str = "id") -> DataFrame:
    """J2. All-digit ids become the internal id found for them; every other id, known or not, stays as it is.
    Of projects with the same number the last in ``order`` wins."""
    usable = projects.filter((F.col("id") != 0) & (F.col("internalId") != ""))
    lookup = last_per_key(usable, "id", "internalId", order)
    lookup = lookup.select(F.col("id").alias("_num"), F.col("internalId").alias("_internal"))
    number = numeric_id(F.col(column))
    # ids without a number have nothing to find; as null keys they would all meet in one task
    found = ids.where(number.isNotNull()).withColumn("_num", number).join(lookup, "_num", "left")
    found = found.withColumn(out, F.coalesce("_internal", column)).drop("_num", "_internal")
    return found.unionByName(ids.where(number.isNull()).withColumn(out, F.col(column)))


def validate_ids(ids: DataFrame, projects: DataFrame, *, column: str = "id") -> DataFrame:
    """J3. Add ``valid``: the id is a known internal id, or is all digits and a known numeric id.

    Ids without a number take no part in the join by number, and null ids in neither, so no task gets all of them.
    """
    number, text = numeric_id(F.col(column)), F.col(column)
    numbers = projects.select(F.col("id").alias("_n")).where("_n IS NOT NULL").distinct().withColumn("_byn", F.lit(True))
    texts = projects.select(F.col("internalId").alias("_s")).where("_s IS NOT NULL").distinct().withColumn("_bys", F.lit(True))
    none = F.lit(None).cast("boolean")
    with_number = ids.where(number.isNotNull()).withColumn("_n", number).join(numbers, "_n", "left").drop("_n")
    known = with_number.unionByName(ids.where(number.isNull() & text.isNotNull()).withColumn("_byn", none))
    found = known.join(texts, F.col(column) == F.col("_s"), "left").withColumn("valid", F.coalesce("_byn", "_bys", F.lit(False)))
    return found.drop("_s", "_byn", "_bys").unionByName(ids.where(text.isNull()).withColumn("valid", F.lit(False)))


def connector_usage(pipelines: DataFrame, connectors: DataFrame, *, source: str, target: str, connector: str) -> DataFrame:
    """J4. One row per (connector, pipeline) with its role; a connector that is both ends counts as Source.

    Each pipeline yields at most two (connector, role) rows, then one equi-join; an OR join would be a nested loop.
    """
    roles = F.array(
        F.struct(F.col(source).alias(connector), F.lit("Source").alias("role")),
        F.when(~F.col(source).eqNullSafe(F.col(target)), F.struct(F.col(target).alias(connector), F.lit("Target").alias("role"))),
    )
    uses = pipelines.select("*", F.inline(roles)).filter(F.col("role").isNotNull())
    return uses.join(connectors.select(connector), connector, "left_semi")


def bulk_get(table: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """J6. (rows found for the ids, ids not found)."""
    wanted = ids.select(key).distinct()
    return table.join(wanted, key, "left_semi"), wanted.join(table, key, "left_anti")


def failure_with_name(runs: DataFrame, dim: DataFrame, *, entity: str, name: str) -> DataFrame:
    """J8. Failures per entity with its display name: aggregate first, then join the few result rows."""
    failures = runs.filter(F.col("status") == "failed").groupBy(entity).agg(F.count("*").alias("failures"))
    return failures.join(dim.select(entity, name), entity, "left")
