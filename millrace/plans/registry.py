"""Registry of queries and the table views they start from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


_SCHEMAS: dict[str, StructType] = {}  # by path, so that only the first read of a file opens its footer to plan


class Tables:
    """The given tables, and the views below as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            path = f"{self.folder}/{name}.parquet"
            if path not in _SCHEMAS:
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            return self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        if name in VIEWS:
            base, where, columns = VIEWS[name]
            df = getattr(self, base)
            return (df.where(where) if where else df).selectExpr(*columns)
        raise AttributeError(name)

    def every(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLE_NAMES}


# Views of the given tables in the shape the operators work on: (table, condition, columns). The text is plain enough
# to mean the same in Spark and in the checking SQL.
VIEWS: dict[str, tuple[str, str | None, list[str]]] = {
    "runs": (
        "events",
        None,
        [
            "event_id AS id",
            "user_id AS entity",
            "ts",
            "CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'success' END AS status",
            "CASE WHEN event_id % 13 <> 0 THEN CAST(round(value * 1000) AS BIGINT) END AS duration",
            "CASE WHEN event_type = 'error' AND event_id % 5 <> 0 THEN props END AS error_message",
        ],
    ),
    "connectors": (
        "part",
        None,
        [
            "p_partkey AS connectorId",
            "p_name AS connectorName",
            "p_type AS connectorType",
            "CASE p_partkey % 8 WHEN 0 THEN 'Postgres' WHEN 1 THEN ' MySQL ' WHEN 2 THEN 'SNOWFLAKE' WHEN 3 THEN 'csv' "
            "WHEN 4 THEN 'Salesforce' WHEN 5 THEN 'HubSpot' WHEN 6 THEN 'mystery' END AS connectorSubType",
            "CASE p_size % 3 WHEN 0 THEN 'active' WHEN 1 THEN ' Inactive' END AS status",
            "p_size AS size",
            "p_partkey % 10 = 0 AS deleted",
            "CAST(p_partkey % 2 AS INT) AS isActive",
            "concat('proj-', CAST(p_partkey % 100 AS STRING)) AS internalID",
            "p_retailprice AS price",
            "p_brand AS brand",
        ],
    ),
    "projects": (
        "nation",
        None,
        [
            "CAST(n_nationkey AS BIGINT) AS id",
            "concat('prj-', lower(n_name)) AS internalId",
            "n_name AS projectName",
            "n_regionkey AS institutionId",
        ],
    ),
    "facts": (
        "orders",
        None,
        [
            "o_orderkey AS id",
            "o_custkey AS user_id",
            "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'running' END AS status",
            "o_totalprice AS cost",
            "o_orderdate AS ts",
        ],
    ),
    "users": (
        "customer",
        None,
        ["c_custkey AS user_id", "c_name AS user_name", "c_nationkey AS project_id"],
    ),
    "orders_v1": (
        "orders",
        "o_orderdate < CAST('1999-01-01 00:00:00' AS TIMESTAMP)",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate AS updated_at"],
    ),
    "orders_v2": (
        "orders",
        "o_orderkey % 11 <> 0",
        [
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice",
            "CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 3650 DAY ELSE o_orderdate END AS updated_at",
        ],
    ),
}


def view_sql(name: str) -> str:
    base, where, columns = VIEWS[name]
    condition = f" WHERE {where}" if where else ""
    return f"{name} AS (SELECT {', '.join(columns)} FROM {base}{condition})"


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a function of the tables. ``views`` lists the views its SQL refers to."""

    def add(fn: Callable[[Tables], DataFrame]):
        head = ", ".join(view_sql(v) for v in views.split())
        text = f"WITH {head}{sql if sql.startswith(',') else ' ' + sql}" if sql and head else sql
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(fn, text)
        return fn

    return add
