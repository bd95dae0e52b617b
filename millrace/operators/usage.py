"""Usage roll-ups and growth (A12-A18, N5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.filters import filter_recent_active

MONEY = "decimal(18,2)"


def run_counters(facts: DataFrame, *by: str) -> DataFrame:
    """Counters of run facts (status, cost, ts) per key: the partial sums every roll-up starts from."""
    return facts.groupBy(*by).agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("status") == "success").alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.sum(F.col("cost").cast(MONEY)).alias("total_cost"),
        F.max("ts").alias("last_activity"),
    )


def _sum_counters() -> list[Column]:
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return [
        zero("total_runs").alias("total_runs"),
        zero("successful_runs").alias("successful_runs"),
        zero("failed_runs").alias("failed_runs"),
        zero("total_cost").alias("total_cost"),
        F.max("last_activity").alias("last_activity"),
    ]


def usage_by_user(facts: DataFrame, users: DataFrame, user: str) -> DataFrame:
    """A12. One row per user, idle users included. Facts are reduced to one row per user before the join."""
    joined = users.join(run_counters(facts, user), user, "left")
    return joined.na.fill(0, ["total_runs", "successful_runs", "failed_runs", "total_cost"])


def usage_by_group(user_usage: DataFrame, *by: str) -> DataFrame:
    """A13, A14. Roll user rows up to a project or institution, with total and active user counts."""
    return user_usage.groupBy(*by).agg(
        *_sum_counters(), F.count("*").alias("total_users"), F.count_if(F.col("total_runs") > 0).alias("active_users")
    )


def usage_levels(user_usage: DataFrame, *levels: str) -> DataFrame:
    """A14. All levels at once as one rollup; ``level`` is how many of the keys the row still has."""
    depth = len(levels) - sum((F.grouping(x).cast("int") for x in levels[1:]), F.grouping(levels[0]).cast("int"))
    return user_usage.rollup(*levels).agg(*_sum_counters(), F.count("*").alias("total_users"), depth.alias("level"))


def usage_totals(usage: DataFrame, *columns: str) -> DataFrame:
    """A15. Sums, null as 0."""
    return usage.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in columns])


def avg_per_active(usage: DataFrame, last_activity: str, metric: str, now: Column, days: int = 30) -> DataFrame:
    """A16. Active entities and their average metric, to two decimals."""
    active = filter_recent_active(usage, last_activity, now, days)
    average = F.round(F.avg(F.coalesce(F.col(metric), F.lit(0))), 2)
    return active.agg(F.count("*").alias("active"), average.alias("avg_metric"))


def daily_revenue(orders: DataFrame, ts: str, amount: str, now: Column, days: int = 30) -> DataFrame:
    """A17. Orders and revenue per day of the last days, newest first."""
    recent = orders.filter(F.col(ts) >= now - F.make_interval(days=F.lit(days)))
    daily = recent.groupBy(F.to_date(ts).alias("order_date")).agg(
        F.count("*").alias("order_count"), F.sum(F.col(amount).cast(MONEY)).alias("revenue")
    )
    return daily.orderBy(F.col("order_date").desc())


def project_stats(projects: DataFrame, key: str, facts: dict[str, DataFrame]) -> DataFrame:
    """A18. How many rows of each fact table a project has; a fact may come counted already, in a column ``n``.

    Each is reduced to one row per project before it is joined.
    """
    out = projects.select(key)
    for name, fact in facts.items():
        counted = F.sum("n") if "n" in fact.columns else F.count("*")
        out = out.join(fact.groupBy(key).agg(counted.alias(name)), key, "left")
    return out.na.fill(0, list(facts))


def growth_over_time(facts: DataFrame, entity: Sequence[str], ts: str, value: Column) -> DataFrame:
    """N5. Daily amount, change from the entity's previous day with data, and running total.

    The facts are combined to one row per entity and day first, so the windows see days and not facts.
    """
    by = list(entity)
    daily = facts.groupBy(*by, F.to_date(ts).alias("day")).agg(F.sum(value).alias("amount"))
    order = Window.partitionBy(*by).orderBy("day")
    total = F.sum("amount").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return daily.withColumn("change", F.col("amount") - F.lag("amount").over(order)).withColumn("running_total", total)
