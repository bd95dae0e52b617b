"""Run-history analytics (A1-A11, N1-N4). ``runs`` has id, entity, ts, status, duration and error columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.sliced import top_per_group


def _is(status: str) -> Column:
    return F.col("status") == status


def newest(ts: str, tie: str) -> list[Column]:
    return [F.col(ts).desc(), F.col(tie).desc()]


def count_only(df: DataFrame) -> DataFrame:
    """A1. One row with the number of rows."""
    return df.agg(F.count("*").alias("count"))


def summary_sample(df: DataFrame, order: Sequence[Column | str], fields: Sequence[str], n: int = 3) -> DataFrame:
    """A2. ``total`` and the first ``n`` rows of a total order as an array, in that order."""
    place = F.row_number().over(Window.orderBy(*order)).alias("_place")  # of n rows
    first = df.orderBy(*order).limit(n).select(place, F.struct(*fields).alias("_row"))
    numbered = F.array_sort(F.collect_list(F.struct("_place", "_row")), lambda a, b: a["_place"] - b["_place"])
    sample = first.agg(F.transform(numbered, lambda x: x["_row"]).alias("sample"))
    return df.agg(F.count("*").alias("total")).withColumn("sample", sample.scalar())


def count_by_status(runs: DataFrame) -> DataFrame:
    """A3. Runs per status."""
    return runs.groupBy("status").agg(F.count("*").alias("count"))


def percent_truncated(part: Column, whole: Column) -> Column:
    """Percentage cut (not rounded) to two decimals; null when there is nothing to divide by."""
    return F.when(whole > 0, F.floor(part * 10000 / whole) / 100)


def success_rate(runs: DataFrame, *by: str) -> DataFrame:
    """A4. Total, successes and the truncated success percentage."""
    counted = runs.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(_is("success")).alias("success"))
    return counted.withColumn("rate", percent_truncated(F.col("success"), F.col("total")))


def duration_stats(runs: DataFrame, duration: str, *by: str) -> DataFrame:
    """A5. Average over all rows (rows without a duration count in the denominator), least and greatest."""
    return runs.groupBy(*by).agg(
        (F.sum(duration) / F.count("*")).alias("avg_duration"),
        F.min(duration).alias("min_duration"),
        F.max(duration).alias("max_duration"),
    )


def duration_total(runs: DataFrame, duration: str, *by: str) -> DataFrame:
    """A6. Sum of durations."""
    return runs.groupBy(*by).agg(F.sum(duration).alias("total_duration"))


def error_patterns(runs: DataFrame, message: str) -> DataFrame:
    """A7. Count per error message, most frequent first."""
    counted = runs.filter(F.col(message).isNotNull()).groupBy(message).agg(F.count("*").alias("count"))
    return counted.orderBy(F.col("count").desc(), message)


def run_stats(runs: DataFrame, entity: str) -> DataFrame:
    """A8. Total, successes, failures and success percentage per entity."""
    counted = runs.groupBy(entity).agg(
        F.count("*").alias("total_runs"),
        F.count_if(_is("success")).alias("success_count"),
        F.count_if(_is("failed")).alias("failure_count"),
    )
    return counted.withColumn("success_rate", F.col("success_count") * 100 / F.col("total_runs"))


def state_counts(df: DataFrame, *by: str) -> DataFrame:
    """A9. Total, active and running."""
    return df.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(_is("active")).alias("active"),
        F.count_if(_is("running")).alias("running"),
    )


def last_n_runs(runs: DataFrame, entity: str, ts: str, tie: str, n: int) -> DataFrame:
    """N2. The n newest runs of each entity, numbered from 1."""
    return top_per_group(runs, [entity], newest(ts, tie), n)


def health_word(success: Column, total: Column) -> Column:
    """All ok (also none at all) is HEALTHY, none ok is FAILING, else DEGRADED - in this order."""
    return F.when(success == total, "HEALTHY").when(success == 0, "FAILING").otherwise("DEGRADED")


def health_status(runs: DataFrame, entity: str, ts: str, tie: str, n: int = 5, entities: DataFrame | None = None) -> DataFrame:
    """A10. Health over the last n runs; with a list of entities, those never run are HEALTHY at 0/0."""
    recent = last_n_runs(runs, entity, ts, tie, n)
    counted = recent.groupBy(entity).agg(F.count_if(_is("success")).alias("success"), F.count("*").alias("total"))
    if entities is not None:
        counted = entities.select(entity).join(counted, entity, "left").na.fill(0, ["success", "total"])
    return counted.withColumn("health", health_word(F.col("success"), F.col("total")))


def alert_line(ts: str, message: str) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(": "), F.coalesce(message, F.lit("Unknown error")))


def failure_alerts(runs: DataFrame, entity: str, ts: str, tie: str, message: str, n: int = 5) -> DataFrame:
    """A11. Entities with a failure among their last n runs, with one line per failure, newest first.

    The list holds at most n lines, because only n runs per entity get this far.
    """
    failed = last_n_runs(runs, entity, ts, tie, n).filter(_is("failed"))
    lines = F.array_sort(F.collect_list(F.struct("rank", alert_line(ts, message).alias("line"))))
    return failed.groupBy(entity).agg(F.count("*").alias("failures"), lines["line"].alias("lines"))


def recent_vs_previous(runs: DataFrame, entity: str, ts: str, tie: str, duration: str, n: int = 10) -> DataFrame:
    """N1. Average duration of the last n runs against the n before; null where there are none."""
    both = last_n_runs(runs, entity, ts, tie, 2 * n)

    def average(inside: Column) -> Column:
        return F.sum(F.when(inside, F.col(duration))) / F.nullif(F.count_if(inside), F.lit(0))

    return both.groupBy(entity).agg(
        average(F.col("rank") <= n).alias("recent_avg"), average(F.col("rank") > n).alias("previous_avg")
    )


def latest_run(entities: DataFrame, runs: DataFrame, entity: str, ts: str, tie: str) -> DataFrame:
    """N3. Status of each entity's newest run, ``never run`` where there is none."""
    last = runs.groupBy(entity).agg(F.max_by("status", F.struct(ts, tie)).alias("last_status"))
    return entities.join(last, entity, "left").withColumn("last_status", F.coalesce("last_status", F.lit("never run")))


def slowest_run(runs: DataFrame, entity: str, ts: str, tie: str, duration: str) -> DataFrame:
    """N4. The longest run of each entity; of equally long ones the last."""
    key = F.struct(duration, ts, tie)
    best = runs.groupBy(entity).agg(F.max(key).alias("r"))
    return best.select(entity, F.col("r")[tie].alias(tie), F.col("r")[ts].alias(ts), F.col("r")[duration].alias(duration))
