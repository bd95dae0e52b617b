"""Per-key ordered work that survives a key holding a large share of all rows.

A window over a key puts all of the key's rows in one task. Keys with more rows than one task should hold are found by
counting (:func:`hot_keys`); only their rows are cut along the order column (:func:`with_slices`), windows then run over
(key, slice), and a summary with one row per (key, slice) carries values across the cuts.
:func:`top_per_group` needs no cutting: Spark drops all but k rows per key and task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "_slice"
HOT_ROWS = 2_000_000  # rows of one key that one task may have to sort
_STEP = 64


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``rows`` rows, with their count ``n``; at most 1/``rows`` as many as the table has rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > rows)


def with_slices(df: DataFrame, order: str, slices: int) -> DataFrame:
    """Add a slice number that never falls as ``order`` (a number or a time) grows, with about equally many rows each.

    The cut points are quantiles of the order column, one per slice. They are found now, by one aggregate over that column
    alone, and built in as a constant: every part of the later plan must cut alike, also when a lost task is run again.
    They only steer balance, so an estimate is enough. A row looks for its place among every ``_STEP``-th point first.
    """
    data_type = df.schema[order].dataType
    if not orderable(data_type):
        raise ValueError(f"{order} must be a number or a time")
    at = [i / slices for i in range(1, slices)]
    found = df.agg(F.percentile_approx(order, at or [0.5], min(10 * slices, 100_000)).cast("array<string>")).head()[0] if at else None
    points = list(dict.fromkeys(found or []))
    if not points:
        return df.withColumn(SLICE, F.lit(0))

    def constant(values: list[str]) -> Column:
        listed = ", ".join(f"'{v}'" for v in values)  # numbers and times; folded once, not cast again for each row
        return F.expr(f"CAST(array({listed}) AS array<{data_type.simpleString()}>)")

    def passed(values: Column) -> Column:
        return F.size(F.filter(values, lambda p: F.coalesce(F.col(order) > p, F.lit(False))))

    if len(points) <= _STEP:
        return df.withColumn(SLICE, passed(constant(points)))
    coarse = passed(constant(points[_STEP - 1 :: _STEP])) * _STEP
    return df.withColumn(SLICE, coarse + passed(F.slice(constant(points), coarse + 1, _STEP)))


def orderable(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key. Spark keeps only k rows per key and task before the shuffle."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(rank) <= k)
