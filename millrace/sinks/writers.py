"""Sinks (W1-W12). Merging writes live in :mod:`millrace.sources.store`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import display_value


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """W1. Add rows to a folder."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """W2. Replace the contents; with partition columns, replace only the partitions the rows fall in."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_lake_parquet(df: DataFrame, path: str, codec: str = "snappy", partition_by: Sequence[str] = ()) -> None:
    """W4. Parquet export. The rebalance hint sizes files at run time and splits partitions that hold too much."""
    sized = df.hint("rebalance", *partition_by)
    sized.write.mode("overwrite").option("compression", codec).partitionBy(*partition_by).parquet(path)


def csv_text(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """W5. Every column as the text that goes into a CSV cell; null is empty and nested values are JSON."""
    return df.select(*[display_value(df, c, "").alias(c) for c in (fields or df.columns)])


def write_csv(df: DataFrame, path: str, fields: Sequence[str] | None = None, delimiter: str = ",", quote: str = '"') -> None:
    """W5. Delimited export: header row, quotes only where needed and doubled inside, null as empty; an empty table
    writes no header either."""
    text = csv_text(df, fields)
    options = {
        "header": not df.isEmpty(),
        "sep": delimiter,
        "quote": quote,
        "escape": quote,
        "nullValue": "",
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    text.write.mode("overwrite").options(**options).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """W6. One JSON object per line, null fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_layout(df: DataFrame, path: str, distribution_key: str | Sequence[str] = (), sort_key: str | Sequence[str] = (), compression: str | None = None) -> None:
    """W4, W7. Rows of a key together and each file sorted. Rebalancing (not plain hashing) splits a key that holds too
    many rows over several files instead of one task."""
    dealt, sort = ([k] if isinstance(k, str) else list(k) for k in (distribution_key, sort_key))
    df = df.hint("rebalance", *dealt) if dealt else df
    df = df.sortWithinPartitions(*sort) if sort else df
    writer = df.write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str, sort_key: str) -> None:
    """W7 as a catalog table: later joins and aggregates on the key need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(sort_key).format("parquet").saveAsTable(table)


def topic_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """W11. Rows as (key, value) JSON text, the shape a topic takes."""
    return df.select(F.to_json(F.struct(*keys)).alias("key"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_stream_topic(changes: DataFrame, keys: Sequence[str], checkpoint: str, *, path: str | None = None, **kafka):
    """W11. Stream change rows to a topic; with a path, to files of the same encoding."""
    writer = topic_rows(changes, keys).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.format("parquet").start(path) if path else writer.format("kafka").options(**kafka).start()


def dated_export(tables: Mapping[str, DataFrame], path: str, export_date: str, only: Mapping[str, Column] | None = None) -> None:
    """W12. One folder per table and date. Exporting a date again replaces just that date."""
    for name, df in tables.items():
        rows = df.filter(only[name]) if only and name in only else df
        rows.write.mode("overwrite").parquet(f"{path}/{name}/export_date={export_date}")
