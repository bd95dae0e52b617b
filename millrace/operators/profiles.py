"""Profiles that add up (Q7, Q10): each load is summarised once, and the profile of a table is the sum of its loads' summaries.

A summary is one row: rows, and for each column its nulls, least and greatest value, a sketch of its distinct values and, for
numbers, one of its quantiles. Summaries merge in any order, so a profile after a load reads that load and no other rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.operators.discover import _ORDERED, _TIMES, _quoted, _sketch, _text
from millrace.sources.store import exists

#: Size of a sketch of quantiles: the rank of a quantile is off by less than one in a hundred of the rows.
QUANTILES = 800

_QUARTILES = "array(0.25D, 0.5D, 0.75D)"


def _summary_of(f: T.StructField) -> str:
    c, ordered, number = _quoted(f.name), isinstance(f.dataType, _ORDERED), isinstance(f.dataType, T.NumericType)
    fields = {
        "null_count": f"count_if({c} IS NULL)",
        "least": f"min({c})" if ordered else "CAST(NULL AS STRING)",
        "most": f"max({c})" if ordered else "CAST(NULL AS STRING)",
        "distinct": _sketch(c) if ordered else "CAST(NULL AS BINARY)",
        "quantiles": f"kll_sketch_agg_double(CAST({c} AS DOUBLE), {QUANTILES})" if number else "CAST(NULL AS BINARY)",
    }
    return f"{_text(f.name)}, named_struct({', '.join(f'{_text(k)}, {v}' for k, v in fields.items())})"


def summarise(df: DataFrame) -> DataFrame:
    """One row: ``row_count`` and ``columns``, a struct with the summary of each column. One pass, combined in the tasks."""
    return df.selectExpr("count(*) AS row_count", f"named_struct({', '.join(map(_summary_of, df.schema))}) AS columns")


def merge_summaries(summaries: DataFrame) -> DataFrame:
    """The one-row summary of all rows that any number of summaries describe.

    A column that a summary does not have is null in all its rows.
    """
    parts = []
    for f in summaries.schema["columns"].dataType:
        at = f"columns.{_quoted(f.name)}"
        quantiles = f"kll_merge_agg_double({at}.quantiles)" if isinstance(f.dataType["least"].dataType, T.NumericType) else "CAST(NULL AS BINARY)"
        parts.append(
            f"{_text(f.name)}, named_struct('null_count', sum(coalesce({at}.null_count, row_count)), 'least', min({at}.least), 'most', max({at}.most), "
            f"'distinct', hll_union_agg({at}.distinct), 'quantiles', {quantiles})"
        )
    return summaries.selectExpr("coalesce(sum(row_count), 0L) AS row_count", f"named_struct({', '.join(parts)}) AS columns")


def profile_rows(summary: DataFrame) -> DataFrame:
    """``row_count, ordinal, column, type, null_count, min_value, max_value, approx_distinct, quartiles`` per column of a
    one-row summary. Quartiles are those of numbers, null where there are none; distinct values are estimated (1.6 %)."""
    rows = []
    for i, f in enumerate(summary.schema["columns"].dataType):
        at, kind = f"columns.{_quoted(f.name)}", f.dataType["least"].dataType
        shown = f"date_format({at}.{{}}, 'yyyy-MM-dd HH:mm:ss')" if isinstance(kind, _TIMES) else f"CAST({at}.{{}} AS STRING)"
        quartiles = "CAST(NULL AS ARRAY<DOUBLE>)"
        if isinstance(kind, T.NumericType):
            quartiles = f"CASE WHEN kll_sketch_get_n_double({at}.quantiles) > 0 THEN kll_sketch_get_quantile_double({at}.quantiles, {_QUARTILES}) END"
        fields = {
            "ordinal": str(i),
            "column": _text(f.name),
            "type": _text(kind.simpleString()),
            "null_count": f"coalesce({at}.null_count, 0L)",
            "min_value": shown.format("least"),
            "max_value": shown.format("most"),
            "approx_distinct": f"coalesce(hll_sketch_estimate({at}.distinct), 0L)",
            "quartiles": quartiles,
        }
        rows.append(f"named_struct({', '.join(f'{_text(k)}, {v}' for k, v in fields.items())})")
    return summary.selectExpr("row_count", f"inline(array({', '.join(rows)}))")


class LoadProfiles:
    """The summaries of a table's loads, one row each, in a folder by load.

    A load that is added again replaces its summary. Columns may come and go between loads; one that changed its type cannot
    be merged, and adding such a load is refused.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _summaries(self) -> DataFrame | None:
        return self.spark.read.option("mergeSchema", "true").parquet(self.path) if exists(self.spark, self.path) else None

    def add(self, load: str, rows: DataFrame) -> None:
        """Summarise the rows of a load; reads these rows only."""
        if (before := self._summaries()) is not None:
            known = {f.name: f.dataType["least"].dataType for f in before.schema["columns"].dataType}
            for f in rows.schema:
                kind = f.dataType if isinstance(f.dataType, _ORDERED) else T.StringType()
                if f.name in known and known[f.name] != kind:
                    raise ValueError(f"column {f.name} was {known[f.name].simpleString()} and is {kind.simpleString()} now")
        one = summarise(rows).selectExpr("*", f"{_text(load)} AS load")
        one.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(self.path)

    def profile(self) -> DataFrame:
        """The profile of all loads together, from their summaries alone (see :func:`profile_rows`)."""
        summaries = self._summaries()
        if summaries is None:
            raise ValueError(f"no load was added at {self.path}")
        return profile_rows(merge_summaries(summaries))
