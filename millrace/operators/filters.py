"""Row filters (F1-F20). Each takes and returns a DataFrame, so filters chain and reach the scan as one predicate."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import classify_connector, number_text, trim_all
from millrace.functions.similarity import fuzzy_subsequence
from millrace.functions.vocabulary import NAME_FIELDS, PROJECT_FIELDS, TYPE_FIELDS

Filter = Callable[[DataFrame], DataFrame]


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _present_text(df: DataFrame, names: Iterable[str]) -> list[Column]:
    """The listed text columns the DataFrame has, in the listed order, with null never matching."""
    types = {f.name: f.dataType for f in df.schema}
    return [F.col(n) for n in names if isinstance(types.get(n), T.StringType)]


def is_valid_regex(spark: SparkSession, pattern: str) -> bool:
    """Ask the engine itself, so that the dialect judged is the one that will run."""
    try:
        spark.sql("SELECT 'x' RLIKE :p", args={"p": pattern}).head()
    except PySparkException:
        return False
    return True


def name_predicate(df: DataFrame, pattern: str, ignore_case=True, use_regex=False, trim=True) -> Column:
    wanted = pattern.strip() if trim else pattern
    regex = use_regex and is_valid_regex(df.sparkSession, wanted)
    if ignore_case and not use_regex:
        wanted = wanted.lower()

    def match(c: Column) -> Column:
        c = trim_all(c) if trim else c
        if regex:
            hit = c.rlike(f"(?i){wanted}" if ignore_case else wanted)
        else:
            hit = (F.lower(c) if ignore_case else c).contains(wanted)
        return F.coalesce(hit, F.lit(False))

    return _any(match(c) for c in _present_text(df, NAME_FIELDS))


def filter_name(df: DataFrame, pattern: str, *, ignore_case=True, use_regex=False, trim=True) -> DataFrame:
    """F1, F2. Rows whose name columns contain the pattern, or match it as a regular expression.

    An invalid expression falls back to a substring test of the lower-cased value against the raw pattern.
    """
    return df.filter(name_predicate(df, pattern, ignore_case, use_regex, trim))


def field_predicate(df: DataFrame, field: str, value: Any, ignore_case=True, trim=True) -> Column:
    if field not in df.columns:
        return F.lit(False)
    c, data_type = F.col(field), df.schema[field].dataType
    if value is None:
        return c.isNull()
    is_text = isinstance(data_type, T.StringType)
    if isinstance(value, str):
        if not is_text:
            return F.lit(False)
        wanted = value.strip() if trim else value
        c = trim_all(c) if trim else c
        if ignore_case:
            c, wanted = F.lower(c), wanted.lower()
        return F.coalesce(c.contains(wanted), F.lit(False))
    fits = isinstance(data_type, T.BooleanType if isinstance(value, bool) else T.NumericType)
    return F.coalesce(c == F.lit(value), F.lit(False)) if fits else F.lit(False)


def filter_field(df: DataFrame, field: str, value: Any, *, ignore_case=True, trim=True) -> DataFrame:
    """F3. Text columns: equal or containing. Others: equal, null equal to null. An unknown column matches nothing."""
    return df.filter(field_predicate(df, field, value, ignore_case, trim))


def type_predicate(df: DataFrame, wanted: str, ignore_case=True) -> Column:
    text = wanted.lower() if ignore_case else wanted
    return _any(
        F.coalesce((F.lower(c) if ignore_case else c).contains(text), F.lit(False))
        for c in _present_text(df, TYPE_FIELDS)
    )


def filter_type(df: DataFrame, wanted: str, *, ignore_case=True) -> DataFrame:
    """F4. Rows whose type columns contain the word; values are not trimmed."""
    return df.filter(type_predicate(df, wanted, ignore_case))


def filter_status(df: DataFrame, status: str, *, ignore_case=True) -> DataFrame:
    """F5. Status containing the word, so ``active`` also finds ``inactive``."""
    return filter_field(df, "status", status, ignore_case=ignore_case)


def status_equals(df: DataFrame, status: str) -> DataFrame:
    """F5, exact variant."""
    return df.filter(F.lower(trim_all(F.col("status"))) == status.strip().lower())


def filter_project(df: DataFrame, project: str) -> DataFrame:
    """F6. Exact match in any project column."""
    return df.filter(_any(F.coalesce(c == project, F.lit(False)) for c in _present_text(df, PROJECT_FIELDS)))


def filter_regex(df: DataFrame, field: str, pattern: str, *, ignore_case=True) -> DataFrame:
    """F7. Regular expression on one column of any type; null reads as the text ``null``; invalid matches nothing."""
    if field not in df.columns or not is_valid_regex(df.sparkSession, pattern):
        return df.filter(F.lit(False))
    c, data_type = F.col(field), df.schema[field].dataType
    text = number_text(c, data_type) if isinstance(data_type, T.NumericType) else c.cast("string")
    return df.filter(F.coalesce(text, F.lit("null")).rlike(f"(?i){pattern}" if ignore_case else pattern))


def filter_all(df: DataFrame, filters: Iterable[Filter]) -> DataFrame:
    """F8. All filters, left to right; none leaves the rows as they are."""
    return reduce(lambda d, f: d.transform(f), filters, df)


def build_filter(*, name=None, name_pattern=None, type=None, status=None, project=None, ignore_case=True) -> Filter:
    """F9. One filter from the options given; empty options are skipped."""
    steps: list[Filter] = []
    if name:
        steps.append(lambda d: filter_name(d, name, ignore_case=ignore_case))
    if name_pattern:
        steps.append(lambda d: filter_name(d, name_pattern, ignore_case=ignore_case, use_regex=True))
    if type:
        steps.append(lambda d: filter_type(d, type, ignore_case=ignore_case))
    if status:
        steps.append(lambda d: filter_status(d, status, ignore_case=ignore_case))
    if project:
        steps.append(lambda d: filter_project(d, project))
    return lambda d: filter_all(d, steps)


def search_connectors(df: DataFrame, query=None, *, name=None, regex=False, type=None, status=None, ignore_case=True):
    """F10. Search by a free word or by options; the free word wins over ``name``."""
    word = query or name
    key = "name_pattern" if regex else "name"
    return build_filter(**{key: word}, type=type, status=status, ignore_case=ignore_case)(df)


def search_report(df: DataFrame, found: Column) -> DataFrame:
    """F10. ``matched`` of ``total`` in one pass over the table."""
    return df.agg(F.count_if(found).alias("matched"), F.count("*").alias("total"))


def filter_default_status(df: DataFrame, status: str, *, status_col="status", deleted_col="deleted") -> DataFrame:
    """F11. Missing or empty status reads ``inactive`` for deleted rows, else ``active``; compared ignoring case."""
    given = F.when(F.col(status_col) != "", F.col(status_col))
    implied = F.when(F.coalesce(F.col(deleted_col), F.lit(False)), "inactive").otherwise("active")
    return df.filter(F.lower(F.coalesce(given, implied)) == status.lower())


def filter_flags(df: DataFrame, **flags: Any) -> DataFrame:
    """F12. Plain equalities, which the scan can push down; options left at None are ignored."""
    return filter_all(df, [lambda d, k=k, v=v: d.filter(F.col(k) == F.lit(v)) for k, v in flags.items() if v is not None])


def filter_run_logs(logs: DataFrame, entity: str, run: str, order: str, run_id=None) -> DataFrame:
    """F13. Log rows of one run; 0 or None means each entity's latest run, the one with the newest log row.

    The many log rows of a run are first combined to one in each task; only those are compared across runs.
    """
    if run_id not in (None, 0, "0"):
        return logs.filter(F.col(run) == F.lit(run_id))
    newest = logs.groupBy(entity, run).agg(F.max(order).alias("_newest"))
    latest = newest.groupBy(entity).agg(F.max_by(run, F.struct("_newest", run)).alias(run))
    return logs.join(latest, [entity, run], "left_semi")


def filter_failures(df: DataFrame, status="status", errors: str | None = None) -> DataFrame:
    """F14. Failed rows, or rows that counted errors."""
    bad = F.col(status) == "failed"
    return df.filter(bad | (F.col(errors) > 0) if errors else bad)


def filter_since(df: DataFrame, ts: str, since: Column) -> DataFrame:
    """F15. Rows at or after a moment that the caller gives."""
    return df.filter(F.col(ts) >= since)


def filter_inactive(df: DataFrame, last_activity: str, before: Column) -> DataFrame:
    """F16. No activity since a moment; never active counts as inactive."""
    return df.filter(F.col(last_activity).isNull() | (F.col(last_activity) < before))


def filter_recent_active(df: DataFrame, last_activity: str, now: Column, days: int = 30) -> DataFrame:
    """F17. Activity within the last days; never active is left out."""
    return df.filter(F.col(last_activity) > now - F.make_interval(days=F.lit(days)))


def filter_error_status(df: DataFrame, status: str = "status") -> DataFrame:
    """F18. Status exactly ``error``."""
    return df.filter(F.col(status) == "error")


def filter_fuzzy(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """F19. Rows whose text holds the pattern's characters in order."""
    return df.filter(fuzzy_subsequence(F.col(column), pattern))


DATABASES = (1, 2)  # relational and big-data categories


def capability_filter(df: DataFrame, subtype: str, categories: Iterable[int] = DATABASES) -> DataFrame:
    """F20. Rows whose connector subtype belongs to one of the categories."""
    return df.filter(classify_connector(F.col(subtype)).isin(*categories))


def possible_targets(df: DataFrame, id_col: str, source_id) -> DataFrame:
    """F20. Every connector but the source can be the target; ids are compared as text."""
    return df.filter(F.col(id_col).cast("string") != str(source_id))
