"""Data-quality checks (D1-D7). All rules of a table run in one pass over it."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import hours_between
from millrace.functions.vocabulary import SCREEN_CONFLICTS, SCREEN_NEEDS, SCREENS


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where ``broken`` is true; null counts as not broken."""

    field: str
    message: str
    broken: Column
    severity: str = "error"


def null_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """D1. Total rows and nulls per column, in one aggregate."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    return df.agg(F.count("*").alias("total_rows"), *nulls)


def find_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D2. Keys that occur more than once; counting combines before the shuffle, so a hot key costs one row per task."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).filter(F.col("count") > 1)


def freshness(df: DataFrame, ts: str, now: Column) -> DataFrame:
    """D3. Last update and the whole hours since."""
    return df.agg(F.max(ts).alias("last_update")).withColumn("hours_since_update", hours_between(F.col("last_update"), now))


def _checks(rules: Sequence[Rule]) -> Column:
    """Array with a struct(field, message, severity) per broken rule and a null per kept one."""

    def entry(r: Rule) -> Column:
        found = F.struct(F.lit(r.field).alias("field"), F.lit(r.message).alias("message"), F.lit(r.severity).alias("severity"))
        return F.when(F.coalesce(r.broken, F.lit(False)), found)

    return F.array(*[entry(r) for r in rules])


def validate_rules(df: DataFrame, ids: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """D4. One row (ids, field, message, severity) per broken rule."""
    return df.select(*ids, F.inline(_checks(rules))).filter(F.col("severity").isNotNull())


def mark_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """D4. Add ``findings`` and ``valid``: true when no broken rule is an error."""
    marked = df.withColumn("findings", F.array_compact(_checks(rules)))
    return marked.withColumn("valid", ~F.exists("findings", lambda f: f["severity"] == "error"))


def required(field: str, label: str) -> Rule:
    return Rule(field, f"{label} is required", F.col(field).isNull() | (F.col(field).cast("string") == ""))


def length_between(field: str, label: str, least: int = 3, most: int = 100) -> list[Rule]:
    """D5. Length rules; an empty value is left to the required rule."""
    size = F.length(field)
    return [
        Rule(field, f"{label} must be at least {least} characters", (size > 0) & (size < least)),
        Rule(field, f"{label} must be less than {most} characters", size > most),
    ]


def not_the_same(a: str, b: str, label: str) -> Rule:
    """D5. A warning when two filled columns hold the same value."""
    return Rule(f"{a}, {b}", label, F.col(a) == F.col(b), "warning")


def with_reference(df: DataFrame, column: str, ref: DataFrame, ref_column: str, flag: str) -> DataFrame:
    """D5. Add ``flag``: the value exists in the referenced table. Nulls have no reference to check."""
    keys = ref.select(F.col(ref_column).alias(column)).distinct().withColumn(flag, F.lit(True))
    return df.join(keys, column, "left").withColumn(flag, F.coalesce(flag, F.col(column).isNull()))


def must_exist(field: str, flag: str, label: str) -> Rule:
    return Rule(field, f"{label} not found or inaccessible", ~F.col(flag))


def filled(field: str) -> Rule:
    return Rule(field, f"{field} is empty", F.size(field) == 0, "warning")


def one_of(field: str, item: Column | int | str, others: Sequence, names: Mapping) -> Rule:
    """A warning where a list has ``item`` but none of ``others``, which it builds on."""
    found = [F.array_contains(field, o) for o in others]
    message = f"{names[item]} needs {' or '.join(names[o] for o in others)}"
    return Rule(field, message, F.array_contains(field, item) & ~reduce(operator.or_, found), "warning")


def conflicts(field: str, a, b, names: Mapping) -> Rule:
    """A warning where a list has two items that exclude each other."""
    return Rule(field, f"{names[a]} excludes {names[b]}", F.array_contains(field, a) & F.array_contains(field, b), "warning")


def positive(field: str) -> Rule:
    return Rule(field, f"{field} must be positive numbers", F.exists(field, lambda x: F.coalesce(x < 1, F.lit(True))))


def no_repeats(field: str) -> Rule:
    return Rule(field, f"{field} has repeats", F.size(F.array_distinct(field)) < F.size(field), "warning")


def list_rules(name: str, items: str) -> list[Rule]:
    """D6. A configuration row: a name, and a list of screens that must fit together (see ``SCREEN_NEEDS``)."""
    needs = [one_of(items, item, others, SCREENS) for item, others in SCREEN_NEEDS.items()]
    apart = [conflicts(items, a, b, SCREENS) for a, b in SCREEN_CONFLICTS]
    given = Rule(items, f"{items} is required", F.col(items).isNull())
    return [required(name, name), given, filled(items), positive(items), no_repeats(items), *needs, *apart]


def ok_failed_report(outcomes: DataFrame, id_col: str, ok: Column, message: Column) -> DataFrame:
    """D7. One row per item with its outcome and, beside it, how many items share that outcome.

    The ids stay rows: gathering them into one list per outcome would put the whole table in two cells. The two totals
    come in as a one-row subquery, because a join on the outcome would shuffle the whole table to two tasks.
    """
    outcome = F.when(ok, "ok").otherwise("failed")
    totals = outcomes.agg(F.count_if(outcome == "ok").alias("ok"), F.count_if(outcome == "failed").alias("failed"))
    counted = outcomes.select(outcome.alias("outcome"), F.col(id_col).alias("id"), F.when(~ok, message).alias("message")).withColumn(
        "_n", totals.select(F.struct("ok", "failed")).scalar()
    )
    items = F.when(F.col("outcome") == "ok", F.col("_n.ok")).otherwise(F.col("_n.failed"))
    return counted.withColumn("items", items).drop("_n")
