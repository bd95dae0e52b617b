"""Scalar rules as column expressions (ids X1-X17, X20). All stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.vocabulary import (
    BLANK,
    CATEGORY_NAMES,
    CONNECTOR_CATEGORIES,
    STATUS_WORDS,
    TRUE_WORDS,
    UNKNOWN_CATEGORY,
    WHITESPACE,
)


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def trim_all(c: Column) -> Column:
    """Trim every Unicode blank, not only the space character."""
    return F.btrim(c, F.lit(WHITESPACE))


def number_text(c: Column, data_type: T.DataType) -> Column:
    """Text of a number with no trailing ``.0`` on whole values."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
        return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def normalize_bool(df: DataFrame, name: str) -> Column:
    """X1. Null is false; a number is true only when 1; text is true only for the fixed words, untrimmed."""
    c, data_type = F.col(name), field_type(df, name)
    if isinstance(data_type, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(data_type, T.NumericType):
        return F.coalesce(c == 1, F.lit(False))
    if isinstance(data_type, T.StringType):
        return F.coalesce(F.lower(c).isin(*TRUE_WORDS), F.lit(False))
    return F.lit(False)


def normalize_int(df: DataFrame, name: str, default: int) -> Column:
    """X2. Numbers are floored; text gives its leading integer (so ``-1.5`` the text is -1); else the default.

    Text whose integer does not fit 64 bits also gives the default.
    """
    c, data_type = F.col(name), field_type(df, name)
    fallback = F.lit(default).cast("bigint")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.when(c.isNull() | F.isnan(c), fallback).otherwise(F.floor(c))
    if isinstance(data_type, T.NumericType):
        return F.coalesce(F.floor(c).cast("bigint"), fallback)
    if isinstance(data_type, T.StringType):
        lead = F.regexp_extract(c, rf"^[{BLANK}]*([+-]?[0-9]+)", 1)
        return F.coalesce(F.nullif(lead, F.lit("")).try_cast("bigint"), fallback)
    return fallback


def normalize_string(df: DataFrame, name: str, default: str = "") -> Column:
    """X3. Text as is, numbers as text; null, booleans and anything else give the default."""
    c, data_type = F.col(name), field_type(df, name)
    if isinstance(data_type, T.StringType):
        return F.coalesce(c, F.lit(default))
    if isinstance(data_type, T.NumericType):
        return F.coalesce(number_text(c, data_type), F.lit(default))
    return F.lit(default)


def format_duration(seconds: Column) -> Column:
    """X5. Seconds as ``45s``, ``12m 34s``, ``3h 0m`` or ``2d 5h 30m``; negative gives ``0s``."""

    def unit(size: int, within: int | None, mark: str) -> tuple[Column, Column]:
        amount = F.floor((seconds if within is None else seconds % within) / size).cast("bigint")
        return amount, F.concat(amount.cast("string"), F.lit(mark))

    days, d = unit(86400, None, "d")
    hours, h = unit(3600, 86400, "h")
    minutes, m = unit(60, 3600, "m")
    secs, s = unit(1, 60, "s")
    return (
        F.when(seconds.isNull(), F.lit(None).cast("string"))
        .when(seconds < 0, F.lit("0s"))
        .when(days > 0, F.concat_ws(" ", d, h, m))
        .when(hours > 0, F.concat_ws(" ", h, m))
        .when((minutes > 0) & (secs > 0), F.concat_ws(" ", m, s))
        .when(minutes > 0, m)
        .otherwise(s)
    )


def format_count(c: Column) -> Column:
    """X6. Whole number with thousands separators; a missing counter reads ``0``."""
    return F.format_number(F.coalesce(c, F.lit(0)), 0)


def format_money(c: Column) -> Column:
    """X6. Dollars with two decimals and no separators; a missing cost reads ``$0.00``."""
    return F.concat(F.lit("$"), F.coalesce(c.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).cast("string"))


def decode_nested_json(c: Column, schema: T.StructType | str) -> Column:
    """X7. Parse JSON that may itself be a JSON string holding JSON; text that is neither gives null fields."""
    inner = F.try_variant_get(F.try_parse_json(c), "$", "string")
    return F.from_json(F.coalesce(inner, c), schema)


def classify_connector(c: Column) -> Column:
    """X8. Category number of a connector subtype, ignoring case and outer blanks; unknown gives -1."""
    pairs = [F.lit(x) for word, number in CONNECTOR_CATEGORIES.items() for x in (word, number)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), trim_all(F.lower(c))), F.lit(UNKNOWN_CATEGORY))


def category_name(number: Column) -> Column:
    pairs = [F.lit(x) for key, word in CATEGORY_NAMES.items() for x in (key, word)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), number), F.lit("Unknown"))


def normalize_status(c: Column) -> Column:
    """X9. Map the two status vocabularies to one; words outside both pass through in lower case."""
    word = F.lower(F.trim(c))
    pairs = [F.lit(x) for key, value in STATUS_WORDS.items() for x in (key, value)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), word), word)


def split_ids(c: Column) -> Column:
    """X10. Ids split on commas and blanks, empty ones dropped, first occurrences kept in order."""
    parts = F.split(c, rf"[,{BLANK}]+")
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def split_columns(c: Column) -> Column:
    """X11. ``a, b`` as an array of names; ``*`` means all columns and gives null."""
    return F.when(c != "*", F.transform(F.split(c, ","), trim_all))


def display_value(df: DataFrame, name: str, missing: str = "-") -> Column:
    """X12. Any value as text: JSON for nested values, ISO for timestamps, a mark for null."""
    c, data_type = F.col(f"`{name}`"), field_type(df, name)
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        text = F.to_json(c, {"ignoreNullFields": "false"})
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        # the Z says UTC, so an instant is turned from the session's zone into a UTC clock first
        clock = F.to_utc_timestamp(c, F.current_timezone()) if isinstance(data_type, T.TimestampType) else c
        text = F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    elif isinstance(data_type, T.NumericType):
        text = number_text(c, data_type)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(missing))


def _filled(c: Column) -> Column:
    return F.when(c != "", c)


def entity_identity(user_id, full_name, email, project_id, project_name, institution_id, institution_name) -> Column:
    """X13. struct(kind, id, name) of the first id present; an empty name falls through to the next choice."""

    def named(kind: str, number: Column, *names: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            number.cast("bigint").alias("id"),
            F.coalesce(*[_filled(n) for n in names], F.lit("N/A")).alias("name"),
        )

    none = F.lit(None).cast("bigint")
    return (
        F.when(user_id.isNotNull(), named("User", user_id, full_name, email))
        .when(project_id.isNotNull(), named("Project", project_id, project_name))
        .when(institution_id.isNotNull(), named("Institution", institution_id, institution_name))
        .otherwise(F.struct(F.lit("Usage").alias("kind"), none.alias("id"), F.lit("N/A").alias("name")))
    )


def compute_storage_ratio(compute: Column, storage: Column) -> Column:
    """X14. Compute per unit of storage, with missing or zero storage counted as one."""
    return F.coalesce(compute, F.lit(0.0)) / F.greatest(F.coalesce(storage, F.lit(1.0)), F.lit(1.0))


def hours_between(earlier: Column, now: Column) -> Column:
    """X15. Whole hours from ``earlier`` to ``now``."""
    return F.timestamp_diff("HOUR", earlier, now)


def utf16_length(c: Column) -> Column:
    """Length in UTF-16 units: characters outside the basic plane count twice."""
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("bigint")


def text_tokens(units: Column) -> Column:
    """X16. Estimated tokens of a text of that many units."""
    return F.floor(units * 0.25 + 0.5).cast("bigint")


def text_level(units: Column, threshold: int = 50_000, high: int = 100_000) -> Column:
    """X16. HIGH above ``high``, MODERATE from ``threshold`` on, OK below it."""
    return F.when(units < threshold, "OK").when(units > high, "HIGH").otherwise("MODERATE")


def health_active(health: Column, status: Column, flag: Column) -> Column:
    """X17. Active when the health status (or, where that is empty, the status) says so, or the flag is 1."""
    said = F.coalesce(_filled(health), status)
    return F.coalesce(said == "active", F.lit(False)) | F.coalesce(flag == 1, F.lit(False))


LOG_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \[([A-Za-z]+)\] ([\s\S]*)$"


def format_log_line(ts: Column, level: Column, message: Column) -> Column:
    """X20. ``ts [LEVEL] message``."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" ["), F.upper(level), F.lit("] "), message)


def parse_log_line(line: Column) -> Column:
    """X20. struct(ts, level, message); null where the line does not have that form."""
    part = lambda n: F.regexp_extract(line, LOG_LINE, n)
    return F.when(
        line.rlike(LOG_LINE),
        F.struct(
            F.to_timestamp_ntz(part(1), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
            part(2).alias("level"),
            part(3).alias("message"),
        ),
    )
