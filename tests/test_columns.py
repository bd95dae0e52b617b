from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as op
from millrace.functions.similarity import string_similarity
from millrace.functions.vocabulary import CONNECTOR_CATEGORIES


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_bool(spark):
    text = spark.createDataFrame([(x,) for x in ("true", "T", "On", "1", "yes", "false", " t", "", None)], "x string")
    assert values(text, op.normalize_bool(text, "x")) == [True, True, True, True, False, False, False, False, False]
    number = spark.createDataFrame([(1.0,), (0.0,), (2.0,), (None,)], "x double")
    assert values(number, op.normalize_bool(number, "x")) == [True, False, False, False]


def test_int(spark):
    texts = ["42", " 42 ", "42.7", "42abc", "-1.5", "+7", "", "abc", None, "99999999999999999999", " 5"]
    text = spark.createDataFrame([(x,) for x in texts], "x string")
    assert values(text, op.normalize_int(text, "x", 9)) == [42, 42, 42, 42, -1, 7, 9, 9, 9, 9, 5]
    number = spark.createDataFrame([(42.7,), (-1.5,), (float("nan"),), (None,)], "x double")
    assert values(number, op.normalize_int(number, "x", 9)) == [42, -2, 9, 9]


def test_string(spark):
    df = spark.createDataFrame([("a", 42.0, 1.5, True), (None, None, None, None)], "s string, d double, e double, b boolean")
    row, empty = df.select(*[op.normalize_string(df, c, "?").alias(c) for c in df.columns]).collect()
    assert tuple(row) == ("a", "42", "1.5", "?") and tuple(empty) == ("?", "?", "?", "?")


@pytest.mark.parametrize(
    "seconds, text",
    [(45.5, "45s"), (754.0, "12m 34s"), (720.0, "12m"), (12345.0, "3h 25m"), (10800.0, "3h 0m"), (186330.0, "2d 3h 45m"), (0.0, "0s"), (-5.0, "0s"), (None, None)],
)
def test_duration(spark, seconds, text):
    df = spark.createDataFrame([(seconds,)], "s double")
    assert values(df, op.format_duration(F.col("s"))) == [text]


def test_numbers(spark):
    df = spark.createDataFrame([(1234567, 1234.5), (None, None)], "n bigint, c double")
    assert values(df, op.format_count(F.col("n"))) == ["1,234,567", "0"]
    assert values(df, op.format_money(F.col("c"))) == ["$1234.50", "$0.00"]


def test_nested_json(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('"{\\"k\\": 2}"',), ("nonsense",), (None,)], "j string")
    assert values(df, op.decode_nested_json(F.col("j"), "k int")["k"]) == [1, 2, None, None]


def test_categories(spark):
    words = list(CONNECTOR_CATEGORIES)
    df = spark.createDataFrame([(f" {w.upper()} ",) for w in words] + [("unknown",), ("",), (None,)], "w string")
    assert values(df, op.classify_connector(F.col("w"))) == [CONNECTOR_CATEGORIES[w] for w in words] + [-1, -1, -1]
    assert len(words) == 63


def test_split(spark):
    df = spark.createDataFrame([("123, 456 789,,123",), ("  ",)], "t string")
    assert values(df, op.split_ids(F.col("t"))) == [["123", "456", "789"], []]
    cols = spark.createDataFrame([("a, b ,c",), ("*",)], "t string")
    assert values(cols, op.split_columns(F.col("t"))) == [["a", "b", "c"], None]


def test_similarity(spark):
    rows = [("connector", "connectors", 0.9), ("pipeline", "PIPE", 0.5), ("", "", 1.0), ("a", "", 0.0)]
    df = spark.createDataFrame([r[:2] for r in rows], "a string, b string")
    assert values(df, string_similarity(F.col("a"), F.col("b"))) == pytest.approx([r[2] for r in rows])


def test_text_budget(spark):
    df = spark.createDataFrame([("a" * 49_999,), ("a" * 50_000,), ("\U0001f600" * 50_001,)], "t string")
    units = op.utf16_length(F.col("t"))
    assert values(df, units) == [49_999, 50_000, 100_002]
    assert values(df, op.text_level(units)) == ["OK", "MODERATE", "HIGH"]
    assert values(df, op.text_tokens(units)) == [12_500, 12_500, 25_001]


def test_log_lines(spark):
    line = "2024-12-06 14:30:15 [INFO] Starting\nnext [x]"
    df = spark.createDataFrame([(line,), ("no log line",)], "l string")
    first, second = values(df, op.parse_log_line(F.col("l")))
    assert tuple(first) == (datetime(2024, 12, 6, 14, 30, 15), "INFO", "Starting\nnext [x]") and second is None


def test_display(spark):
    df = spark.createDataFrame([(None, [1, None], ("x", None), 2.0, True)], "n string, a array<int>, s struct<p:string,q:int>, d double, b boolean")
    row = df.select(*[op.display_value(df, c).alias(c) for c in df.columns]).head()
    assert tuple(row) == ("-", "[1,null]", '{"p":"x","q":null}', "2", "true")


def test_health_and_status(spark):
    df = spark.createDataFrame([("active", None, 0), ("", "active", 0), ("bad", "active", 0), (None, None, 1), (None, None, None)], "h string, s string, f int")
    assert values(df, op.health_active(F.col("h"), F.col("s"), F.col("f"))) == [True, True, False, True, False]
    words = spark.createDataFrame([("Successful",), ("FAILED",), ("Running",), ("odd",), (None,)], "w string")
    assert values(words, op.normalize_status(F.col("w"))) == ["success", "failed", "running", "odd", None]
