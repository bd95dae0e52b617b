import pytest

from millrace.operators import filters as op

CONNECTORS = [
    ("1", "PostgreSQL-prod", "database", "active", 42, None),
    ("2", "postgres-dev", "database", "inactive", 42, "x"),
    ("3", "Snowflake-prod", "cloud", "Active", 7, "y"),
    ("4", " MySQL", "database", "inactive", None, "z"),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(CONNECTORS, "id string, connectorName string, connectorType string, status string, count int, note string")


def ids(rows):
    return sorted(r["id"] for r in rows.collect())


def test_name(df):
    assert ids(op.filter_name(df, "postgres")) == ["1", "2"]
    assert ids(op.filter_name(df, "postgres", ignore_case=False)) == ["2"]
    assert ids(op.filter_name(df, "^mysql", use_regex=True)) == ["4"]
    assert ids(op.filter_name(df, "^mysql", use_regex=True, trim=False)) == []
    assert ids(op.filter_name(df, "", use_regex=False)) == ["1", "2", "3", "4"]


def test_name_bad_regex_falls_back_to_substring(df, spark):
    odd = spark.createDataFrame([("5", "a(b"), ("6", "A(B")], "id string, name string")
    assert ids(op.filter_name(odd, "a(b", use_regex=True)) == ["5", "6"]
    assert ids(op.filter_name(odd, "A(B", use_regex=True)) == []


def test_field(df):
    assert ids(op.filter_field(df, "status", "ACTIVE")) == ["1", "2", "3", "4"]
    assert ids(op.filter_field(df, "status", "ACTIVE", ignore_case=False)) == []
    assert ids(op.filter_field(df, "count", 42)) == ["1", "2"]
    assert ids(op.filter_field(df, "count", "42")) == []
    assert ids(op.filter_field(df, "note", None)) == ["1"]
    assert ids(op.filter_field(df, "nothing", "x")) == []


def test_regex(df):
    assert ids(op.filter_regex(df, "connectorName", ".*-prod$")) == ["1", "3"]
    assert ids(op.filter_regex(df, "connectorName", "(invalid[")) == []
    assert ids(op.filter_regex(df, "count", "null")) == ["4"]
    assert ids(op.filter_regex(df, "nothing", ".*")) == []


def test_type_project_and_build(df, spark):
    assert ids(op.filter_type(df, "DATA")) == ["1", "2", "4"]
    assert ids(op.filter_all(df, [])) == ["1", "2", "3", "4"]
    assert ids(op.build_filter(name="prod", type="database")(df)) == ["1"]
    assert ids(op.filter_project(df, "x")) == []
    assert ids(op.search_connectors(df, "prod", regex=True, type="cloud")) == ["3"]
    assert ids(op.possible_targets(df, "id", 2)) == ["1", "3", "4"]


def test_fuzzy_subsequence(spark):
    df = spark.createDataFrame([("connectors",), ("a.c\nx",), (None,)], "id string")
    assert ids(op.filter_fuzzy(df, "id", "con")) == ["connectors"]
    assert ids(op.filter_fuzzy(df, "id", "CNR")) == ["connectors"]
    assert ids(op.filter_fuzzy(df, "id", "crt")) == []
    assert ids(op.filter_fuzzy(df, "id", ".X")) == ["a.c\nx"]
    assert ids(op.filter_fuzzy(df, "id", "")) == ["a.c\nx", "connectors"]
    for ch in "]^-\\[&|":
        one = spark.createDataFrame([(f"a{ch}b",)], "id string")
        assert ids(op.filter_fuzzy(one, "id", f"{ch}b")) == [f"a{ch}b"], ch
        assert ids(op.filter_fuzzy(one, "id", f"b{ch}")) == [], ch


def test_filter_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = op.filter_flags(df, o_orderstatus="F")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan
