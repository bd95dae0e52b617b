"""Profiles summed from the summaries of loads."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.profiles import LoadProfiles


def test_profile_of_loads_is_that_of_the_table(spark, folder):
    rows = spark.range(9_000).select(
        "id", (F.col("id") % 700).cast("int").alias("a b"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("s"), F.array("id").alias("list")
    )
    profiles = LoadProfiles(spark, folder)
    for load in (0, 1, 2, 2):  # the last one again
        profiles.add(f"l/{load}", rows.filter(F.col("id") % 3 == load))
    found = {r.column: r for r in profiles.profile().collect()}
    assert {r.row_count for r in found.values()} == {9_000} and [found[c].null_count for c in ("id", "a b", "s", "list")] == [0, 0, 3_000, 0]
    assert (found["id"].min_value, found["id"].max_value, found["s"].max_value, found["list"].min_value) == ("0", "8999", "998", None)
    for column, distinct in (("id", 9_000), ("a b", 700), ("s", 6_000)):
        assert abs(found[column].approx_distinct - distinct) < 0.08 * distinct
    assert all(abs(q - w) < 0.01 * 9_000 for q, w in zip(found["id"].quartiles, (2_250, 4_500, 6_750)))


def test_only_the_new_load_is_read(spark, folder):
    profiles = LoadProfiles(spark, f"{folder}/profiles")
    for load, at in ((1, 0), (2, 100)):
        spark.range(at, at + 100).write.parquet(f"{folder}/rows{load}")
        profiles.add(str(load), spark.read.parquet(f"{folder}/rows{load}"))
    assert not [f for f in profiles.profile().inputFiles() if "/rows" in f]
    assert profiles.profile().head().max_value == "199"


def test_columns_come_and_go(spark, folder):
    profiles = LoadProfiles(spark, folder)
    with pytest.raises(ValueError):
        profiles.profile()
    profiles.add("1", spark.createDataFrame([(1, None)], "a int, b double"))
    profiles.add("2", spark.createDataFrame([("x",), (None,)], "c string"))
    profiles.add("3", spark.createDataFrame([], "a int"))
    found = {r.column: (r.row_count, r.null_count, r.min_value, r.quartiles) for r in profiles.profile().collect()}
    assert found == {"a": (3, 2, "1", [1.0, 1.0, 1.0]), "b": (3, 3, None, None), "c": (3, 2, "x", None)}
    with pytest.raises(ValueError, match="column a was int"):
        profiles.add("4", spark.createDataFrame([("1",)], "a string"))
