"""Key search by levels against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import discover


def least_key(rows, widest):
    columns = range(len(rows[0]))
    for width in range(2, widest + 1):
        for some in itertools.combinations(columns, width):
            if len({tuple(r[i] for i in some) for r in rows}) == len(rows):
                return [f"c{i}" for i in some]
    return None


@pytest.mark.parametrize("seed", [1, 3])
def test_least_key_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, 5, 8, 20]) for _ in range(7)]
    rows = list({tuple(rng.randrange(s) for s in sizes) for _ in range(40)})
    df = spark.createDataFrame(rows, ", ".join(f"c{i} long" for i in range(7)))
    profiles = discover.profile_tables({"t": df})
    if profiles.filter("is_unique").isEmpty():
        for near in (discover.NEARLY_UNIQUE, 0):
            found = discover.key_columns({"t": df}, profiles, widest=3, near=near).collect()
            assert [r.key for r in found] == ([k] if (k := least_key(rows, 3)) else [])


def test_key_of_three_among_two_hundred_columns(spark):
    parts = [(F.col("id") % 20).alias("a"), (F.floor(F.col("id") / 20) % 20).alias("b"), F.floor(F.col("id") / 400).cast("string").alias("c")]
    noise = [(F.xxhash64("id", F.lit(i)) % (2 + i % 7)).alias(f"n{i}") for i in range(197)]
    df = spark.range(6_000).select(*noise[:90], parts[0], *noise[90:120], parts[1], parts[2], *noise[120:]).cache()
    # what the other columns say together identifies the rows as well, but takes more of them
    profiles = discover.profile_tables({"t": df})
    assert [r.key for r in discover.key_columns({"t": df}, profiles, widest=3).collect()] == [["a", "b", "c"]]


@pytest.mark.parametrize("rows, key", [([(1, 1), (1, 1)], None), ([(1, None), (1, 2), (2, 2)], None), ([(1, 1), (1, 2), (2, 1)], ["c0", "c1"]), ([], None)])
def test_keys_of_odd_tables(spark, rows, key):
    df = spark.createDataFrame(rows, "c0 long, c1 long")
    found = discover.key_columns({"t": df}, discover.profile_tables({"t": df})).collect()
    assert [r.key for r in found] == ([key] if key else [])
