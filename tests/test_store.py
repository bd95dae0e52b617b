"""Keyed tables: merges are idempotent and move only the source, any split of the changes gives the same table."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import ingest as op
from millrace.sources.store import KEY, KeyedTable, LoadTable, MarkTable

START = datetime(2024, 1, 1)


def table(store):
    return sorted(tuple(r) for r in store.read().collect())


def test_loads_and_earlier_loads(spark, folder):
    store = KeyedTable(spark, folder, ["k"], buckets=3)
    assert store.read() is None and store.loads() == [] and store.rows_of(spark.range(1).toDF("k")) is None
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert store.replace(one) == 1
    assert store.merge(spark.createDataFrame([(3, "c", True)], "k int, v string, extra boolean")) == 2
    assert sorted(map(str, table(store))) == ["(1, 'a', None)", "(2, 'b', None)", "(3, 'c', True)"]
    assert sorted(tuple(r) for r in store.read(1).collect()) == [(1, "a"), (2, "b")]
    assert store.replace(spark.createDataFrame([(9,)], "k int")) == 3
    assert table(KeyedTable(spark, folder, ["k"])) == [(9,)]
    assert store.loads() == [2, 3]  # the first has gone
    with pytest.raises(ValueError, match="no load 1"):
        store.read(1)
    with pytest.raises(ValueError, match="no columns"):
        KeyedTable(spark, folder, ["v"]).read()


def test_merge_twice_is_once(spark, folder):
    store = KeyedTable(spark, folder, ["k"], buckets=3)
    store.replace(spark.range(20).select(F.col("id").cast("int").alias("k"), F.lit("old").alias("v")))
    new = spark.createDataFrame([(3, "new"), (40, "new")], "k int, v string")
    store.merge(new)
    once = table(store)
    store.merge(new)
    assert table(store) == once and len(once) == 21 and (3, "new") in once and (40, "new") in once


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_the_source_is_shuffled(spark, folder):
    store = KeyedTable(spark, folder, ["k"], buckets=5)
    store.replace(spark.range(1000).selectExpr("id AS k", "'old' AS v"))
    new = store._keyed(spark.range(10).selectExpr("id AS k", "'new' AS w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for how in ("full", "left_anti", "left_semi"):
            plan = plan_of(store._open(store._folder()).join(new, KEY, how))
            assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len({r[0] for r in store._open(store._folder()).select(F.input_file_name()).distinct().collect()}) <= 5


def test_a_load_that_died_is_not_read(spark, folder):
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    store = KeyedTable(spark, folder, ["k"], buckets=2)
    store.replace(rows)
    rows.union(rows).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/000000002-2")
    again = KeyedTable(spark, folder, ["k"])
    assert table(again) == [(1, "a")]
    again.merge(spark.createDataFrame([(2, "b")], "k int, v string"))
    assert table(again) == [(1, "a"), (2, "b")]


def test_a_table_can_be_emptied(spark, folder):
    store = KeyedTable(spark, folder, ["k"], buckets=2)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert store.replace_rows(rows) == 0
    store.replace(rows)
    store.replace_rows(rows)
    assert table(store) == [] and store.read().columns == ["k", "v"]
    store.merge(rows.filter("k = 1"))
    assert table(store) == [(1, "a")]


def test_keys_that_look_alike_are_told_apart(spark, folder):
    store = KeyedTable(spark, folder, ["a", "b"], buckets=2)
    given = [("x", "y"), ("xy", ""), ("", "xy"), (None, "xy"), ("xy", None), (None, None), ("", ""), ("-", None)]
    rows = spark.createDataFrame([(*g, i) for i, g in enumerate(given)], "a string, b string, n int")
    store.replace(rows)
    store.merge(rows.withColumn("n", F.col("n") + 100))
    assert sorted(r.n for r in store.read().collect()) == list(range(100, 100 + len(given)))


def test_a_changed_type_is_refused_before_anything_is_written(spark, folder):
    one, other = spark.createDataFrame([(1, 2)], "k int, v int"), spark.createDataFrame([(1, "x")], "k int, v string")
    store, added = KeyedTable(spark, f"{folder}/k", ["k"], buckets=2), LoadTable(spark, f"{folder}/l")
    store.replace(one)
    added.add(one, "1")
    for act in (lambda: store.merge(other), lambda: store.replace_rows(other, other), lambda: added.add(other, "2")):
        with pytest.raises(TypeError, match="column v is int in the table and string in the load"):
            act()
    assert table(store) == [(1, 2)] and [tuple(r) for r in added.read().collect()] == [(1, 2)]
    store.replace(other)
    assert table(store) == [(1, "x")]


def test_order_decides_and_null_is_least(spark, folder):
    store = KeyedTable(spark, folder, ["k"], buckets=2)
    make = lambda *rows: spark.createDataFrame(rows, "k int, seq int, v string")
    store.replace(make((1, 5, "a"), (2, None, "b"), (3, 5, "c")))
    store.merge(make((1, 4, "older"), (2, 0, "newer"), (3, 5, "equal"), (4, None, "first")), "seq")
    assert sorted(r.v for r in store.read().collect()) == ["a", "c", "first", "newer"]


def test_loads_are_added_once(spark, folder):
    loads = LoadTable(spark, folder)
    assert loads.read() is None
    one = spark.createDataFrame([(1,), (1,)], "k int")
    for load in ("a", "a", "b"):
        loads.add(one, load)
    loads.add(spark.createDataFrame([(2, "x")], "k int, extra string"), "c")
    assert sorted(map(tuple, loads.read().collect()), key=str) == [(1, None)] * 4 + [(2, "x")]


def test_a_replayed_history_changes_nothing(spark, folder):
    store = KeyedTable(spark, folder, ["k"], buckets=2)
    rows = spark.createDataFrame([(1, START, "a"), (1, START + timedelta(1), "b"), (2, START, "c"), (1, None, "lost")], "k int, t timestamp_ntz, v string")
    seen = []
    for _ in range(3):
        op.ingest_historical(store, rows, "t", ["v"])
        seen.append([sorted(map(str, x.read().collect())) for x in (store, op.undated(store), op.observations(store))])
    assert seen[0] == seen[1] == seen[2] and [len(x) for x in seen[0]] == [3, 1, 3]


def test_delta_moves_the_mark_and_rereads_days(spark, folder):
    store, marks = KeyedTable(spark, f"{folder}/t", ["k"], buckets=2), MarkTable(spark, f"{folder}/m")
    rows = lambda *days: spark.createDataFrame([(d, START + timedelta(days=d)) for d in days], "k int, ts timestamp_ntz")
    assert marks.get("t") is None
    op.ingest_delta(store, rows(1, 5), "ts", marks, "t")
    assert marks.get("t").startswith("2024-01-06 00:00:00")
    op.ingest_delta(store, rows(1, 4, 5), "ts", marks, "t")
    assert [k for k, _ in table(store)] == [1, 5]
    assert not op.has_changes(rows(1, 5), "ts", marks.get("t")) and op.has_changes(rows(6), "ts", marks.get("t"))
    op.ingest_delta(store, rows(4, 5, 7), "ts", marks, "t", backload_days=2)
    assert [k for k, _ in table(store)] == [1, 4, 5, 7]
    op.ingest_delta(store, rows(4), "ts", marks, "t", backload_days=10)
    assert marks.get("t").startswith("2024-01-08")


@pytest.mark.parametrize("seed", [1, 2])
def test_cdc_any_split_and_order_gives_the_same_table(spark, folder, seed):
    rng = random.Random(seed)
    changes = [(rng.randint(1, 8), f"v{i}", rng.choice("IUUD"), i) for i in range(40)]
    final = {}
    for k, v, o, seq in changes:
        final[k] = (o, v)
    wanted = sorted((k, v) for k, (o, v) in final.items() if o != "D")
    rng.shuffle(changes)
    store, schema = KeyedTable(spark, folder, ["k"], buckets=3), "k int, v string, op string, seq int"
    cuts = sorted(rng.sample(range(1, 40), 2))
    for part in (changes[: cuts[0]], changes[cuts[0] : cuts[1]], changes[cuts[1] :], changes[: cuts[1]]):
        op.ingest_cdc(store, spark.createDataFrame(part, schema), "op", "seq")
    assert sorted(tuple(r) for r in op.live_rows(store.read(), "op", "seq").collect()) == wanted


def history(rows):
    """Plain SCD-2 of (key, time, value) rows."""
    out = []
    for key in sorted({r[0] for r in rows}):
        runs = []
        for _, t, v in sorted(r for r in rows if r[0] == key):
            if not runs or runs[-1][0] != v:
                runs.append((v, t))
        ends = [t for _, t in runs[1:]] + [None]
        out += [(key, v, t, e, e is None) for (v, t), e in zip(runs, ends)]
    return sorted(out, key=str)


def random_history(n, seed):
    """A key with most of the rows, bursts in time, and null values."""
    rng, rows = random.Random(seed), {}
    for _ in range(n):
        key = 1 if rng.random() < 0.6 else rng.randint(2, 6)
        burst = rng.choice([0, 0, 0, 1000, 100_000])
        rows[(key, START + timedelta(seconds=burst + rng.randint(0, 300)))] = rng.choice(["a", "b", None])
    return [(k, t, v) for (k, t), v in rows.items()]


@pytest.mark.parametrize("hot_rows", [10**9, 100, 20, 3])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_scd2(spark, hot_rows, kind):
    rows = random_history(400, 5)
    df = spark.createDataFrame(rows, f"k int, t {kind}, v string")
    found = [tuple(r) for r in op.scd2(df, ["k"], "t", ["v"], hot_rows).collect()]
    assert sorted(found, key=str) == history(rows)


def test_scd2_in_two_loads_and_again(spark, folder):
    rows = random_history(120, 6)
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, v string")
    store, half = KeyedTable(spark, folder, ["k"], buckets=2), F.col("t") < F.lit(START + timedelta(seconds=150)).cast("timestamp_ntz")
    for part in (df.filter(half), df.filter(~half), df.filter(~half)):
        op.ingest_historical(store, part, "t", ["v"])
    assert sorted((tuple(r) for r in store.read().collect()), key=str) == history(rows)


def test_artifact_defaults_and_aliases():
    a = op.artifact_from_config({"sourceObjectName": "t", "columns": "*"})
    assert (a.target, a.columns, a.ingestion_type, a.backload_days, a.snapshot_retention) == ("t", None, "snapshot", 0, 3)
    assert not (a.auto_explode or a.detect_deletes or a.priority or a.replace_table)
    b = op.artifact_from_config(
        {"sourceTable": "s", "targetTable": "t", "columns": "a, b", "mode": "incremental", "primaryKey": "id", "timestampColumn": "u",
         "backloadNumDays": "30", "snapshotRetentionPeriod": "7", "autoExplode": "on", "priority": 1, "detectDeletes": "yes"}
    )
    assert (b.columns, b.ingestion_type, b.merge_columns, b.watermark) == (["a", "b"], "delta", ["id"], "u")
    assert (b.backload_days, b.snapshot_retention, b.auto_explode, b.priority, b.detect_deletes) == (30, 7, True, True, False)
    with pytest.raises(ValueError):
        op.artifact_from_config({"sourceTable": "s", "mode": "sideways"})


def test_multi_table_sync_options(spark, folder):
    spark.createDataFrame([(1, [1, 2]), (2, [])], "id int, tags array<int>").createOrReplaceTempView("sync_src")
    load = lambda **o: op.multi_table_sync(spark, [op.Artifact("sync_src", "out", merge_columns=["id"], **o)], folder, "1").head()
    assert load(ingestion_type="upsert", auto_explode=True).row_count == 2
    assert KeyedTable(spark, f"{folder}/out__tags", ["id"]).read().count() == 2
    spark.createDataFrame([(2, [3])], "id int, tags array<int>").createOrReplaceTempView("sync_src")
    assert load(ingestion_type="upsert", detect_deletes=True).row_count == 1
    bad = load(ingestion_type="upsert", steps=[{"explode": "tags"}])
    assert not bad.success and "unknown step" in bad.message


def test_fail_fast(spark):
    df = spark.createDataFrame([("1",), ("x",)], "n string")
    good, bad = op.split_outcome(df, {"n": "int"})
    assert [r.n for r in good.collect()] == [1] and [r._errors for r in bad.collect()] == [["n is not int: x"]]
    with pytest.raises(Exception, match="n is not int: x"):
        op.split_outcome(df, {"n": "int"}, fail_fast=True)[0].collect()
