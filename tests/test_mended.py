"""Cases that once gave wrong results, mostly beside the paths the queries take."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import columns
from millrace.operators import discover, fuzzy, ingest, runs, shape, usage
from millrace.operators.sliced import with_slices
from millrace.plans import REGISTRY
from millrace.plans.registry import Tables
from millrace.sources import readers
from millrace.sources.store import KeyedTable, LoadTable, MarkTable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# The table store


def test_the_number_of_buckets_is_stored(spark, folder):
    one = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    KeyedTable(spark, folder, ["k"], buckets=4).replace(one)
    again = KeyedTable(spark, folder, ["k"], buckets=64)
    again.merge(one.filter("k < 3").withColumn("v", F.lit("new")))
    assert again.read().count() == 100 and again.read().filter("v = 'new'").count() == 3
    assert {f.split("-")[1] for f in os.listdir(folder.removeprefix("file:")) if f[0] == "0"} == {"4"}


def test_null_keys_are_keys(spark, folder):
    store = KeyedTable(spark, folder, ["k"], buckets=3)
    some = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    for _ in range(3):
        store.merge(some)
    assert rows(store.read()) == [(1, "b"), (None, "a")]
    assert rows(ingest.detect_deletes(some, some, ["k"])) == rows(some)
    assert shape.added_removed(some, some, ["k"]).count() == 0
    diff = shape.table_diff(some, some, ["k"], ["v"], only_changed=False)
    assert {r.status for r in diff.collect()} == {"unchanged"} and diff.count() == 2
    store.replace_rows(some.filter("k IS NULL"))
    assert rows(store.read()) == [(1, "b")]


def test_jobs_of_the_flagship_load(spark):
    t, tracker = Tables(spark, "/root/testdata/sf0.001"), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("flagship", "")
    REGISTRY["I3_delta_then_daily_revenue"].run(t).collect()
    spark.sparkContext.setJobGroup("other", "")
    assert len(tracker.getJobIdsForGroup("flagship")) <= 25


# Loads


def test_marks_of_many_artifacts_side_by_side(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: MarkTable(spark, folder).put(f"a{i}", str(i)), range(40)))
    assert [MarkTable(spark, folder).get(f"a{i}") for i in range(40)] == [str(i) for i in range(40)]


def test_every_failure_is_an_outcome(spark, folder):
    found = ingest.multi_table_sync(spark, [ingest.Artifact("none", "t", slots="x", query="SELECT 1 AS id", ingestion_type="upsert", merge_columns=["id"])], folder, "1").head()
    assert not found.success and found.message


def test_history_does_not_depend_on_the_split(spark, folder):
    at = lambda day: datetime(2024, 1, day)
    seen = [("k", at(1), "a"), ("k", at(3), "a"), ("k", at(2), "b"), ("k", None, "z"), (None, at(1), "n")]
    make = lambda part: spark.createDataFrame(part, "k string, t timestamp_ntz, v string")
    results = []
    for i, split in enumerate([[seen], [seen[:2], seen[2:]], [seen[2:], seen[:2]], [[x] for x in reversed(seen)]]):
        store = KeyedTable(spark, f"{folder}/{i}", ["k"], buckets=2)
        for part in split:
            ingest.ingest_historical(store, make(part), "t", ["v"])
        results.append(rows(store.read()))
        assert rows(ingest.undated(store).read()) == [("k", "z", None)]
    assert all(r == results[0] for r in results) and ("k", "a", at(3), None, True) in results[0] and len(results[0]) == 4


def test_text_cannot_order_a_history(spark):
    df = spark.createDataFrame([(1, "x", "v")], "k int, t string, v string")
    for hot in (1, 10**9):
        with pytest.raises(ValueError, match="number or a time"):
            ingest.scd2(df, ["k"], "t", ["v"], hot)


def test_many_slices_of_a_burst(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 19_000, F.col("id") / 1e6).otherwise(F.col("id")).alias("t"))
    found = with_slices(df, "t", 200).groupBy("_slice").agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("b")).orderBy("_slice").collect()
    assert len(found) > 150 and max(r.n for r in found) < 1000
    assert all(x.b < y.a for x, y in zip(found, found[1:]))


def test_snapshots_by_number_are_removed(spark, folder):
    for i in range(8, 13):
        ingest.ingest_snapshot(spark.range(i), folder, f"s{i}")
    kept = ingest.snapshot_retention(spark.read.parquet(folder), 3).select("_snapshot_id").distinct()
    assert rows(kept) == [("s10",), ("s11",), ("s12",)]
    assert ingest.retain_snapshots(spark, folder, 3) == ["s8", "s9"]
    assert sorted(d for d in os.listdir(folder.removeprefix("file:")) if "=" in d) == [f"_snapshot_id=s{i}" for i in (10, 11, 12)]


def test_number_marks(spark):
    df = spark.createDataFrame([(9,), (10,), (None,)], "n long")
    assert rows(ingest.watermark_filter(df, "n", None)) == [(10,), (9,)]
    assert rows(ingest.watermark_filter(df, "n", "9")) == [(10,)]
    assert ingest.watermark_advance(df, "n") == "10"
    with pytest.raises(ValueError):
        ingest.watermark_filter(df, "n", "9", backload_days=1)


def test_child_tables_grow_with_their_parents(spark, folder):
    load = lambda kind, i: ingest.load_artifact(spark, ingest.Artifact("kids", "t", ingestion_type=kind, merge_columns=["id"], auto_explode=True), f"{folder}/{kind}", str(i))
    read = lambda kind: rows((LoadTable(spark, f"{folder}/{kind}/t__tags") if kind == "append" else KeyedTable(spark, f"{folder}/{kind}/t__tags", ["id"])).read())
    for i, part in enumerate([[(1, [(5, "x"), (6, "y")])], [(2, [(7, "z")]), (1, [(8, "w")])]]):
        spark.createDataFrame(part, "id int, tags array<struct<id: int, name: string>>").createOrReplaceTempView("kids")
        load("append", i)
        load("upsert", i)
    assert read("append") == [(1, 0, 5, "x"), (1, 0, 8, "w"), (1, 1, 6, "y"), (2, 0, 7, "z")]
    assert read("upsert") == [(1, 0, 8, "w"), (2, 0, 7, "z")]


def test_upsert_without_a_mark_takes_maps(spark, folder):
    spark.sql("SELECT 1 AS id, map('a', 1) AS m UNION ALL SELECT 1, map('b', 2)").createOrReplaceTempView("maps")
    assert ingest.load_artifact(spark, ingest.Artifact("maps", "t", ingestion_type="upsert", merge_columns=["id"]), folder, "1") == 1


# Reading, shaping, counting


def test_odd_headers(spark, folder):
    head = 'Order Date,"Last, First",x`y'
    for name, text in (("a", head), ("b", head)):
        spark.createDataFrame([(0, "made by hand"), (1, text), (2, f'2024,"{name}, b",1')], "i int, value string").coalesce(1).sortWithinPartitions("i").select("value").write.text(f"{folder}/{name}")
    found = readers.scan_delimited(spark, [f"{folder}/a", f"{folder}/b"], header_at=2)
    assert found.columns == ["Order Date", "Last, First", "x`y"] and rows(found) == [("2024", "a, b", "1"), ("2024", "b, b", "1")]
    spark.createDataFrame([(0, "p"), (1, 'x,"Last, First",Order Date'), (2, "1,2,3")], "i int, value string").coalesce(1).sortWithinPartitions("i").select("value").write.text(f"{folder}/c")
    with pytest.raises(Exception, match="has the header"):
        readers.scan_delimited(spark, [f"{folder}/a", f"{folder}/c"], header_at=2).collect()


def test_skipped_places_are_named(spark, folder):
    spark.range(2).write.parquet(f"{folder}/a")
    found, skipped = readers.scan_places(spark, [f"{folder}/a", f"{folder}/none"])
    assert found.count() == 2 and list(skipped) == [f"{folder}/none"]
    with pytest.warns(UserWarning, match="none"):
        readers.scan_all_partitions(spark, [f"{folder}/a", f"{folder}/none"])


def test_sample_keeps_the_order_asked(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 1, 4, 2)], "id int")
    assert [r.id for r in runs.summary_sample(df, [F.col("id").desc()], ["id"]).head().sample] == [5, 4, 3]


def test_pages_of_equal_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, n int")
    seen, last = [], None
    while page := shape.page_after(df, ["k", "n"], last, 1).collect():
        seen.append(tuple(page[0]))
        last = seen[-1]
    assert seen == [(1, 1), (1, 2), (2, 1)]


def test_instants_are_shown_in_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_seconds(1704067200) AS t, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS n")
        found = df.select(columns.display_value(df, "t"), columns.display_value(df, "n")).head()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(found) == ("2024-01-01T00:00:00.000Z", "2024-01-01T00:00:00.000Z")


def test_many_aliases_stay_with_their_row(spark):
    dim = spark.createDataFrame([(0, "zero", [f"alias {i}" for i in range(1002)]), (1, "one", ["other"])], "k long, name string, aliases array<string>")
    asked = spark.createDataFrame([("alias 1001",)], "typed string")
    found = fuzzy.did_you_mean(asked, "typed", dim, "k", "name", "aliases", limit=3).collect()
    assert {r.suggestion for r in found} == {"zero"}


def test_long_names_are_compared_whole(spark):
    long = "x" * 300
    names = spark.createDataFrame([(long + "a", 1), (long + "b", 2)], "name string, place long")
    found = fuzzy.fuzzy_match_join(spark.createDataFrame([(long + "b",)], "typed string"), "typed", names, "name", "place", 0.5).head()
    assert found.match == long + "b" and found.score == 1.0


def test_large_totals(spark):
    facts = spark.createDataFrame([(1, "success", 9e15, None)] * 3, "user int, status string, cost double, ts timestamp")
    users = spark.createDataFrame([(1, "p"), (2, "p")], "user int, project string")
    assert float(usage.usage_by_group(usage.usage_by_user(facts, users, "user"), "project").head().total_cost) == 27e15


def test_key_of_two_columns_and_unknown_tables(spark):
    table = spark.range(60).select(F.floor(F.col("id") / 6).alias("a"), (F.col("id") % 6).alias("b"), F.lit(1).alias("c"))
    profiles = discover.profile_tables({"t": table})
    found = discover.recommend_ingestion(profiles, discover.key_columns({"t": table}, profiles)).head()
    assert found.mergeColumns == ["a", "b"] and found.confidence == 80
    assert discover.profile_tables({"t": table}, near=0).filter("tested").count() == 3
    assert discover.table_columns(spark, "no_such_table").count() == 0
    table.createOrReplaceTempView("known_table")
    assert [r.column for r in discover.table_columns(spark, "known_table").orderBy("ordinal").collect()] == ["a", "b", "c"]


@pytest.mark.parametrize("name", ["F8_filter_all", "F9_filter_build", "F2_filter_name_bad_regex"])
def test_queries_that_must_find_rows(spark, name):
    assert REGISTRY[name].run(Tables(spark, "/root/testdata/sf0.01")).count() > 0


def test_documents_without_a_schema(spark, folder):
    docs = [(1, '{"user": {"id": 7, "last": {"kind": "a"}}, "seen": [1.5, 2]}'), (2, '{"user": {"id": 8}, "new": null}'), (3, "not json"), (4, None)]
    spark.createDataFrame(docs, "event_id int, document string").createOrReplaceTempView("documents_without")
    item = {"sourceCollection": "documents_without", "flatten": True, "targetTable": "d", "mode": "append", "primaryKey": "event_id"}
    assert ingest.load_artifact(spark, ingest.artifact_from_config(item), folder, "1") == 4
    found = {r.event_id: (r["user.id"], r["user.last.kind"], r["new"]) for r in LoadTable(spark, f"{folder}/d").read().collect()}
    assert found == {1: (7, "a", None), 2: (8, None, None), 3: (None, None, None), 4: (None, None, None)}
    assert rows(LoadTable(spark, f"{folder}/d__seen").read()) == [(1, 0, 1.5), (1, 1, 2.0)]


def test_json_path_without_a_schema(spark, folder):
    pages = [(1, '{"data": {"items": [{"id": 1, "x": 0.5}, {"id": 2, "y": {"z": "q"}}]}}'), (2, '{"data": {"items": []}}')]
    spark.createDataFrame(pages, "page int, payload string").createOrReplaceTempView("pages_without")
    item = {"sourceTable": "pages_without", "jsonPath": "$.data.items", "targetTable": "p", "mode": "append"}
    assert ingest.load_artifact(spark, ingest.artifact_from_config(item), folder, "1") == 3  # a payload without records keeps a row
    assert {(r.id, r.x, r.y and r.y.z) for r in LoadTable(spark, f"{folder}/p").read().collect()} == {(1, 0.5, None), (2, None, "q"), (None, None, None)}
    with pytest.raises(ValueError, match="no array of records"):
        ingest.load_artifact(spark, ingest.artifact_from_config({**item, "jsonPath": "$.data"}), folder, "2")
