"""Readers and writers against the published file rules."""

import os
import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark import cloudpickle

from millrace.operators import ingest
from millrace.sinks import writers as out
from millrace.sources import readers as src


def lines(folder):
    text = []
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            with open(f"{folder}/{name}", newline="") as f:
                text.append(f.read())
    return "".join(text)


def csv(spark, folder, rows, schema, **options):
    out.write_csv(spark.createDataFrame(rows, schema).coalesce(1), folder, **options)
    return lines(folder)


def test_csv_rules(spark, folder):
    rows = [(1, 'Project "Alpha"', "active", 10), (2, "Last, First", None, None), (3, "", " padded ", 5), (4, "two\nlines", "#x", 1)]
    found = csv(spark, folder, rows, "id int, name string, status string, count int")
    assert found == (
        'id,name,status,count\n1,"Project ""Alpha""",active,10\n2,"Last, First",,\n3,, padded ,5\n4,"two\nlines",#x,1\n'
    )


def test_csv_nested_values_fields_and_delimiter(spark, folder):
    found = csv(spark, folder, [(1, [1, 2], ("x",), 2.0)], "id int, a array<int>, s struct<p:string>, d double", fields=["s", "a", "d"], delimiter=";")
    assert found == 's;a;d\n"{""p"":""x""}";[1,2];2\n'


def test_csv_of_nothing_is_empty(spark, folder):
    assert csv(spark, folder, [], "id int, name string") == ""


@pytest.mark.parametrize("given, wanted", [((None, None), (True, 1)), ((False, None), (False, 0)), ((True, 4), (True, 4))])
def test_header_defaults(given, wanted):
    assert src.header_line(*given) == wanted


def write_text(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_header_on_a_later_line_of_every_file(spark, folder):
    write_text(folder, "a.csv", 'made by x\n\nid,name\n1,"a, b"\n2,c\n')
    write_text(folder, "b.csv", "made by y\nnote\nid,name\n3,\n")
    write_text(folder, "c.csv", "short\n")
    found = src.scan_delimited(spark, folder, header_at=3)
    assert sorted(tuple(r) for r in found.collect()) == [("1", "a, b"), ("2", "c"), ("3", None)]


def test_preamble_only_in_the_first_block_of_a_split_file(spark, folder):
    write_text(folder, "a.csv", "note\nid,name\n" + "".join(f"{i},n{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        found = src.scan_delimited(spark, folder, header_at=2, schema="id int, name string")
        assert found.rdd.getNumPartitions() > 3
        assert [r.id for r in found.orderBy("id").collect()] == list(range(5000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_broken_json_is_kept_aside(spark, folder):
    write_text(folder, "a.json", '{"id": 1}\n{broken\n')
    rows = src.scan_json(spark, folder, schema="id int, _corrupt string").collect()
    assert sorted((r.id, r._corrupt) for r in rows if r.id) == [(1, None)] and [r._corrupt for r in rows if not r.id] == ["{broken"]


def test_category_files_survive_a_broken_one(spark, folder):
    write_text(folder, "a.json", '{"connectorType": "db", "availableConnectors": [{"connectorName": "x", "active": true}, {"connectorName": "y", "active": false}]}\n')
    write_text(folder, "b.json", "not json\n")
    found = src.scan_category_files(spark, [f"{folder}/a.json", f"{folder}/b.json"])
    assert [(r.category, r.connectorName) for r in found.collect()] == [("db", "x")]


def test_places_that_differ_or_are_missing(spark, folder):
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(f"{folder}/one")
    spark.createDataFrame([(2,)], "id int").write.parquet(f"{folder}/two")
    found = src.scan_all_partitions(spark, [f"{folder}/one", f"{folder}/gone", f"{folder}/two"])
    assert sorted(tuple(r) for r in found.collect()) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError):
        src.scan_all_partitions(spark, [f"{folder}/gone"])


def test_json_path(spark):
    df = spark.createDataFrame([("p1", '{"d": {"i": [{"a": 1}, {"a": 2}]}}'), ("p2", '{"d": {}}'), ("p3", "bad")], "page string, j string")
    found = src.scan_json_path(df, "j", "$.d.i", "struct<a:int>")
    assert sorted(map(str, map(tuple, found.collect()))) == ["('p1', 1)", "('p1', 2)", "('p2', None)", "('p3', None)"]


def test_jdbc_ranges():
    made = src.jdbc_options("jdbc:x", "t", key="id", low=1, high=10**18, rows=2_500_000)
    assert (made["numPartitions"], made["lowerBound"], made["upperBound"], made["partitionColumn"]) == ("3", "1", str(10**18), "id")
    assert src.jdbc_options("jdbc:x", "t", key="id", low=5, high=5, rows=9_000_000)["numPartitions"] == "1"


def test_column_list():
    assert src.column_list("*") is None and src.column_list("a, b") == ["a", "b"] and src.column_list(["a"]) == ["a"]


def test_layout_splits_a_hot_key(spark, folder):
    from pyspark.sql import functions as F

    rows = spark.range(0, 60_000, 1, 8).select((F.col("id") % 3 == 0).alias("hot"), "id").select(
        F.when(F.col("hot"), 0).otherwise(F.col("id")).alias("k"), "id"
    )
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32KB")
    try:
        out.write_layout(rows, folder, "k", "id")
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    back = spark.read.parquet(folder).select("k", F.input_file_name().alias("f"))
    assert back.count() == 60_000 and back.filter("k = 0").select("f").distinct().count() > 1


def test_workers_need_not_have_the_package(tmp_path):
    """What runs in Python workers must unpickle where this package cannot be imported."""
    (tmp_path / "f").write_bytes(cloudpickle.dumps(src._without_preamble(2)))
    code = f"from pyspark import cloudpickle; cloudpickle.load(open({str(tmp_path / 'f')!r}, 'rb'))"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=60)


@pytest.mark.parametrize("size", [40, 64, 1_000, 100_000])
def test_line_breaks_in_quotes_read_alike_for_any_split(spark, tmp_path, size):
    cells = ["plain", "two\nlines", 'a "quoted" word', "\n\n", "x" * 150 + "\n" + "y" * 150, '"\n"', "a, b", "last"] * 6
    for name in ("one", "two"):
        rows = "".join(f'{i},"{c.replace(chr(34), chr(34) * 2)}"\n' for i, c in enumerate(cells))
        (tmp_path / f"{name}.csv").write_text(f'an "odd preamble\nid,text\n{rows}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        found = src.scan_delimited(spark, str(tmp_path), header_at=2, schema="id int, text string")
        assert sorted(map(tuple, found.collect())) == sorted([*enumerate(cells)] * 2)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("key", [None, 7])
def test_deletes_by_digest(spark, key):
    target = spark.createDataFrame([(i, i * 2) for i in range(300)] + [(5, 1), (None, 3), (key, 4)], "k long, v long")
    source = target.filter("k IS NULL OR k % 50 <> 5").union(spark.createDataFrame([(999, 1)], "k long, v long"))
    for mark in (None, "gone"):
        rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
        assert rows(ingest.detect_deletes_by_digest(target, source, ["k"], mark, 16)) == rows(ingest.detect_deletes(target, source, ["k"], mark))


def test_records_over_lines_are_joined_a_batch_at_a_time():
    """Whole records come out as one batch for a batch of lines, whatever the lines of a record; the rest crosses blocks."""
    lines = ['mid"', '1,"a', "", 'b"', "2,c", '3,"d', 'e"', '4,"open', "still"]
    batch = pa.RecordBatch.from_arrays([pa.array(lines), pa.array([7] * 9, pa.int64()), pa.array([4] * 9, pa.int64())], ["value", "file", "block"])
    for cut in range(1, 10):
        given = [b for b in (batch.slice(0, cut), batch.slice(cut)) if b.num_rows]
        whole = list(src._records({(7, 4)}, False)(iter(given)))
        assert sum((b.column(0).to_pylist() for b in whole), []) == ['1,"a\n\nb"', "2,c", '3,"d\ne"']
        assert len(whole) <= (1 if len(given) == 1 else 3)
        crossing = [r for b in src._records({(7, 4)}, True)(iter(given)) for r in b.to_pylist()]
        assert [(r["value"], r["part"]) for r in crossing] == [('mid"', 2), ('4,"open\nstill', 1)]
