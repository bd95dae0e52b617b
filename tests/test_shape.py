import pytest
from pyspark.sql import functions as F

from millrace.operators import shape as op


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('name', 'Al', 'role', named_struct('level', 5, 'none', CAST(NULL AS INT))) AS user, array(1, 2) AS tags")
    flat = op.flatten_struct(df)
    assert flat.columns == ["id", "user.name", "user.role.level", "user.role.none", "tags"]
    assert tuple(flat.head()) == (1, "Al", 5, None, [1, 2])


def test_nested_fields(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('email', 'e', 'id', 5, 'deep', named_struct('x', 1, 'y', 2)) AS account, array(named_struct('a', 1, 'b', 2)) AS items")
    row = op.select_nested_fields(df, "account.email, account.deep.y, items.b, nothing, account.nothing").head()
    assert row.asDict(recursive=True) == {"account": {"email": "e", "deep": {"y": 2}}, "items": [{"b": 2}]}
    whole = op.select_nested_fields(df, ["account.email", "account"]).head()
    assert whole.asDict(recursive=True)["account"] == {"email": "e", "id": 5, "deep": {"x": 1, "y": 2}}


def test_nested_fields_prune_the_scan(spark, folder):
    spark.sql("SELECT named_struct('a', id, 'b', id) AS s FROM range(3)").write.parquet(folder)
    plan = op.select_nested_fields(spark.read.parquet(folder), "s.a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<s:struct<a:bigint>>" in plan


def test_fields_and_paging(spark):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(1, 6)], "id int, name string")
    assert op.select_fields(df, "name, nothing, name").columns == ["name"]
    assert [r.id for r in op.page_rows(df, ["id"], 1, 2, "id").collect()] == [2, 3]
    assert [r.id for r in op.limit_rows(df, 0, ["id"]).collect()] == [1, 2, 3, 4, 5]
    assert [r.id for r in op.page_after(df, "id", 3, 9).collect()] == [4, 5]
    assert op.reorder_drop(df, "name", "id", ["id"]).columns == ["name", "id"]


@pytest.mark.parametrize(("offset", "limit"), [(0, 40), (500, 30), (985, 30), (960, 25), (2000, 5), (260, 400)])
def test_deep_pages(spark, monkeypatch, offset, limit):
    """A third of the rows share one value of the first column, some have none."""
    monkeypatch.setattr(op, "PAGE_ROWS", 20)
    monkeypatch.setattr(op, "PAGE_SLICES", 8)
    rows = [(None if i % 20 == 1 else 7 if i % 3 == 0 else i * 37 % 101, i * 7 % 500, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int, id int")
    wanted = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))[offset : offset + limit]
    assert [tuple(r) for r in op.page_rows(df, ["a", "b", "id"], offset, limit).collect()] == wanted


def test_a_deep_page_sorts_few_rows(spark, monkeypatch):
    monkeypatch.setattr(op, "PAGE_ROWS", 100)
    monkeypatch.setattr(op, "PAGE_SLICES", 16)
    df = spark.range(10000).withColumn("hot", F.when(F.col("id") % 3 == 0, 5000).otherwise(F.col("id")))
    kept, skip = df, 5000
    for key in ("hot", "id"):
        kept, before, held = op._narrow(kept, F.col(key), skip, skip + 10)
        skip -= before
    assert kept.count() == held < 1000
    page = op.page_rows(df, ["hot", "id"], 5000, 10)
    assert [r.id for r in page.collect()] == [r.id for r in df.orderBy("hot", "id").offset(5000).limit(10).collect()]


@pytest.mark.parametrize("offset", [0, 90, 400, 620, 880, 990])
def test_deep_pages_by_text(spark, monkeypatch, offset):
    """Texts that share a long beginning, a third of them equal, some of other scripts, empty or null."""
    monkeypatch.setattr(op, "PAGE_ROWS", 20)
    monkeypatch.setattr(op, "PAGE_SLICES", 8)

    def text(i):
        odd = [None, "", "é" * (i % 5), "common beginning", "common beginning\0", f"z{i}", f"common beginning of {i * 37 % 500:03d}"]
        return "common beginning of the same" if i % 3 == 0 else odd[min(i % 31, 6)]

    rows = [(text(i), i) for i in range(1000)]
    wanted = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))[offset : offset + 25]
    df = spark.createDataFrame(rows, "t string, id int")
    assert [tuple(r) for r in op.page_rows(df, ["t", "id"], offset, 25).collect()] == wanted


@pytest.mark.parametrize("start", ["", "long common beginning " * 200])
def test_pages_among_copies_of_texts(spark, monkeypatch, start):
    """Quantiles bound the page although many rows share each text, and bytes that all texts begin with cost no passes."""
    passes = []
    narrow = op._narrow
    monkeypatch.setattr(op, "_narrow", lambda *a: passes.append(narrow(*a)) or passes[-1])
    df = spark.range(6000).selectExpr(f"concat('{start}', substr(sha2(cast(id % 60 AS string), 256), 1, 40)) AS t", "id").repartition(3).cache()
    rows = sorted(tuple(r) for r in df.collect())
    for offset in (0, 1234, 3050, 5990):
        passes.clear()
        assert [tuple(r) for r in op.page_rows(df, ["t", "id"], offset, 10, most=5).collect()] == rows[offset : offset + 10]
        assert len(passes) <= 9 and passes[-1][2] <= 20, passes
    df.unpersist()


def test_bounds_of_numbers_that_no_double_holds(spark):
    """Each value lies between two doubles and is there a hundred times; a page keeps the few values around it."""
    df = spark.range(20_000).selectExpr("(id % 200) * 1000003 + 9000000000000000001 AS a", "cast((id % 200) * 1000003 + 9000000000000000001 AS decimal(25, 3)) AS d")
    for column in ("a", "d"):
        kept, before, held = op._narrow(df, F.col(column), 10_050, 10_060)
        assert before <= 10_050 and before + held >= 10_060 and held <= 500 and kept.count() == held


def test_diff(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "k int, s string, n int")
    new = spark.createDataFrame([(1, "a", None), (2, "x", None), (4, "d", 1)], "k int, s string, n int")
    found = {(r.k, r.field, r.old, r.new, r.status) for r in op.table_diff(old, new, ["k"], ["s", "n"]).collect()}
    assert found == {
        (2, "s", "b", "x", "changed"),
        (2, "n", "1", None, "changed"),
        (3, "s", "c", None, "removed"),
        (3, "n", "1", None, "removed"),
        (4, "s", None, "d", "added"),
        (4, "n", None, "1", "added"),
    }
    assert op.table_diff(old, new, ["k"], ["s", "n"], only_changed=False).count() == 8


@pytest.mark.parametrize("key", ["id", "name"])
def test_diff_by_digest(spark, key):
    old = spark.range(2000).select("id", F.concat(F.lit("n"), "id").alias("name"), F.when(F.col("id") % 7 != 0, F.col("id")).alias("v"), F.lit(None).cast("bigint").alias("w"))
    old = old.unionByName(spark.createDataFrame([(None, None, 1, None)], "id long, name string, v long, w long"))
    moved = F.col("id").between(1000, 1009)  # a value that goes from one column to the next
    new = old.filter("id IS NULL OR id <> 1500").select("id", "name", F.when(~F.coalesce(moved, F.lit(False)), F.col("v")).alias("v"), F.when(moved, F.col("v")).alias("w"))
    new = new.unionByName(spark.createDataFrame([(5000, "n5000", 1, 2)], "id long, name string, v long, w long")).repartition(5)
    rows = lambda d: sorted(map(repr, d.collect()))
    found = rows(op.table_diff_by_digest(old, new, [key], ["v", "w"], slices=400))
    assert found == rows(op.table_diff(old, new, [key], ["v", "w"])) and len(found) == 20  # 8 rows with a value moved, one removed, one added
    left = op.differing_slices(old, new, [key], ["v", "w"], 400)[0].count()
    assert left < (40 if key == "id" else 120)  # of 2,001
    assert rows(op.added_removed_by_digest(old, new, [key], 400)) == rows(op.added_removed(old, new, [key]))
    assert op.table_diff_by_digest(old, old.repartition(3), [key], ["v", "w"]).count() == 0
    assert op.table_diff_by_digest(old.limit(0), new.limit(0), [key], ["v"]).count() == 0


def test_top_k_counts_null_as_zero(spark):
    df = spark.createDataFrame([(1, None), (2, -5), (3, 7), (4, None)], "id int, m int")
    assert [r.id for r in op.top_k(df, "m", 3, "id").collect()] == [3, 1, 4]
    assert [r.id for r in op.top_k_slowest(df, "m", 3, "id").collect()] == [3, 2, 1]


def test_top_per_group_prunes_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    plan = op.top_per_group_with_rest(df, ["g"], [F.col("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_sorting(spark):
    df = spark.createDataFrame([(1, "b", "z"), (2, "B", "a"), (3, "a", "é"), (4, "a", "f"), (5, None, "x")], "id int, c string, n string")
    assert [r.id for r in op.sort_two_keys(df, "c", "n", "id").collect()] == [5, 3, 4, 1, 2]
    assert [r.id for r in op.sort_option(df, "id", "DESC").collect()] == [5, 4, 3, 2, 1]
    assert [r.id for r in op.sort_option(df, "n", "asc").collect()] == [2, 4, 5, 1, 3]


def test_a_page_is_bounded_by_comparisons_with_constants(spark):
    """No row is looked up among all cut points; what precedes the rows kept is counted, with nulls first and ties whole."""
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 4_000).alias("a"), F.lit(None).cast("int").alias("no"))
    values = sorted((r.a is not None, r.a or 0) for r in df.collect())
    for skip in (0, 1_500, 1_990, 2_001, 11_111, 19_985):
        kept, before, held = op._narrow(df, F.col("a"), skip, skip + 15)
        found = sorted((r.a is not None, r.a or 0) for r in kept.collect())
        assert len(found) == held and before <= skip and before + held >= min(skip + 15, len(values))
        assert found == values[before : before + held] and held <= 2_200
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in plan and "filter(" not in plan
    assert op._narrow(df, F.col("no"), 5, 10)[1:] == (0, 20_000)
    assert op._narrow(df.limit(0), F.col("a"), 1, 10)[1:] == (0, 0)
    assert op._narrow(df, F.col("a"), 30_000, 30_010)[1:][1] <= 20_000
