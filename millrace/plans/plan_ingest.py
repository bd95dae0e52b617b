"""Ingestion modes I1-I15, V1, and the flagship load."""

from functools import reduce

from pyspark.sql import functions as F

from millrace.operators import ingest as op
from millrace.operators import usage
from millrace.plans.plan_columns import _DIRTY, dirty
from millrace.plans.registry import query
from millrace.session import work_path
from millrace.sources.store import KeyedTable, LoadTable, MarkTable

_V1_MAX = "(SELECT max(updated_at) FROM orders_v1)"
_MERGED = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, updated_at FROM orders_v2 WHERE updated_at > {_V1_MAX}
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, updated_at FROM orders_v1
  WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v2 WHERE updated_at > {_V1_MAX})"""
_SHOW = "strftime(updated_at, '%Y-%m-%d') AS updated_at"


def shown(df):
    return df.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd"))


def delta_store(t):
    """Orders loaded in two deltas: everything in v1, then what is newer in v2."""
    root = work_path(t.spark, "delta")
    store = KeyedTable(t.spark, f"{root}/orders", ["o_orderkey"], buckets=8)
    marks = MarkTable(t.spark, f"{root}/marks")
    op.ingest_delta(store, t.orders_v1, "updated_at", marks, "orders")
    op.ingest_delta(store, t.orders_v2, "updated_at", marks, "orders")
    return store, marks


@query(
    "I3_delta_then_daily_revenue",
    f""", merged AS ({_MERGED}) SELECT strftime(updated_at, '%Y-%m-%d') AS order_date, count(*) AS order_count,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM merged
        WHERE updated_at >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 30 DAY GROUP BY 1""",
    "orders_v1 orders_v2",
)
def flagship(t):
    store, _ = delta_store(t)
    daily = usage.daily_revenue(store.read(), "updated_at", "o_totalprice", F.lit("2001-08-02 00:00:00").cast("timestamp_ntz"))
    return daily.select(F.date_format("order_date", "yyyy-MM-dd").alias("order_date"), "order_count", F.col("revenue").cast("double").alias("revenue"))


@query("I3_ingest_delta", f", merged AS ({_MERGED}) SELECT * REPLACE ({_SHOW}) FROM merged", "orders_v1 orders_v2")
def i3(t):
    return shown(delta_store(t)[0].read())


def _spread(df):
    return df.groupBy("_snapshot_id").agg(F.count("*").alias("n"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))


def _snapshots(t, n):
    path = work_path(t.spark, "snapshots")
    for i in range(1, n + 1):
        op.ingest_snapshot(t.customer.withColumn("c_acctbal", F.col("c_acctbal") + i), path, f"s{i}")
    return t.spark.read.parquet(path)


_SNAP = "_snapshot_id, count(*) AS n, CAST(sum(CAST(c_acctbal + i AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM customer"


@query("I1_ingest_snapshot", f"SELECT 's' || i AS {_SNAP}, (SELECT unnest([1, 2]) AS i) GROUP BY i")
def i1(t):
    return _spread(_snapshots(t, 2))


@query("I2_snapshot_retention", f"SELECT 's' || i AS {_SNAP}, (SELECT unnest([10, 11, 12]) AS i) GROUP BY i")
def i2(t):
    """Twelve snapshots, of which the last three by number stay."""
    return _spread(op.snapshot_retention(_snapshots(t, 12)))


@query("I2_retain_snapshots", f"SELECT 's' || i AS {_SNAP}, (SELECT unnest([9, 10, 11, 12]) AS i) GROUP BY i")
def i2_removed(t):
    path = work_path(t.spark, "retained")
    for i in range(1, 13):
        op.ingest_snapshot(t.customer.withColumn("c_acctbal", F.col("c_acctbal") + i), path, f"s{i}")
        op.retain_snapshots(t.spark, path, 4)
    return _spread(t.spark.read.parquet(path))


@query("I3_delta_by_number", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def i3_number(t):
    """Deltas past a number: the newest event of each user after three loads."""
    store = KeyedTable(t.spark, work_path(t.spark, "by_number"), ["user_id"], buckets=4)
    marks = MarkTable(t.spark, f"{store.path}/marks")
    events = t.events.select("event_id", "user_id")
    for third in (900, 9_000, 10**12):
        op.ingest_delta(store, events.filter(F.col("event_id") <= third), "event_id", marks, "events")
    return store.read().select("user_id", "event_id")


@query(
    "I3_delta_two_marks",
    """SELECT o_orderkey FROM orders WHERE greatest(coalesce(o_orderdate, TIMESTAMP '1970-01-01'), CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2002-01-01' ELSE o_orderdate END) > TIMESTAMP '2001-01-01'""",
)
def i3_two(t):
    """A row is new if any of its marks is."""
    orders = t.orders.withColumn("changed", F.when(F.col("o_orderkey") % 5 == 0, F.lit("2002-01-01 00:00:00").cast("timestamp_ntz")))
    return op.watermark_filter(orders, ["o_orderdate", "changed"], "2001-01-01 00:00:00").select("o_orderkey")


@query("I4_watermark_filter", "SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'")
def i4(t):
    return op.watermark_filter(t.events, "ts", "2024-01-20 12:00:00").select("event_id", "user_id")


@query("I4_watermark_first_run", "SELECT event_id FROM events")
def i4_first(t):
    return op.watermark_filter(t.events, "ts", None).select("event_id")


@query(
    "I5_watermark_advance",
    f", merged AS ({_MERGED}) SELECT 'orders' AS artifact, strftime(max(updated_at), '%Y-%m-%d %H:%M:%S.%f') AS mark FROM merged",
    "orders_v1 orders_v2",
)
def i5(t):
    return delta_store(t)[1].read()


@query("I6_change_count_gate", f"SELECT count(*) AS changed FROM orders_v2 WHERE updated_at > {_V1_MAX}", "orders_v1 orders_v2")
def i6(t):
    return op.change_count(t.orders_v2, "updated_at", op.watermark_advance(t.orders_v1, "updated_at"))


@query("I7_backload_days", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 5 DAY")
def i7(t):
    return op.watermark_filter(t.events, "ts", "2024-01-20 12:00:00", backload_days=5).select("event_id")


_HISTORY = """h AS (SELECT user_id, event_type, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
  s AS (SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM h WHERE event_type IS DISTINCT FROM before)
  SELECT user_id, event_type, strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
    strftime(valid_to, '%Y-%m-%d %H:%M:%S.%f') AS valid_to, valid_to IS NULL AS is_current FROM s"""


def shown_history(df):
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.withColumn("valid_from", text("valid_from")).withColumn("valid_to", text("valid_to"))


@query("I8_scd2", f"WITH {_HISTORY}")
def i8(t):
    return shown_history(op.scd2(t.events, ["user_id"], "ts", ["event_type"]))


@query("I8_scd2_hot_keys", f"WITH {_HISTORY}")
def i8_hot(t):
    """The same history with a bound so low that keys above the average count as hot."""
    return shown_history(op.scd2(t.events, ["user_id"], "ts", ["event_type"], hot_rows=66))


@query("I8_ingest_historical", f"WITH {_HISTORY}")
def i8_stored(t):
    store = KeyedTable(t.spark, work_path(t.spark, "history"), ["user_id"], buckets=4)
    half = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    op.ingest_historical(store, t.events.filter(half), "ts", ["event_type"])
    op.ingest_historical(store, t.events.filter(~half), "ts", ["event_type"])
    return shown_history(store.read())


@query("I8_ingest_historical_late", f"WITH {_HISTORY}")
def i8_late(t):
    """Loads in another order than time, with repeats and with rows that have no time, give the same history."""
    store = KeyedTable(t.spark, work_path(t.spark, "late"), ["user_id"], buckets=4)
    lost = t.events.withColumn("ts", F.lit(None).cast("timestamp_ntz")).filter("event_id % 100 = 0")
    for i in (2, 0, 1, 0):
        part = t.events.filter(F.pmod(F.col("event_id") * 7, F.lit(3)) == i)
        op.ingest_historical(store, part.unionByName(lost), "ts", ["event_type"])
    return shown_history(store.read())


def order_changes(t):
    """v1 to v2 as inserts, updates and deletes, each key also with an older, overtaken change."""
    key, old = F.col("o_orderkey"), F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    op_ = F.when(old & (key % 11 == 0), "D").when(~old & (key % 11 != 0), "I").when((key % 7 == 0) & (key % 11 != 0), "U")
    last = t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(key % 7 == 0, F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        op_.alias("op"),
        (key * 10 + 2).alias("seq"),
    ).filter("op IS NOT NULL")
    first = last.withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("op", F.lit("U")).withColumn("seq", F.col("seq") - 1)
    return last.unionByName(first)


_TARGET = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
_V2 = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders_v2"


@query("I9_ingest_cdc_batch", _V2, "orders_v2")
def i9(t):
    return op.apply_changes(t.orders_v1.select(*_TARGET), order_changes(t), ["o_orderkey"], "op", "seq")


@query("I9_ingest_cdc_store", _V2, "orders_v2")
def i9_store(t):
    """The same changes in two loads, newest first, so that the second brings only overtaken changes."""
    store = KeyedTable(t.spark, work_path(t.spark, "cdc"), ["o_orderkey"], buckets=4)
    base = t.orders_v1.select(*_TARGET, F.lit("I").alias("op"), F.lit(0).cast("bigint").alias("seq"))
    op.ingest_cdc(store, base, "op", "seq")
    changes = order_changes(t)
    op.ingest_cdc(store, changes.filter("seq % 10 = 2"), "op", "seq")
    op.ingest_cdc(store, changes.filter("seq % 10 = 1"), "op", "seq")
    return op.live_rows(store.read(), "op", "seq")


_PRESENT = "SELECT o_orderkey, o_totalprice FROM orders_v1 WHERE o_orderkey IN (SELECT o_orderkey FROM orders_v2)"


@query("I10_deletes_by_digest", _PRESENT, "orders_v1 orders_v2")
def i10_digest(t):
    return op.detect_deletes_by_digest(t.orders_v1, t.orders_v2, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("I10_detect_deletes", _PRESENT, "orders_v1 orders_v2")
def i10(t):
    return op.detect_deletes(t.orders_v1, t.orders_v2, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("I10_mark_deletes", "SELECT o_orderkey, o_orderkey NOT IN (SELECT o_orderkey FROM orders_v2) AS _deleted FROM orders_v1", "orders_v1 orders_v2")
def i10_mark(t):
    return op.detect_deletes(t.orders_v1, t.orders_v2, ["o_orderkey"], "_deleted").select("o_orderkey", "_deleted")


@query("I11_auto_explode", "SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS element FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def i11(t):
    child = op.auto_explode(t.embeddings, ["vec_id"])["embedding"]
    return child.withColumn("element", F.col("element").cast("double"))


def event_documents(t):
    who = F.struct(F.col("user_id").alias("id"), F.struct(F.col("event_type").alias("kind")).alias("last"))
    seen = F.when(F.col("event_id") % 4 != 0, F.array(F.col("value"), F.col("value") + 1))
    return t.events.select("event_id", F.to_json(F.struct(who.alias("user"), seen.alias("seen"))).alias("doc"))


_DOC = "user struct<id: bigint, last: struct<kind: string>>, seen array<double>"


@query("I12_flatten_documents", 'SELECT event_id, user_id AS "user.id", event_type AS "user.last.kind" FROM events')
def i12(t):
    return op.flatten_documents(event_documents(t), "doc", _DOC, ["event_id"])[0]


@query(
    "I12_flatten_children",
    "SELECT event_id, CAST(pos AS INTEGER) AS pos, value + pos AS element FROM events, (SELECT unnest([0, 1]) AS pos) WHERE event_id % 4 <> 0",
)
def i12_child(t):
    return op.flatten_documents(event_documents(t), "doc", _DOC, ["event_id"])[1]["seen"]


@query("I13_ingest_query_defined", "SELECT o_custkey, count(*) AS orders, max(o_orderkey) AS newest FROM orders GROUP BY o_custkey")
def i13(t):
    t.orders.createOrReplaceTempView("millrace_orders")
    root = work_path(t.spark, "query_defined")
    text = "SELECT o_custkey, count(*) AS orders, max(o_orderkey) AS newest FROM millrace_orders GROUP BY o_custkey"
    op.load_artifact(t.spark, op.Artifact("", "summary", ingestion_type="stored_procedure", merge_columns=["o_custkey"], query=text), root, "1")
    return KeyedTable(t.spark, f"{root}/summary", ["o_custkey"]).read()


@query(
    "I14_multi_table_sync",
    """SELECT 'orders' AS target, true AS success, 'delta' AS mode, count(*) AS row_count FROM orders
       UNION ALL SELECT 'customer', true, 'snapshot', count(*) FROM customer
       UNION ALL SELECT 'part', true, 'upsert', count(*) FROM part
       UNION ALL SELECT 'lineitem', true, 'append', count(*) FROM lineitem
       UNION ALL SELECT 'missing', false, 'snapshot', NULL""",
)
def i14(t):
    for name in ("orders", "customer", "part", "lineitem"):
        getattr(t, name).createOrReplaceTempView(f"millrace_{name}")
    items = [
        {"sourceTable": "millrace_orders", "targetTable": "orders", "mode": "incremental", "primaryKey": "o_orderkey", "timestampColumn": "o_orderdate"},
        {"sourceObjectName": "millrace_customer", "targetObjectName": "customer", "priority": "t"},
        {"sourceTable": "millrace_part", "targetTable": "part", "mode": "upsert", "primaryKeys": ["p_partkey"], "postScript": "SELECT 1"},
        {"sourceTable": "millrace_lineitem", "targetTable": "lineitem", "mode": "append", "primaryKey": "l_orderkey"},
        {"sourceTable": "millrace_no_such_table", "targetTable": "missing"},
    ]
    outcome = op.multi_table_sync(t.spark, [op.artifact_from_config(i) for i in items], work_path(t.spark, "sync"), "1")
    return outcome.drop("message")


_TEN = " UNION ALL ".join(
    f"SELECT 't{i}' AS target, o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 = {i}" for i in range(10)
)


@query("I14_ten_deltas", _TEN)
def i14_ten(t):
    """Ten delta loads side by side, in two rounds, with all rows of their targets."""
    root = work_path(t.spark, "ten")
    for last in ("1998-01-01 00:00:00", "2100-01-01 00:00:00"):
        items = []
        for i in range(10):
            some = t.orders.filter((F.col("o_orderkey") % 10 == i) & (F.col("o_orderdate") < F.lit(last).cast("timestamp_ntz")))
            some.createOrReplaceTempView(f"millrace_ten_{i}")
            items.append({"sourceTable": f"millrace_ten_{i}", "targetTable": f"t{i}", "mode": "incremental", "primaryKey": "o_orderkey", "timestampColumn": "o_orderdate"})
        outcome = op.multi_table_sync(t.spark, [op.artifact_from_config(i) for i in items], root, "1")
        bad = outcome.filter("NOT success").collect()
        if bad:
            raise ValueError(bad[0].message)
    read = [KeyedTable(t.spark, f"{root}/t{i}", ["o_orderkey"]).read().select(F.lit(f"t{i}").alias("target"), "o_orderkey", "o_orderstatus", "o_totalprice") for i in range(10)]
    return reduce(lambda a, b: a.union(b), read)


@query(
    "I14_files_and_documents",
    """SELECT 'file' AS kind, c_custkey AS id, CAST(NULL AS INTEGER) AS pos, c_name AS text, CAST(NULL AS DOUBLE) AS number FROM customer, range(2)
       UNION ALL SELECT 'payload', c_custkey, NULL, c_mktsegment, c_acctbal FROM customer, range(2)
       UNION ALL SELECT 'document', event_id, NULL, event_type, CAST(user_id AS DOUBLE) FROM events, range(2)
       UNION ALL SELECT 'child', event_id, CAST(pos AS INTEGER), NULL, value + pos FROM events, (SELECT unnest([0, 1]) AS pos), range(2) WHERE event_id % 4 <> 0""",
)
def i14_files(t):
    """By configuration alone, twice in append mode: a file with its header on line 3, API payloads, nested documents."""
    root = work_path(t.spark, "configured")
    files, line = f"{root}/in", F.concat_ws("|", "c_custkey", F.concat(F.lit('"'), "c_name", F.lit('"')))
    # one row per file: its head, then its lines
    head = F.array(F.lit("made today"), F.lit("by hand"), F.lit('Cust Key|"Full | Name"'))
    pages = t.customer.groupBy(F.floor(F.col("c_custkey") / 500).alias("page")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    pages.select("page", F.array_join(F.concat(head, "lines"), "\n").alias("value")).repartition("page").write.partitionBy("page").text(files)
    files = f"{files}/*"
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    t.customer.groupBy(F.floor(F.col("c_custkey") / 50).alias("page")).agg(
        F.to_json(F.struct(F.struct(F.collect_list(record).alias("items")).alias("data"))).alias("payload")
    ).createOrReplaceTempView("millrace_payloads")
    event_documents(t).createOrReplaceTempView("millrace_documents")
    items = [
        {"sourceFile": files, "sourceFileFormat": "txt", "sourceFileDelimiter": "|", "containsHeader": "true", "columnHeaderLineNumber": "3", "targetTable": "file", "mode": "append"},
        {"sourceTable": "millrace_payloads", "jsonPath": "$.data.items", "jsonRecord": "struct<id: bigint, segment: string, balance: double>", "targetTable": "payload", "mode": "append"},
        {"sourceCollection": "millrace_documents", "flatten": _DOC, "documentColumn": "doc", "targetTable": "document", "mode": "append", "primaryKey": "event_id"},
    ]
    for load in range(2):
        bad = op.multi_table_sync(t.spark, [op.artifact_from_config(i) for i in items], root, str(load)).filter("NOT success").collect()
        if bad:
            raise ValueError(bad[0].message)
    none, read = F.lit(None), lambda name: LoadTable(t.spark, f"{root}/{name}").read()
    file = read("file").select(F.lit("file").alias("kind"), F.col("Cust Key").cast("bigint").alias("id"), none.cast("int").alias("pos"), F.col("Full | Name").alias("text"), none.cast("double").alias("number"))
    payload = read("payload").select(F.lit("payload"), "id", none.cast("int"), "segment", "balance")
    document = read("document").select(F.lit("document"), "event_id", none.cast("int"), F.col("`user.last.kind`"), F.col("`user.id`").cast("double"))
    child = read("document__seen").select(F.lit("child"), "event_id", "pos", none.cast("string"), "element")
    return file.union(payload).union(document).union(child)


_ROWS = "SELECT c_custkey, number, regexp_matches(trim(number), '^[+-]?[0-9]+$') OR number IS NULL AS ok FROM dirty"


@query("I15_ingest_with_outcome", f"WITH {_DIRTY}, r AS ({_ROWS}) SELECT count(*) AS items, count(*) FILTER (ok AND number IS NOT NULL) AS ok, count(*) FILTER (NOT (ok AND number IS NOT NULL)) AS failed FROM r")
def i15(t):
    return op.outcome_counts(dirty(t), {"number": "bigint"}, ["number"])


@query(
    "I15_quarantine",
    f"""WITH {_DIRTY}, r AS ({_ROWS}) SELECT c_custkey, CASE WHEN number IS NULL THEN 'number is required' ELSE 'number is not bigint: ' || number END AS errors
        FROM r WHERE NOT (ok AND number IS NOT NULL)""",
)
def i15_bad(t):
    bad = op.split_outcome(dirty(t), {"number": "bigint"}, ["number"])[1]
    return bad.select("c_custkey", F.array_join("_errors", "; ").alias("errors"))


@query(
    "V1_artifact_transform",
    """SELECT DISTINCT o_custkey AS customer, CAST(floor(o_totalprice) AS BIGINT) AS price, CAST(floor(o_totalprice) AS BIGINT) * 2 AS twice
       FROM orders WHERE o_orderstatus = 'F'""",
)
def v1(t):
    steps = [
        {"filter": "o_orderstatus = 'F'"},
        {"select": ["o_custkey", "o_totalprice"]},
        {"rename": {"o_custkey": "customer", "o_totalprice": "price"}},
        {"cast": {"price": "bigint"}},
        {"with_column": {"twice": "price * 2"}},
        {"drop_duplicates": ["customer", "price"]},
    ]
    return op.apply_steps(t.orders, steps)
