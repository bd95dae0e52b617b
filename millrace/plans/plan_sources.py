"""Sources and sinks: S1-S12, W1-W12. Each writes the given tables to the shared work folder and reads them back."""

import pyarrow as pa
from pyspark.sql import functions as F

from millrace.operators.shape import union_sources
from millrace.plans.registry import query
from millrace.session import work_path
from millrace.sinks import writers as out
from millrace.sources import readers as src
from millrace.sources.store import KeyedTable

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
_DDL = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"


def plain(orders):
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def plain_orders(t):
    return plain(t.orders)


@query("S1_scan_table", "SELECT o_orderkey, o_totalprice FROM orders")
def s1(t):
    return src.scan_table(t.orders, "o_orderkey, o_totalprice")


@query("S2_scan_query", f"{_ORDERS} WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00'")
def s2(t):
    t.orders.createOrReplaceTempView("millrace_orders")
    text = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM millrace_orders
              WHERE o_orderdate > CAST(:last_run AS TIMESTAMP_NTZ)"""
    return src.scan_query(t.spark, text, last_run="2000-01-01 00:00:00")


@query("S3_scan_delimited", _ORDERS)
def s3(t):
    path = work_path(t.spark, "csv")
    plain_orders(t).write.options(header=True, sep="|").csv(path)
    return src.scan_delimited(t.spark, path, delimiter="|", schema=_DDL)


def _with_preamble():
    """Lines of one file: two comment lines, the header, then the rows. A nested function travels to the workers by
    value, so they need not have this package."""

    def write(batches):
        head = ["# export of orders", "", "o_orderkey,o_custkey,o_orderstatus,o_totalprice"]
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(head + batch.column(0).to_pylist(), pa.string())], ["value"])
            head = []

    return write


@query("S3_scan_header_line", _ORDERS)
def s3_line(t):
    path = work_path(t.spark, "preamble")
    lines = plain_orders(t).select(F.to_csv(F.struct("*")).alias("value"))
    lines.repartition(3).mapInArrow(_with_preamble(), "value string").write.text(path)
    read = src.scan_delimited(t.spark, path, header_at=3)
    return read.select(*[F.col(c).cast(k) for c, k in (x.split(" ") for x in _DDL.split(", "))])


@query("S3_scan_line_breaks", "SELECT o_orderkey, 'line ' || o_orderpriority || chr(10) || chr(10) || '\"quoted\", ' || o_orderstatus AS note FROM orders")
def s3_breaks(t):
    path = work_path(t.spark, "breaks")
    note = F.concat(F.lit("line "), "o_orderpriority", F.lit('\n\n""quoted"", '), "o_orderstatus")
    lines = t.orders.select(F.concat(F.col("o_orderkey").cast("string"), F.lit(',"'), note, F.lit('"')).alias("value"))
    lines.repartition(3).mapInArrow(_with_preamble(), "value string").write.text(path)
    return src.scan_delimited(t.spark, path, header_at=3, schema="o_orderkey long, note string")


@query("S4_scan_json", _ORDERS)
def s4(t):
    path = work_path(t.spark, "json")
    plain_orders(t).write.json(path)
    return src.scan_json(t.spark, path, schema=_DDL)


@query("S5_scan_parquet", _ORDERS)
def s5(t):
    return plain(src.scan_parquet(t.spark, f"{t.folder}/orders.parquet"))


@query("S6_scan_orc", _ORDERS)
def s6_orc(t):
    path = work_path(t.spark, "orc")
    plain_orders(t).write.orc(path)
    return src.scan_files(t.spark, path, "orc")


@query("S6_scan_xml", _ORDERS)
def s6_xml(t):
    path = work_path(t.spark, "xml")
    plain_orders(t).write.format("xml").options(rootTag="orders", rowTag="order").save(path)
    return src.scan_files(t.spark, path, "xml", row_tag="order", schema=_DDL)


@query("S7_scan_object_store", _ORDERS)
def s7(t):
    path = work_path(t.spark, "tree")
    plain_orders(t).withColumn("day", F.col("o_orderstatus")).write.partitionBy("day").parquet(path)
    return plain(src.scan_object_store(t.spark, path, "parquet", glob="*.parquet").filter("source_file IS NOT NULL"))


@query("S10_scan_json_path", "SELECT event_id // 50 AS page, event_id, value FROM events")
def s10(t):
    page = F.floor(F.col("event_id") / 50).alias("page")
    items = F.collect_list(F.struct("event_id", "value"))
    body = F.to_json(F.struct(F.struct(items.alias("items")).alias("data")))
    landed = t.events.groupBy(page).agg(body.alias("payload"))
    return src.scan_json_path(landed, "payload", "$.data.items", "struct<event_id:bigint,value:double>")


@query("S11_scan_all_partitions", _ORDERS)
def s11(t):
    root = work_path(t.spark, "projects")
    plain_orders(t).withColumn("p", F.col("o_orderstatus")).write.partitionBy("p").parquet(root)
    places = [f"{root}/p={s}" for s in ("P", "F", "gone", "O")]
    return src.scan_all_partitions(t.spark, places)


@query("S12_scan_category_files", 'SELECT p_type AS category, p_name AS "connectorName", true AS active FROM part WHERE p_size % 3 = 0')
def s12(t):
    path = work_path(t.spark, "categories")
    entry = F.struct(F.col("p_name").alias("connectorName"), (F.col("p_size") % 3 == 0).alias("active"))
    files = t.part.groupBy(F.col("p_type").alias("connectorType"), F.floor(F.col("p_partkey") / 100).alias("page"))
    files.agg(F.collect_list(entry).alias("availableConnectors")).drop("page").write.json(path)
    return src.scan_category_files(t.spark, [path])


# ---- sinks ---------------------------------------------------------------------------------------------------------


@query("W1_write_append", _ORDERS)
def w1(t):
    path = work_path(t.spark, "append")
    old = F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    out.write_append(t.orders.filter(old), path)
    out.write_append(t.orders.filter(~old), path)
    return plain(t.spark.read.parquet(path))


@query("W2_write_overwrite", "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice FROM orders")
def w2(t):
    path = work_path(t.spark, "overwrite")
    out.write_overwrite(plain_orders(t), path, ["o_orderstatus"])
    changed = plain_orders(t).filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 100)
    out.write_overwrite(changed, path, ["o_orderstatus"])
    return plain(t.spark.read.parquet(path))


@query(
    "W3_write_upsert",
    """SELECT o_orderkey, o_totalprice FROM orders_v2 WHERE o_orderkey % 7 = 0 UNION ALL
       SELECT o_orderkey, o_totalprice FROM orders_v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v2 WHERE o_orderkey % 7 = 0)""",
    "orders_v1 orders_v2",
)
def w3(t):
    store = KeyedTable(t.spark, work_path(t.spark, "upsert"), ["o_orderkey"], buckets=4)
    store.replace(t.orders_v1)
    store.merge(t.orders_v2.filter("o_orderkey % 7 = 0"))
    return store.read().select("o_orderkey", "o_totalprice")


@query(
    "W3_upsert_other_slots",
    """SELECT o_orderkey, o_totalprice FROM orders_v2 WHERE o_orderkey % 7 = 0 UNION ALL
       SELECT o_orderkey, o_totalprice FROM orders_v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v2 WHERE o_orderkey % 7 = 0)""",
    "orders_v1 orders_v2",
)
def w3_slots(t):
    """A store that is opened without the number of buckets takes the stored one."""
    path = work_path(t.spark, "slots")
    KeyedTable(t.spark, path, ["o_orderkey"], buckets=4).replace(t.orders_v1)
    store = KeyedTable(t.spark, path, ["o_orderkey"])
    store.merge(t.orders_v2.filter("o_orderkey % 7 = 0"))
    return store.read().select("o_orderkey", "o_totalprice")


@query(
    "W3_upsert_null_keys",
    """WITH k AS (SELECT CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS k, o_orderkey, o_totalprice FROM orders)
       SELECT k, max_by(o_totalprice, o_orderkey) AS price FROM k GROUP BY k""",
)
def w3_null_keys(t):
    """Null is a key: orders in four loads, a third of them without a customer, leave one row per customer and one without."""
    keyed = t.orders.select(F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("k"), "o_orderkey", "o_totalprice")
    store = KeyedTable(t.spark, work_path(t.spark, "null_keys"), ["k"], buckets=4)
    for i in range(4):
        some = keyed.filter(F.col("o_orderkey") % 4 == i)
        old = store.read()
        newest = (some if old is None else some.union(old)).groupBy("k").agg(F.max_by(F.struct("o_orderkey", "o_totalprice"), "o_orderkey").alias("o"))
        store.merge(newest.select("k", "o.*"))
    return store.read().select("k", F.col("o_totalprice").alias("price"))


@query("W4_write_lake_parquet", _ORDERS)
def w4(t):
    path = work_path(t.spark, "lake")
    out.write_lake_parquet(plain_orders(t), path, "snappy", ["o_orderstatus"])
    return t.spark.read.schema(_DDL).parquet(path)


_CELLS = """SELECT CAST(p_partkey AS VARCHAR) AS id, '"' || p_name || '", ' || p_type AS name, status, '[' || p_size || ',' || p_size || ']' AS sizes,
  CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR) ELSE CAST(p_retailprice AS VARCHAR) END AS price
  FROM part JOIN connectors ON connectorId = p_partkey"""


@query("W5_write_csv", _CELLS, "connectors")
def w5(t):
    path = work_path(t.spark, "csv_out")
    rows = t.connectors.select(
        F.col("connectorId").alias("id"),
        F.concat(F.lit('"'), "connectorName", F.lit('", '), "connectorType").alias("name"),
        "status",
        F.array("size", "size").alias("sizes"),
        "price",
    )
    out.write_csv(rows, path)
    return src.scan_delimited(t.spark, path, schema="id string, name string, status string, sizes string, price string")


@query("W6_write_json", "SELECT connectorId, connectorName, status, size FROM connectors", "connectors")
def w6(t):
    path = work_path(t.spark, "json_out")
    out.write_json(t.connectors.select("connectorId", "connectorName", "status", "size"), path)
    return src.scan_json(t.spark, path, schema="connectorId bigint, connectorName string, status string, size int")


@query("W7_write_layout", _ORDERS)
def w7(t):
    path = work_path(t.spark, "layout")
    out.write_layout(plain_orders(t), path, "o_custkey", "o_orderkey")
    return plain(t.spark.read.parquet(path))


@query("W8_replace_table", "SELECT o_orderkey, o_orderpriority FROM orders")
def w8(t):
    store = KeyedTable(t.spark, work_path(t.spark, "replace"), ["o_orderkey"], buckets=4)
    store.replace(plain_orders(t))
    store.replace(t.orders.select("o_orderkey", "o_orderpriority"))
    return store.read()


@query("W11_write_stream_topic", """SELECT '{"o_orderkey":' || o_orderkey || '}' AS key, o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def w11(t):
    landed, path = work_path(t.spark, "topic_in"), work_path(t.spark, "topic")
    plain_orders(t).write.parquet(landed)
    stream = t.spark.readStream.schema(_DDL).parquet(landed)
    out.write_stream_topic(stream, ["o_orderkey"], work_path(t.spark, "checkpoint"), path=path).awaitTermination()
    return t.spark.read.parquet(path).select("key", F.from_json("value", _DDL).alias("v")).select("key", "v.*")


@query(
    "W12_dated_export",
    """SELECT 'orders' AS name, '2001-08-02' AS export_date, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01 00:00:00'
       UNION ALL SELECT 'customer', d, count(*) FROM customer, (SELECT unnest(['2001-08-01', '2001-08-02']) AS d) GROUP BY d""",
)
def w12(t):
    root = work_path(t.spark, "exports")
    recent = {"orders": F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz")}
    out.dated_export({"customer": t.customer}, root, "2001-08-01")
    for _ in range(2):
        out.dated_export({"orders": t.orders, "customer": t.customer}, root, "2001-08-02", recent)
    parts = [t.spark.read.parquet(f"{root}/{n}").select(F.lit(n).alias("name"), F.col("export_date").cast("string").alias("export_date")) for n in ("orders", "customer")]
    return union_sources(*parts).groupBy("name", "export_date").agg(F.count("*").alias("n"))
