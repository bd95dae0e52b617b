"""Schema discovery, profiling and load recommendations (Q7-Q12, I16, I17).

Everything that reads data is one aggregate per table. What comes to the driver is metadata: names, types and one
summary row per column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Tables = dict[str, DataFrame]

_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
_KEY_TYPES = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_ORDERED = (T.StringType, T.NumericType, T.BooleanType, *_TIMES)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column_rows(df: DataFrame, table: str, describe: Callable[[int, T.StructField], dict[str, str]]) -> DataFrame:
    """One aggregate over the table, turned into one row per column. ``describe`` gives the SQL of each output field."""
    structs = []
    for i, f in enumerate(df.schema):
        fields = ", ".join(f"{_text(name)}, {sql}" for name, sql in describe(i, f).items())
        structs.append(f"named_struct({fields})")
    summary = df.selectExpr("count(*) AS row_count", f"array({', '.join(structs)}) AS entries")
    return summary.selectExpr(f"{_text(table)} AS `table`", "row_count", "inline(entries)")


def column_inventory(tables: Tables, distinct: bool = False) -> DataFrame:
    """Q7. table, column, type, nullable and null count of every column; approximate distinct counts on request."""

    def describe(i: int, f: T.StructField) -> dict[str, str]:
        out = {
            "ordinal": str(i),
            "column": _text(f.name),
            "type": _text(f.dataType.simpleString()),
            "nullable": "'YES'" if f.nullable else "'NO'",
            "null_count": f"count_if({_quoted(f.name)} IS NULL)",
        }
        return {**out, "approx_distinct": f"approx_count_distinct({_quoted(f.name)})"} if distinct else out

    return _union([_column_rows(df, name, describe) for name, df in tables.items()])


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """Q7. The columns of a registered table or view by its name; none for a name that is not known."""
    known = spark.catalog.tableExists(name)
    fields = spark.table(name).schema if known else []
    rows = [(name, i, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO") for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "table string, ordinal int, column string, type string, nullable string")


def schema_drift(old: T.StructType, new: T.StructType) -> list[tuple[str, str]]:
    """Columns that were added, removed or changed type between two schemas."""
    before = {f.name: f.dataType.simpleString() for f in old}
    after = {f.name: f.dataType.simpleString() for f in new}
    out = [(c, "added") for c in after if c not in before]
    out += [(c, "removed") for c in before if c not in after]
    return sorted(out + [(c, "type changed") for c in before if c in after and before[c] != after[c]])


def table_row_counts(tables: Tables) -> DataFrame:
    """Q12. Rows per table; a count without columns reads only file footers."""
    return _union([df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table"), "row_count") for n, df in tables.items()])


def discover_counts(places: dict[str, tuple[str, str]], tables: Tables) -> DataFrame:
    """Q9. catalog, schema, table, rows and number of columns."""
    parts = []
    for name, df in tables.items():
        catalog, schema = places[name]
        where = [F.lit(catalog).alias("catalog"), F.lit(schema).alias("schema"), F.lit(name).alias("table")]
        parts.append(df.agg(F.count("*").alias("row_count")).select(*where, "row_count", F.lit(len(df.columns)).alias("columns")))
    return _union(parts)


def discover_structure(
    metadata: DataFrame, *, catalog: str | None = None, schema: str | None = None, table_pattern: str | None = None, depth: int = 3
) -> DataFrame:
    """Q8. Names down to a depth (1 catalogs, 2 schemas, 3 tables), filtered by exact names and a table pattern.

    At depth 3 schemas left with no table vanish, and with them catalogs left with no schema; a shallower walk does not
    look at tables, so their pattern does not prune it.
    """
    found = metadata
    if catalog:
        found = found.filter(F.col("catalog") == catalog)
    if schema and depth >= 2:
        found = found.filter(F.col("schema") == schema)
    if table_pattern and depth >= 3:
        found = found.filter(F.col("table").rlike(f"(?i){table_pattern}"))
    return found if depth >= 3 else found.select(*["catalog", "schema"][:depth]).distinct()


def schema_index(nested: DataFrame, catalogs: str = "catalogs", search: str | None = None) -> DataFrame:
    """Q11. (path, type) rows of a nested catalog tree, optionally only paths that contain a text."""
    tree = nested.select(F.explode(catalogs).alias("c"))
    schemas = tree.select(F.col("c.name").alias("cn"), F.explode("c.schemas").alias("s"))
    tables = schemas.select("cn", F.col("s.name").alias("sn"), F.explode("s.tables").alias("t"))
    index = (
        tree.select(F.col("c.name").alias("path"), F.lit("catalog").alias("type"))
        .unionByName(schemas.select(F.concat_ws(".", "cn", "s.name").alias("path"), F.lit("schema").alias("type")))
        .unionByName(tables.select(F.concat_ws(".", "cn", "sn", "t").alias("path"), F.lit("table").alias("type")))
    )
    return index.filter(F.col("path").contains(search)) if search else index


#: Logarithm of the size of a sketch of distinct values: 4,096 bytes, a standard error of 1.6 %.
_SKETCH = 12


def _sketch(c: str) -> str:
    """A sketch of the distinct values of a column, nulls apart. It is one binary value, however many columns a table has."""
    return f"hll_sketch_agg(CASE WHEN {c} IS NOT NULL THEN xxhash64({c}) END, {_SKETCH})"


def _describe(i: int, f: T.StructField) -> dict[str, str]:
    c, timed = _quoted(f.name), isinstance(f.dataType, _TIMES)
    shown = f"date_format({{}}({c}), 'yyyy-MM-dd HH:mm:ss')" if timed else f"CAST({{}}({c}) AS STRING)"
    shown = shown if isinstance(f.dataType, _ORDERED) else "CAST(NULL AS STRING)"
    return {
        "ordinal": str(i),
        "column": _text(f.name),
        "type": _text(f.dataType.simpleString()),
        "is_time": str(timed).lower(),
        "null_count": f"count_if({c} IS NULL)",
        "min_value": shown.format("min"),
        "max_value": shown.format("max"),
        "approx_distinct": f"hll_sketch_estimate({_sketch(c)})" if timed or isinstance(f.dataType, _KEY_TYPES) else "0L",
    }


PROFILE = (
    "`table` string, row_count bigint, ordinal int, `column` string, type string, is_time boolean, null_count bigint, "
    "min_value string, max_value string, approx_distinct bigint, is_unique boolean, tested boolean"
)


NEARLY_UNIQUE = 0.9  # six standard errors (1.6 % each) of the estimate below one


def profile_tables(tables: Tables, near: float = NEARLY_UNIQUE) -> DataFrame:
    """Q10. Per column: rows, nulls, least and greatest value, and whether it identifies the rows.

    One pass over each table estimates distinct counts. Columns whose estimate is at least ``near`` of the row count get
    the exact test, which groups by that column; ``tested`` says which did, and 0 tests all. The result is metadata (one row
    per column), so it is gathered here and not computed again by every use.
    """
    rows = _union([_column_rows(df, name, _describe) for name, df in tables.items()]).collect()

    def may_be_key(r) -> bool:
        kind = tables[r["table"]].schema[r["column"]].dataType
        enough = r["row_count"] > 0 and r["null_count"] == 0 and r["approx_distinct"] >= near * r["row_count"]
        return enough and isinstance(kind, _KEY_TYPES)

    likely = [(r["table"], r["column"]) for r in rows if may_be_key(r)]
    tests = [_repeats(tables[t], c).selectExpr(f"{_text(t)} AS t", f"{_text(c)} AS c") for t, c in likely]
    repeated = {(r["t"], r["c"]) for r in _union(tests).collect()} if tests else set()
    unique = set(likely) - repeated
    spark = next(iter(tables.values())).sparkSession
    at = [(r["table"], r["column"]) for r in rows]
    return spark.createDataFrame([(*r, c in unique, c in likely) for r, c in zip(rows, at)], PROFILE)


#: Sets of columns whose distinct values one pass over a table estimates.
_SETS_PER_PASS = 128


def _xor(parts: list[Column]) -> Column:
    """Exclusive or of hashes, as a balanced expression; of none it is zero."""
    if len(parts) < 2:
        return parts[0] if parts else F.lit(0).cast("long")
    half = len(parts) // 2
    return _xor(parts[:half]).bitwiseXOR(_xor(parts[half:]))


class _Lattice:
    """Sets of the columns that may be in a key, as bit masks in table order, and what is known of them."""

    def __init__(self, df: DataFrame, columns: list[str], distinct: list[int], rows: int, near: float):
        self.df, self.columns, self.distinct, self.rows, self.near = df, columns, distinct, rows, near
        self.all = (1 << len(columns)) - 1
        self.refuted: list[int] = []  # sets that are no keys; a key has a column outside each
        # sets that grow by the columns with the fewest values, so that they stay no keys for long
        order, n = sorted(range(len(columns)), key=lambda i: (distinct[i], i)), len(columns)
        sizes = sorted({0, n // 4, n // 2, *(n - max(n >> k, 1) for k in range(2, 9)), n})
        self.bases = [sum(1 << i for i in order[:size]) for size in sizes]

    def members(self, mask: int) -> list[int]:
        return [i for i in range(len(self.columns)) if mask >> i & 1]

    def refute(self, mask: int) -> None:
        if not any(mask | r == r for r in self.refuted):
            self.refuted = [r for r in self.refuted if r | mask != mask] + [mask]

    def estimates(self, masks: list[int]) -> list[int]:
        """Distinct values of each set, one pass over the table for every ``_SETS_PER_PASS`` of them.

        A set's value is the exclusive or of a hash per column; the base it differs least from is worked out once per row.
        """
        hashes = [F.xxhash64(F.lit(i), _quoted(c)).alias(f"h{i}") for i, c in enumerate(self.columns)]
        h = lambda mask: [F.col(f"h{i}") for i in self.members(mask)]
        rows = self.df.select(*hashes).select("*", *[_xor(h(b)).alias(f"b{j}") for j, b in enumerate(self.bases)])
        out: list[int] = []
        for at in range(0, len(masks), _SETS_PER_PASS):
            asked = []
            for m in masks[at : at + _SETS_PER_PASS]:
                j = min(range(len(self.bases)), key=lambda j: (m ^ self.bases[j]).bit_count())
                value = _xor([F.col(f"b{j}"), *h(m ^ self.bases[j])])
                asked.append(F.hll_sketch_estimate(F.hll_sketch_agg(value, F.lit(_SKETCH))))
            out += rows.agg(*asked).head()
        return out

    def possible(self, width: int) -> Iterator[int]:
        """Sets of ``width`` columns that no refuted set holds and that have enough values, in table order."""
        n, most = len(self.columns), max(self.distinct)

        def walk(first: int, chosen: int, left: int, values: int) -> Iterator[int]:
            open_ = [~r & self.all for r in self.refuted if not chosen & ~r]  # each needs one of its columns yet
            if not left:
                if not open_ and values >= self.near * self.rows:
                    yield chosen
                return
            if values * most**left < self.near * self.rows:
                return
            last = min((o.bit_length() for o in open_), default=n)  # the column after it comes too late for that set
            for i in range(first, min(last, n)):
                yield from walk(i + 1, chosen | 1 << i, left - 1, values * self.distinct[i])

        yield from walk(0, 0, width, 1)

    def is_key(self, mask: int) -> bool:
        """The exact test. Texts are compared by 128-bit digest, so that long ones are not shuffled."""
        names = [self.columns[i] for i in self.members(mask)]
        texts = [c for c in names if isinstance(self.df.schema[c].dataType, T.StringType)]
        values = [F.expr(f"md5({_quoted(c)})" if c in texts else _quoted(c)).alias(f"v{i}") for i, c in enumerate(names)]
        rows = self.df.select(*values)
        return rows.groupBy(*rows.columns).count().filter("count > 1").isEmpty()

    def least_key(self, widest: int) -> list[str] | None:
        low, n = self.near * self.rows, len(self.columns)
        # every column left out in turn, and all of them: what cannot be spared is in every key
        masks = [self.all, *(self.all & ~(1 << i) for i in range(n))]
        for m, size in zip(masks, self.estimates(masks)):
            if size < low:
                self.refute(m)
        if self.all in self.refuted:
            return None
        per_round = max(1, _SETS_PER_PASS // len(self.bases))
        for width in range(2, min(widest, n) + 1):
            while asked := list(islice(self.possible(width), per_round)):
                sets = [list(dict.fromkeys(m | b for b in self.bases)) for m in asked]
                sizes = iter(self.estimates([x for each in sets for x in each]))
                for m, each in zip(asked, sets):
                    small = [x for x, size in [(x, next(sizes)) for x in each] if size < low]
                    for x in small:
                        self.refute(x)
                for m in asked:
                    if any(m | r == r for r in self.refuted):
                        continue
                    if self.is_key(m):
                        return [self.columns[i] for i in self.members(m)]
                    self.refute(m)
        return None


def key_columns(tables: Tables, profiles: DataFrame, widest: int = 4, near: float = NEARLY_UNIQUE) -> DataFrame:
    """I16. ``table, key``: the fewest columns, the first such in table order, that identify the rows of a table without a
    key column, up to ``widest`` columns; no row for a table without any.

    A search by levels over sets of columns without nulls. Sketches of distinct values refute most sets, and with a set all
    its subsets: the first pass leaves out each column in turn, so what every key needs is known before the first level, and
    each refuted candidate grows by the columns with few values for as long as it stays refuted. A candidate must have a
    column outside every refuted set. What sketches cannot tell is tested exactly, on all rows. With a ``near`` of 0 nothing
    is refuted by sketches.
    """
    rows = profiles.orderBy("ordinal").collect()
    found = []
    for name, df in tables.items():
        mine = [r for r in rows if r["table"] == name]
        if any(r["is_unique"] for r in mine) or not mine or not mine[0]["row_count"]:
            continue
        parts = [r for r in mine if not r["null_count"] and isinstance(df.schema[r["column"]].dataType, _KEY_TYPES)]
        parts = [r for r in parts if r["approx_distinct"] > 1]  # a constant is in no least key
        if len(parts) < 2:
            continue
        lattice = _Lattice(df, [r["column"] for r in parts], [r["approx_distinct"] for r in parts], mine[0]["row_count"], near)
        if key := lattice.least_key(widest):
            found.append((name, key))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(found, "table string, key array<string>")


def _repeats(df: DataFrame, column: str) -> DataFrame:
    """A row if some value occurs twice. Texts are compared by 128-bit digest, so that long ones are not shuffled."""
    c = _quoted(column)
    value = f"md5({c})" if isinstance(df.schema[column].dataType, T.StringType) else c
    return df.selectExpr(f"{value} AS v").groupBy("v").count().filter("count > 1").limit(1)


# Names that usually hold the time of the last change, best first; a tie-break only.
_WATERMARK_NAMES = ("updated_at", "modified_at", "last_modified", "update_time", "timestamp", "ts", "created_at")
_OPERATION_NAMES = ("op", "_op", "operation", "__op", "change_type", "_change_type", "cdc_operation")


def recommend_ingestion(profiles: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """I16. One row per table: how to load it, how sure that is (0-100) and why. The published contract names the
    fields; the rules are this library's own:

    * merge columns: the first column that is never null and unique, else those of ``keys`` (see :func:`key_columns`);
    * watermark: the time column without nulls with the most distinct values, usual names first among equals;
    * an operation column with a key gives ``cdc``; key and watermark give ``delta``; a watermark alone gives
      ``historical``; anything else ``snapshot``;
    * confidence: 95 cdc, 90 delta, 70 historical, 80 snapshot with a key, 60 without; an empty table 0.
    """
    time_rank = F.coalesce(F.array_position(F.array(*map(F.lit, _WATERMARK_NAMES)), F.lower("column")), F.lit(0))
    usual = F.when(time_rank == 0, 99).otherwise(time_rank)
    key = F.min_by(F.when(F.col("is_unique"), F.col("column")), F.when(F.col("is_unique"), F.col("ordinal")))
    fit = F.col("is_time") & (F.col("null_count") == 0) & (F.col("row_count") > 0)
    best = F.struct((-F.col("approx_distinct")).alias("a"), usual.alias("b"), "ordinal")
    watermark = F.min_by(F.when(fit, F.col("column")), F.when(fit, best))
    found = profiles.groupBy("table").agg(
        F.max("row_count").alias("row_count"),
        key.alias("_key"),
        watermark.alias("_watermark"),
        F.bool_or(F.lower("column").isin(*_OPERATION_NAMES)).alias("_has_op"),
    )
    if keys is None:
        found = found.withColumn("key", F.lit(None).cast("array<string>"))
    else:
        found = found.join(keys, "table", "left")
    found = found.withColumn("_keys", F.coalesce(F.when(F.col("_key").isNotNull(), F.array("_key")), "key"))
    has_key, has_time = F.col("_keys").isNotNull(), F.col("_watermark").isNotNull()
    kind = (
        F.when(has_key & F.col("_has_op"), "cdc").when(has_key & has_time, "delta").when(has_time, "historical").otherwise("snapshot")
    )
    sure = (
        F.when(F.col("row_count") == 0, 0)
        .when(kind == "cdc", 95)
        .when(kind == "delta", 90)
        .when(kind == "historical", 70)
        .when(has_key, 80)
        .otherwise(60)
    )
    reason = F.concat(
        F.coalesce(F.concat(F.lit("unique key "), F.array_join("_keys", ", ")), F.lit("no unique key")),
        F.lit(", "),
        F.coalesce(F.concat(F.lit("time column "), "_watermark"), F.lit("no time column")),
    )
    return found.select(
        "table",
        kind.alias("ingestionType"),
        sure.alias("confidence"),
        F.col("_keys").alias("mergeColumns"),
        F.when(has_time, F.array("_watermark")).alias("watermarkColumnName"),
        (kind == "cdc").alias("cdcSupported"),
        reason.alias("reason"),
    )


def apply_recommendation(artifacts: DataFrame, recommendations: DataFrame) -> DataFrame:
    """I17. Override type, keys and time columns of the artifacts whose table has a recommendation."""
    rec = recommendations.select(
        F.col("table").alias("sourceObjectName"),
        F.col("ingestionType").alias("_type"),
        F.col("mergeColumns").alias("_keys"),
        F.try_element_at("watermarkColumnName", F.lit(1)).alias("_time"),
    )
    joined = artifacts.join(rec, "sourceObjectName", "left")
    moving = F.col("_type").isin("delta", "historical")
    return (
        joined.withColumn("ingestionType", F.coalesce("_type", "ingestionType"))
        .withColumn("primaryKeys", F.coalesce("_keys", "primaryKeys"))
        .withColumn("timestampColumn", F.coalesce("_time", "timestampColumn"))
        .withColumn("incrementalColumn", F.coalesce(F.when(moving, F.col("_time")), "incrementalColumn"))
        .drop("_type", "_keys", "_time")
    )


def run_sql(spark: SparkSession, text: str, limit: int | None = None, **args) -> DataFrame:
    """Q1, Q2. Any SQL text over the registered views. A limit wraps the whole statement, whatever words it contains."""
    result = spark.sql(text.strip().rstrip(";"), args=args or None)
    return result.limit(limit) if limit else result
