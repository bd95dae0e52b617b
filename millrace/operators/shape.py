"""Column selection, flattening, paging, top-k and set operations (P*, L*, U*)."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.sliced import SLICE, orderable, top_per_group, with_slices
from millrace.sources.store import join_keys

PAGE_ROWS = 1_000_000  # rows one task may sort for a page
PAGE_SLICES = 1024


def _names(fields: str | Sequence[str]) -> list[str]:
    return [f.strip() for f in fields.split(",")] if isinstance(fields, str) else list(fields)


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def select_fields(df: DataFrame, fields: str | Sequence[str]) -> DataFrame:
    """P1. Listed columns that exist, in the listed order; unknown names are ignored."""
    wanted = [f for f in dict.fromkeys(_names(fields)) if f in df.columns]
    return df.select(*[_quoted(f) for f in wanted])


def _path_tree(paths: Sequence[str]) -> dict:
    """Nested dict of the paths; an empty dict means the whole value."""
    tree: dict = {}
    for path in paths:
        node, whole = tree, False
        for i, part in enumerate(path.split(".")):
            known = part in node
            child = node.setdefault(part, {})
            if known and not child:
                whole = True
                break
            node = child
        if not whole:
            node.clear()
    return tree


def _rebuild(value: Column, data_type: T.DataType, tree: dict) -> Column | None:
    if not tree:
        return value
    if isinstance(data_type, T.ArrayType):
        if _rebuild(value[0], data_type.elementType, tree) is None:
            return None
        return F.transform(value, lambda x: _rebuild(x, data_type.elementType, tree))
    if not isinstance(data_type, T.StructType):
        return None
    kept = []
    for name, below in tree.items():
        if name in data_type.names:
            part = _rebuild(value.getField(name), data_type[name].dataType, below)
            if part is not None:
                kept.append(part.alias(name))
    return F.when(value.isNotNull(), F.struct(*kept)) if kept else None


def select_nested_fields(df: DataFrame, paths: str | Sequence[str]) -> DataFrame:
    """P2. Dotted paths, keeping the nesting: siblings share one struct and arrays of structs are mapped.

    Paths that do not exist are ignored. Only the fields named are read from a nested columnar file.
    """
    kept = []
    for name, below in _path_tree(_names(paths)).items():
        if name in df.columns:
            part = _rebuild(_quoted(name), df.schema[name].dataType, below)
            if part is not None:
                kept.append(part.alias(name))
    return df.select(*kept)


def _leaves(value: Column, data_type: T.DataType, path: str):
    if isinstance(data_type, T.StructType):
        for f in data_type:
            yield from _leaves(value.getField(f.name), f.dataType, f"{path}.{f.name}")
    else:
        yield value.alias(path)


def flatten_struct(df: DataFrame) -> DataFrame:
    """P3. Nested structs as ``a.b`` columns; arrays stay whole."""
    return df.select(*[leaf for f in df.schema for leaf in _leaves(_quoted(f.name), f.dataType, f.name)])


def reorder_drop(df: DataFrame, first: str, dropped: str, requested: Sequence[str] | None = None) -> DataFrame:
    """P4. Move one column to the front and drop another, unless it is asked for, when it goes last."""
    rest = [c for c in df.columns if c not in (first, dropped)]
    last = [dropped] if requested and dropped in requested else []
    return df.select(*[_quoted(c) for c in [first, *rest, *last]])


def record_to_rows(df: DataFrame, ids: Sequence[str], values: Sequence[str], missing=0, cast="double") -> DataFrame:
    """P5. A wide row as (Metric, Count) rows; null counts as ``missing``."""
    flat = df.select(*ids, *[_quoted(v).cast(cast).alias(v) for v in values])
    long = flat.unpivot(list(ids), list(values), "Metric", "Count")
    return long.withColumn("Count", F.coalesce("Count", F.lit(missing).cast(cast)))


def table_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str], only_changed=True) -> DataFrame:
    """P7. (keys, field, old, new, status) per differing field, by one full outer join on the keys.

    Status is ``changed`` or ``unchanged`` for keys in both, ``added`` or ``removed`` for keys in one.
    """

    def boxed(df: DataFrame, side: str) -> DataFrame:
        return df.select(*keys, F.struct(*fields).alias(side))

    right = boxed(new, "n").withColumnsRenamed({k: f"_right_{k}" for k in keys})
    left, same = boxed(old, "o"), F.lit(True)
    for k in keys:  # null is a key
        same = same & left[k].eqNullSafe(right[f"_right_{k}"])
    # every row has its box, so a side without one has no row
    joined = left.join(right, same, "full_outer")
    joined = joined.select(*[F.when(F.col("o").isNull(), F.col(f"_right_{k}")).otherwise(F.col(k)).alias(k) for k in keys], "o", "n")

    def entry(f: str) -> Column:
        a, b = F.col("o").getField(f), F.col("n").getField(f)
        status = (
            F.when(F.col("o").isNull(), "added")
            .when(F.col("n").isNull(), "removed")
            .when(a.eqNullSafe(b), "unchanged")
            .otherwise("changed")
        )
        return F.struct(
            F.lit(f).alias("field"), a.cast("string").alias("old"), b.cast("string").alias("new"), status.alias("status")
        )

    entries = F.array(*[entry(f) for f in fields])
    if only_changed:
        entries = F.filter(entries, lambda e: e["status"] != "unchanged")
    return joined.select(*keys, F.inline(entries))


def differing_slices(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str], slices: int = 1024) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in those slices of the key in which they differ, for a comparison that need not join the rest.

    Each table is read once for one digest per slice: the sum of two 64-bit hashes of its rows, taken off for the other
    table, so neither order nor place of the rows matters. It is combined in the tasks, and one row per slice that differs
    comes to the driver. Slices follow the first key where that is a number or a time, so changes that lie together leave
    most slices equal; else they follow a hash of the keys. A difference is lost only if both sums agree by chance
    (about 2^-128 a slice). Columns of unlike types take a common one.
    """
    columns = list(dict.fromkeys([*keys, *fields]))
    both = old.select(*columns, F.lit(1).alias("_side")).unionByName(new.select(*columns, F.lit(-1).alias("_side")))
    if orderable(both.schema[keys[0]].dataType):
        both = with_slices(both, keys[0], slices)
    else:
        both = both.withColumn(SLICE, F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int"))
    # a null leaves a hash as it was, so (null, 1) and (1, null) need the marks to differ
    row = [part for c in columns for part in (F.isnull(_quoted(c)), _quoted(c))]
    exact = [F.sum(h.cast("decimal(20,0)") * F.col("_side")) for h in (F.xxhash64(*row), F.xxhash64(F.lit("second"), *row))]
    digests = both.groupBy(SLICE).agg(F.sum("_side").alias("n"), exact[0].alias("a"), exact[1].alias("b"))
    unlike = [r[SLICE] for r in digests.filter("n <> 0 OR a <> 0 OR b <> 0").select(SLICE).collect()]
    left = both.filter(F.col(SLICE).isin(unlike))
    return left.filter("_side = 1").select(*columns), left.filter("_side = -1").select(*columns)


def table_diff_by_digest(
    old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str], only_changed=True, slices: int = 1024
) -> DataFrame:
    """P7 for large tables that differ in few places: :func:`table_diff` of the slices that differ."""
    if not only_changed:
        return table_diff(old, new, keys, fields, False)
    return table_diff(*differing_slices(old, new, keys, fields, slices), keys, fields)


def limit_rows(df: DataFrame, n: int | None, order: Sequence[Column | str], fields=None) -> DataFrame:
    """L1. The first ``n`` rows of a total order, then the fields. 0 or None keeps all rows."""
    shaped = df.orderBy(*order).limit(n) if n else df
    return select_fields(shaped, fields) if fields else shaped


_BYTES = 6  # of a text in a number: quantiles are doubles inside, which hold whole numbers of 53 bits
_WINDOW = 1 << 16  # bytes of a text compared on the driver


def _part(field: T.StructField, at: int) -> tuple[Column | None, int]:
    """A number that never falls along a column, for rows that agree in the bytes before ``at``, and up to which byte it tells them apart.

    A number or time is its own; a text is its next bytes, zeros beyond its end; other types have none.
    """
    if orderable(field.dataType):
        return _quoted(field.name), 0
    if field.dataType == T.StringType():  # compared by bytes, without a collation
        some = F.hex(F.substring(_quoted(field.name).cast("binary"), at + 1, _BYTES))
        return F.conv(F.rpad(some, 2 * _BYTES, "0"), 16, 10).cast("long"), at + _BYTES
    return None, 0


def _shared(df: DataFrame, key: str, at: int) -> int | None:
    """How many bytes all texts begin with, where they agree before ``at``; None if they are equal.

    All begin with what the least and the greatest begin with; of these two, a window at a time comes to the driver.
    """
    while True:
        low, high = df.agg(*[F.substring(f(_quoted(key)).cast("binary"), at + 1, _WINDOW) for f in (F.min, F.max)]).head()
        if low is None or (low == high and len(low) < _WINDOW):
            return None
        both = len(commonprefix([bytes(low), bytes(high)]))
        at += both
        if both < _WINDOW:
            return at


def _agree(df: DataFrame, value: Column) -> bool:
    return df.agg(F.min(value).eqNullSafe(F.max(value)) & F.count(value).isin(F.lit(0), F.count("*"))).head()[0] is True


def _narrow(df: DataFrame, part: Column, skip: int, last: int) -> tuple[DataFrame, int, int]:
    """The rows around those from ``skip`` to ``last`` in the order of ``part``, how many rows precede them, and how many they are.

    Two quantiles bound them, a little outside the page. They are estimates, so the rows before and between them are counted, and
    a bound that would cut the page is not used. A value is kept or left out as a whole; nulls come first. One row of counts
    and the quantiles come to the driver, and a row is compared with two constants.
    """
    rows = df.withColumn("_part", part)
    value = F.col("_part")
    at = [i / PAGE_SLICES for i in range(1, PAGE_SLICES)]
    points = F.percentile_approx(value, at, 10 * PAGE_SLICES).cast("array<string>")
    n, known, points = rows.agg(F.count("*"), F.count(value), points).head()
    nulls = n - known
    if last <= nulls:
        return rows.filter(value.isNull()).drop("_part"), 0, nulls

    data_type = rows.schema["_part"].dataType

    def bound(row: int, margin: int) -> Column | None:
        i = max(row - nulls, 0) * PAGE_SLICES // max(known, 1) + margin
        if not points or not 0 < i < PAGE_SLICES:
            return None
        point, way = points[i - 1], 1 if margin > 0 else -1
        # a quantile is a double inside, so go past the number that it may have been
        if data_type == T.LongType():
            point = str(min(max(int(point) + way * (abs(int(point)) >> 52), -(1 << 63)), (1 << 63) - 1))
        elif isinstance(data_type, T.DecimalType):
            most = Decimal(10**data_type.precision - 1).scaleb(-data_type.scale)
            point = str(min(max(Decimal(point) + way * abs(Decimal(point)) / (1 << 52), -most), most))
        return F.lit(point).cast(data_type)

    low, high = bound(skip, -1), bound(last, 2)
    none = F.lit(False)
    before, after = rows.agg(F.count_if(none if low is None else value < low), F.count_if(none if high is None else value > high)).head()
    if nulls + before > skip:
        low, before = None, 0
    if n - after < last:
        high, after = None, 0
    within = F.lit(True) if low is None else value >= low
    within = within if high is None else within & (value <= high)
    if skip < nulls:
        return rows.filter(value.isNull() | within).drop("_part"), 0, n - after
    return rows.filter(value.isNotNull() & within).drop("_part"), nulls + before, known - before - after


def page_rows(df: DataFrame, order: Sequence[Column | str], offset: int = 0, limit: int | None = None, fields=None, most: int | None = None) -> DataFrame:
    """L2. Offset, then limit, then fields, over a total order.

    A sorted offset makes one task hold all rows up to the page's end. So beyond ``most`` of them (``PAGE_ROWS``) a page ordered by plain
    column names is found by counting: quantiles of the first column bound the page, and by exact counts the rows before and behind
    fall away before the sort, again and again until few enough are left. Texts are cut by their
    bytes, six at a time, and what all that are left begin with is passed over. A value that many rows share is cut along the next
    column. This reads the table twice for a cut, once for its quantiles and once for the counts, each time the order columns alone. It goes on with a plain sort where a
    column is neither number, time nor text, or without a limit.
    """
    skip, most = max(offset, 0), PAGE_ROWS if most is None else most
    if limit and skip + limit > most and all(isinstance(c, str) for c in order):
        enough = max(most, limit)
        for key in order:
            held, at = None, 0
            while at is not None:
                part, reach = _part(df.schema[key], at)
                if part is None:
                    break
                same = False
                while not same and (held is None or held > enough):
                    df, before, now = _narrow(df, part, skip, skip + limit)
                    skip -= before
                    same, held = now == held, now
                if held <= enough or not reach or not _agree(df, part) or (df.agg(F.max(F.octet_length(key))).head()[0] or 0) <= reach:
                    break
                # what all begin with is left out at once, however long it is
                shared = _shared(df, key, at)
                at = None if shared is None else max(shared, reach)
            # the next column orders the rows that are left only if they agree in this one
            if held is None or held <= enough or not _agree(df, F.col(key)):
                break
    page = df.orderBy(*order)
    page = page.offset(skip) if skip > 0 else page
    page = page.limit(limit) if limit else page
    return select_nested_fields(page, fields) if fields else page


def page_after(df: DataFrame, keys: str | Sequence[str], last, n: int) -> DataFrame:
    """L2 by key: the next ``n`` rows after a key. The bound is pushed to the scan, so page depth costs nothing.

    The keys together must tell rows apart, else rows that share the last ones would be missed: add a column that does.
    ``last`` has a value per key, or is the value of the only one.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    if last is None:
        return df.orderBy(*names).limit(n)
    values = [last] if isinstance(keys, str) else list(last)
    after = F.lit(False)
    for name, value in zip(reversed(names), reversed(values), strict=True):
        after = (F.col(name) > F.lit(value)) | ((F.col(name) == F.lit(value)) & after)
    # the first key alone bounds the scan
    return df.filter((F.col(names[0]) >= F.lit(values[0])) & after).orderBy(*names).limit(n)


def sort_two_keys(df: DataFrame, first: str, second: str, *ties: str, collation: str = "UNICODE") -> DataFrame:
    """L4. Sort by two text columns in dictionary order."""
    return df.orderBy(F.collate(F.col(first), collation), F.collate(F.col(second), collation), *ties)


def sort_option(df: DataFrame, sort_by: str, sort_order: str = "asc", *ties: str) -> DataFrame:
    """L5. Sort by one column, ascending or descending."""
    c = F.col(sort_by)
    return df.orderBy(c.desc() if sort_order.lower() == "desc" else c.asc(), *ties)


def top_k(df: DataFrame, metric: str, k: int, tie: str) -> DataFrame:
    """L6, L8, L9. The k greatest by a metric, null as zero, ties by the given key."""
    return df.orderBy(F.coalesce(F.col(metric), F.lit(0)).desc(), tie).limit(k)


def top_k_slowest(df: DataFrame, duration: str, k: int, *ties: Column | str) -> DataFrame:
    """L7. The k longest, rows without a duration last."""
    return df.orderBy(F.col(duration).desc_nulls_last(), *ties).limit(k)


def top_per_group_with_rest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """L12. The first k rows of each group with ``more``, the count of the rows left out.

    The count is its own combined aggregate, so a hot group never has to sit whole in one task.
    """
    sizes = df.groupBy(*keys).agg(F.greatest(F.count("*") - k, F.lit(0)).alias("more"))
    return top_per_group(df, keys, order, k).join(sizes, list(keys))


def union_sources(*parts: DataFrame) -> DataFrame:
    """U1. All rows of all parts by column name; a column some part lacks is null there."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def distinct_ids(df: DataFrame, value: str, position: str) -> DataFrame:
    """U2. Each id once, with the place of its first occurrence."""
    return df.groupBy(value).agg(F.min(position).alias(position))


def added_removed_by_digest(old: DataFrame, new: DataFrame, keys: Sequence[str], slices: int = 1024) -> DataFrame:
    """U3 for large tables that differ in few places: :func:`added_removed` of the slices whose keys differ."""
    return added_removed(*differing_slices(old, new, keys, [], slices), keys)


def added_removed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U3. Keys in only one of the two, marked ``added`` or ``removed``. Null is a key."""
    k = list(keys)
    added = join_keys(new, old.select(*k), k, "left_anti").select(*k, F.lit("added").alias("status"))
    removed = join_keys(old, new.select(*k), k, "left_anti").select(*k, F.lit("removed").alias("status"))
    return added.unionByName(removed)
