"""Small tables with what real ones hold: nulls, empty and very long texts, ties, repeated rows and odd column names."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# columns named like those the operators use inside
CLASHING = ["row", "h", "kept", "text_hash", "fp", "copies", "lines", "at", "copy", "row_key", "wanted", "rank", "n_words", "Words", "batch", "item.id"]

LONG_LINE = "a line that many of the documents share, long enough to count"


def sample_texts() -> list[tuple[int | None, str | None]]:
    words = [f"w{i}" for i in range(40)]
    out: list[tuple[int | None, str | None]] = [
        (1, "Hello World, hello again"),
        (7, "HELLO world, hello AGAIN"),
        (3, "hello world, hello again"),
        (3, "hello world, hello again"),  # a repeated row
        (4, None),
        (5, ""),
        (None, None),
        (None, "Hello World, hello again"),
        (6, " \t\n "),
        (8, "Élan VITAL élan vital"),
        (9, "élan vital ÉLAN vital"),
        (10, "one"),
        (11, " ".join(words)),
        (12, " ".join([*words[:20], "changed", *words[20:]])),
        (13, "x " * 30_000 + "end"),
        (14, "\n".join([LONG_LINE, "own words of fourteen", LONG_LINE.upper()])),
        (14, "another text with an id that is there twice"),
        *((20 + i, f"{LONG_LINE}  \nown line number {i}\n\t{LONG_LINE}") for i in range(6)),
        (30, LONG_LINE),
        (-5, "negative id"),
    ]
    return out


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]] | None = None) -> DataFrame:
    """``doc_id, text, source`` and the clashing columns."""
    rows = sample_texts() if rows is None else rows
    sources = ["b", "a", None, "é", "Z"]
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
        + [T.StructField(c, T.StringType()) for c in CLASHING]
    )
    data = [(i, t, sources[n % 5], *["x"] * len(CLASHING)) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, schema).repartition(3)


def nothing(spark: SparkSession) -> DataFrame:
    return documents(spark, [])


def in_sql(sql: str, **tables: DataFrame) -> list[tuple]:
    """Rows of a query over the given tables, columns in order of their names."""
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return ordered(names, result.fetchall())


def ordered(names: list[str], rows: list[tuple]) -> list[tuple]:
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in at) for r in rows), key=repr)


def rows(df: DataFrame) -> list[tuple]:
    return ordered(df.columns, [tuple(r) for r in df.collect()])
