"""Run registered queries beside their SQL and compare: ``python tests/oracle_check.py [folder] [name prefix ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from millrace.plans.registry import TABLE_NAMES  # noqa: E402
from millrace.session import build_session  # noqa: E402


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLE_NAMES:
        path = f"{folder}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con, sql):
    """None when names, row count and values agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = as_rows(names, result.fetchall())
    found = as_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} expected {sorted(names)}"
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}; first found {found[:1]} expected {expected[:1]}"
    for a, b in zip(found, expected):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"found {a} expected {b}"
    return None


def main(folder: str, prefixes: list[str]) -> int:
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = difference(df, con, sql[name]) if name in sql else f"no SQL: {df.count()} rows"
        except Exception as e:  # noqa: BLE001 - report and go on to the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        ok = problem is None or problem.startswith("no SQL")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]) else 0)
