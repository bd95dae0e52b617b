"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. Each query runs once to warm up and is
then timed; its whole result is produced and thrown away (``noop`` sink), so no time goes into sending rows to Python.
The checking SQL is timed in DuckDB on the same files as well, unless ``BENCH_YARDSTICK=0``.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from millrace.plans import REGISTRY  # noqa: E402
from millrace.plans.registry import TABLE_NAMES, Tables  # noqa: E402
from millrace.session import build_session  # noqa: E402

# Headline queries, and for the ingestion modes the table whose rows are loaded.
HEADLINE = {
    "F1_filter_name": None,
    "F19_fuzzy_subsequence": None,
    "A4_success_rate": None,
    "A8_run_stats_by_entity": None,
    "A10_health_status": None,
    "A11_failure_alerts": None,
    "A12_usage_rollup_user": None,
    "A14_usage_levels": None,
    "A17_daily_revenue": None,
    "N1_recent_vs_previous": None,
    "N5_growth_over_time": None,
    "L12_top_per_group_with_rest": None,
    "J4_connector_usage": None,
    "J7_fuzzy_match_join": None,
    "L10_top_similar": None,
    "P7_config_diff": None,
    "D2_find_duplicates": None,
    "D4_validate_rules": None,
    "Q7_column_inventory": None,
    "I16_recommend_ingestion": None,
    "X5_format_duration": None,
    "X16_text_size_budget": None,
    "S3_scan_delimited": "orders",
    "W4_write_lake_parquet": "orders",
    "W3_write_upsert": "orders",
    "I3_delta_then_daily_revenue": "orders",
    "I8_scd2": "events",
    "I9_ingest_cdc_batch": "orders",
    "I11_auto_explode": "embeddings",
    "T2_stream_append": "events",
    "T3_stream_dedup": "events",
}


def run(t: Tables, name: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(t).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def yardstick(folder: str, names: list[str]) -> dict[str, float]:
    import duckdb

    con, out = duckdb.connect(), {}
    for name in TABLE_NAMES:
        path = f"{folder}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    for name in names:
        if REGISTRY[name].sql:
            start = time.perf_counter()
            con.execute(REGISTRY[name].sql).fetchall()
            out[name] = round(time.perf_counter() - start, 4)
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        # each DataFrame call otherwise records its Python call site, which is for debugging
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    names = [n for n in HEADLINE if not sys.argv[1:] or n in sys.argv[1:]]
    times, speed = {}, {}
    for name in names:
        run(tables, name)
        times[name] = round(run(tables, name), 4)
        if HEADLINE[name]:
            speed[name] = round(getattr(tables, HEADLINE[name]).count() / times[name])
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows_per_sec": speed,
        "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf")),
        "cpus": int(cpus),
    }
    if os.environ.get("BENCH_YARDSTICK", "1") != "0":
        result["duckdb_sec"] = yardstick(folder, names)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
