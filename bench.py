"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import logging
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from oreworks.plans.tuning import STATIC_CONF, session_conf  # noqa: E402
from oreworks.workload import registered  # noqa: E402

HEADLINE = (
    "silver_a_orders",
    "silver_b_customer",
    "silver_b_documents",
    "dedup_lineitem",
    "dedup_events",
    "dedup_documents",
    "dedup_hot_null_key",
    "dedup_whole_rows",
    "quality_score_orders",
    "silver_c_lineitem",
    "silver_c_pages",
    "completeness_orders",
    "completeness_lineitem",
    "duplicates_lineitem",
    "schema_compliance",
    "quality_report",
    "expect_warn_counts",
    "expect_drop",
    "stage_checks",
    "run_summary",
    "rows_removed",
    "error_summary",
    "latest_errors",
    "throughput_metrics",
    "rule_lint",
    "table_inventory",
    "full_run",
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session(cpus: str, folder: str) -> SparkSession:
    warehouse = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config(map=STATIC_CONF)
        .config("spark.sql.warehouse.dir", warehouse)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    input_bytes = sum(f.stat().st_size for f in os.scandir(folder))
    for key, value in session_conf(input_bytes, int(cpus)).items():
        spark.conf.set(key, value)
    return spark


def timed(build, spark, folder: str) -> float:
    """Plan and run to the end, every column and row produced, nothing kept."""
    start = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = session(cpus, folder)
    known = registered()
    seconds = {}
    for name in only or HEADLINE:
        timed(known[name], spark, folder)  # warm-up: code generation, file listing
        runs = [timed(known[name], spark, folder) for _ in range(RUNS)]
        seconds[name] = round(statistics.median(runs), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    logging.disable(logging.ERROR)
    main()
