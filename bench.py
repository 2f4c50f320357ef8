"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores,
``BENCH_RUNS`` the timed runs per query after one warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from driver_queries import QUERIES  # noqa: E402

HEADLINE = (
    "scan_table", "project_columns", "cast_decimal", "cast_wide_decimal", "utf8_lossy",
    "part_range", "part_composite", "join_reference_partition", "count_rows",
    "convert_lineitem", "convert_table", "convert_plan", "sink_parquet", "sink_csv",
    "count_output_parquet", "count_output_csv", "inspect_catalog",
    "plan_chunks", "ledger_latest", "filter_pending_chunks", "join_plan_results",
    "log_missing_tablespaces", "log_show_tables", "scan_ddl_tables", "materialize_view",
)


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name:28} {seconds[name]:8.3f}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
