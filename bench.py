"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   directory of the test tables (/root/testdata/sf0.1)
BENCH_CPUS     threads of the local session (8)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from tickline.plans import whole  # noqa: F401  registers more queries
from tickline.plans.queries import QUERIES
from tickline.session import drop_shared

HEADLINE = [
    "dedup_latest", "price_change_flag", "clean_snapshots", "parse_ticks", "valid_ticks",
    "latest_snapshot", "price_performance", "rolling_every_tick", "rank_of_every_tick",
    "daily_trends", "daily_trends_lineitem", "daily_trends_orders",
    "duplicate_keys", "price_jumps", "silver_checks", "gold_checks", "cross_table_sync",
    "snapshot_report", "performance_recent_24h", "daily_report", "latest_rows",
    "upsert", "stream_bronze", "stream_silver", "stream_performance",
    "flag_every_tick", "jumps_every_tick", "performance_every_tick", "silver_faults_every_tick",
    "gold_faults_every_tick", "snapshot_scan", "batch_run", "batch_increment", "stream_rolling",
]


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tickline-bench")
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    drop_shared(spark)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
                      "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
