"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from shillingflow.catalog import CATALOG
from shillingflow.session import build_session

HEADLINE = [
    "bench_select", "bench_complex", "bench_complex_all_days", "mart_hourly_volumes", "mart_daily_transactions",
    "mart_county_heatmap", "txn_sequence", "risk_review_list", "cust_median_value", "raw_insert_ignore",
    "zscore_anomaly", "velocity_batch", "sliding_15min_windows", "fraud_features", "stream_hourly",
]
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def run(spark, key: str, folder: str) -> float:
    start = time.perf_counter()
    CATALOG[key].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for key in sys.argv[1:] or HEADLINE:
        run(spark, key, folder)  # warm-up
        times[key] = round(statistics.median(run(spark, key, folder) for _ in range(REPEATS)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
