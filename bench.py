"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the scale folder, BENCH_CPUS the number of local cores. A query is
run to the end without collecting its rows, once to warm up and then twice; the faster
run counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tidelog.workload.queries import QUERIES

HEADLINE = [
    "valid_events",
    "data_quality",
    "requests_per_endpoint",
    "error_rates",
    "baseline_rpm",
    "endpoint_historical_summary",
    "write_batch_results",
    "validate_event",
    "decode_envelope",
    "recent_window",
    "dedup_events",
    "global_window",
    "traffic_comparison",
    "combined_view",
    "batch_stream_parity",
    "stream_latency",
    "stream_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidelog-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    taken = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        taken[name] = round(min(runs[1:]), 3)
    spark.stop()
    total = round(sum(taken.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": total,
                "unit": "sec",
                "queries": taken,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
