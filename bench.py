"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The derived tables are written once first; that time, session start included, is
reported as ``setup_sec`` and not part of the value. Every query then runs three times over the whole tables into a sink that discards the
rows; the first run warms up and the median of the other two counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from fixtures import derived
from fixtures.queries import queries

HEADLINE = (
    "seed_plain",
    "seed_rate_trend",
    "baseline_band",
    "baseline_sigma",
    "score_plain",
    "score_all",
    "completeness_score",
    "detail_anomaly",
    "detail_completeness",
    "replay_plain",
    "replay_rate_trend",
    "replace_slice",
    "retention_history",
    "score_all_look_back",
    "completeness_look_back",
    "seed_look_back",
)
WARM_RUNS = 2


def main() -> None:
    started = time.perf_counter()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("kpiwarden-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kpiwarden-bench-"))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    derived.observations(spark, sf_dir)
    derived.requests(spark, sf_dir)
    derived.kpi_list(spark, sf_dir)
    setup = round(time.perf_counter() - started, 3)
    chosen = queries()
    for name in HEADLINE:
        runs = []
        for _ in range(1 + WARM_RUNS):
            started = time.perf_counter()
            chosen[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        times[name] = round(statistics.median(runs[1:]), 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "setup_sec": setup,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
