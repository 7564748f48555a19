"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then three times to a sink that discards rows; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from sentrylake import build_session
from sentrylake.plans.catalog import QUERIES

HEADLINE = [
    "all_user_features",
    "user_features",
    "sequence_features",
    "ip_frequency",
    "event_interval",
    "baseline_anomaly_detector",
    "frozen_baseline_detector",
    "learning_phase_split",
    "parse_event_json",
    "event_summary",
    "stats_summary",
    "event_context",
    "lambda_view_all",
    "latest_events",
    "events_above_threat",
    "high_score_anomalies",
    "histogram_quantile",
    "rate",
    "sliding_features",
    "similar_events",
    "match_threat_intel",
    "isolation_forest",
    "kmeans_anomaly",
    "training_pipeline",
    "baseline_stream",
    "event_pipeline_stream",
    "read_events_batch",
]
REPEATS = 3


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(REPEATS)), 3)
    result = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
