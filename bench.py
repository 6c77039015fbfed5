"""Times the headline queries: ``BENCH_SF_DIR=... BENCH_CPUS=8 python bench.py`` prints one JSON line.

Each query runs once to warm up and three times for the median (once if it is slow); results go to Spark's no-op sink, so every
row and column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Seconds of a first run after which one timed run has to do.
SLOW = 15

HEADLINE = [
    "demand_profile",
    "zone_ranking",
    "operator_zones",
    "recommendations",
    "feature_table",
    "clean_demand",
    "dq_issues",
    "accuracy_segments",
    "feature_drift",
    "describe_prices",
    "doc_search",
    "rate_limit",
    "guardrail_replay",
    "cache_impact",
    "hash_embed",
    "semantic_match",
    "monitor_metrics",
    "alerts",
    "cache_hybrid",
    "forecast_recursive",
    "stream_rate_limit",
]


def main() -> None:
    from opspark import get_session
    from opspark.plans import catalog

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "opspark-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    for name in names:
        times, wanted = [], runs
        while len(times) <= wanted:
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
            if times[0] > SLOW:
                wanted = 1
        times = times[1:]
        took[name] = round(statistics.median(times), 3)
        print(f"{name}: {took[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
