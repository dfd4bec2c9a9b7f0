"""Benchmark: warm median time of the headline queries, one JSON line on stdout.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs per query),
BENCH_QUERIES (comma-separated names, or "all" for every registered query).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "hot_items_topn",
    "sql_hop_topn",
    "slide_count",
    "tumble_event",
    "session_count",
    "early_fire_counts",
    "uv_exact",
    "uv_approx",
    "top1_per_window",
    "word_count",
    "running_word_count",
    "running_pv_user",
    "running_sum_all",
    "changelog_counts",
    "watermark_trace",
    "window_late_side_output",
    "allowed_lateness",
    "join_inner",
    "join_interval",
    "join_window",
    "asof_query_filter",
    "switch_gate",
    "reconcile_full_outer",
    "fsm_three_fails",
    "cep_next_next",
    "cep_within_timeout",
    "order_timeout",
    "rising_alert",
    "stream_tumble_event",
    "stream_hot_items_topn",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cores, "tidemark-bench", **{"spark.sql.shuffle.partitions": cores.replace("*", "8")})
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(1 + (1 if name.startswith("stream_") else runs)):
            begun = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begun)
        times[name] = round(statistics.median(taken[1:]), 4)
        print(f"{name:26} {times[name]:8.3f}", file=sys.stderr, flush=True)
    spark.stop()
    found = re.search(r"sf([0-9.]+)", folder)
    result = {"metric": "total_warm_median_seconds", "value": round(sum(times.values()), 4), "unit": "sec"}
    result |= {"queries": times, "sf": float(found.group(1)) if found else None, "cpus": cores}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
