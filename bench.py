"""Time the headline queries: one warm-up each, then the median of three runs, as one JSON line.

The boosted model, whose 400 iterations take minutes, runs once and without a warm-up; its entry says so.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from remitlens.session import local_session  # noqa: E402
from remitlens.verification.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "clean_report",
    "forward_fill",
    "benchmark_variance",
    "weekly_granular",
    "weekly_granular_diag",
    "weekly_aggregated",
    "diagnostics_base",
    "drivers_key",
    "underpayment_summary",
    "cpt_rate_drivers",
    "gap_by_payer",
    "historical_benchmark",
    "narratives",
    "recompute_compare",
    "sample_validation",
    "ml_elasticnet",
    "ml_linear",
]
ONCE = ["ml_boosted"]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    seconds = {}
    for name in HEADLINE:
        run(spark, name, folder)
        seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(RUNS)), 3)
    single = {name: round(run(spark, name, folder), 3) for name in ONCE}
    result = {
        "metric": "headline queries, total of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "single_runs": single,
        "sf": folder.rstrip("/").rsplit("/sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
