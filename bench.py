"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roundscope.plans.queries import QUERIES  # noqa: E402
from roundscope.session import local_session  # noqa: E402

HEADLINE = [
    "opening_win", "opening_win_by_map", "branch_duration", "branch_duration_by_map", "trade_curve", "underdog_conversion",
    "opening_timing", "flag_test", "side_rate_by_map", "asof_rounds", "merge_ignore", "dedup_first", "trajectories",
    "snapshot_first_value", "ingest_shots", "spearman",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    spark = local_session(cpus)
    seconds: dict[str, float] = {}
    # The first pass warms the JVM and the Python workers, the second one counts.
    for _ in range(2):
        for name in HEADLINE:
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
