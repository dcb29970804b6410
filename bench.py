"""Times every registered query over whole tables and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query is written to a sink that discards its
rows, so that all columns of all rows are computed and nothing passes through the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from inkfold import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def seconds(spark, query) -> float:
    """The faster of the runs; building the plan, with the jobs that check sizes, is part of it."""
    best = float("inf")
    for _ in range(RUNS):
        start = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return best


def main():
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        {"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or list(QUERIES)
    times = {name: round(seconds(spark, QUERIES[name]), 3) for name in wanted}
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
