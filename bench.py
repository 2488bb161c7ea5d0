"""Times the queries of the catalogue and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs whole, with its
result written to the no-op sink; the best of ``BENCH_RUNS`` timings after one warm-up counts.
"""

from __future__ import annotations

import json
import os
import time

from cohortmill import catalog
from cohortmill.session import build_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(cores, int(cores) if cores.isdigit() else 8)
    seconds: dict[str, float] = {}
    for name, query in catalog.QUERIES.items():
        best = float("inf")
        for attempt in range(runs + 1):
            start = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            if attempt or not runs:
                best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
