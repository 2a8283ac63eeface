"""Benchmark the headline jobs on one scale factor.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default HEADLINE), BENCH_REPEAT (default 2, best of).
Landing files (rent snapshots, income JSON, incident CSV, lookups) are derived
from the test tables once, untimed; then each query is executed completely
through the ``noop`` sink (no collect), after one untimed warm-up query.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "avg_indicators", "listing_indicators", "population", "format_income", "format_rent",
    "format_incidents", "neighborhood_dim", "ml_dataset", "reconcile_names",
    "incident_lookup_build", "stream_format_rent", "ml_train",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))

    from cityzones.bench_queries import QUERIES, prepare_landing
    from cityzones.session import build_session

    spark = build_session(f"local[{cpus}]", app="cityzones-bench", shuffle_partitions=2 * cpus,
                          conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    prepare_landing(spark, sf_dir)  # landing files derived from the test tables, untimed
    run("population")  # warm-up: JIT, file listing caches
    timings, errors = {}, {}
    for name in names:
        try:
            timings[name] = round(min(run(name) for _ in range(repeat)), 3)
        except Exception as e:  # noqa: BLE001 - report and keep measuring the others
            timings[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(t for t in timings.values() if t is not None), 3), "unit": "sec",
        "queries": timings, "sf": sf, "cpus": cpus, "spark": spark.version,
        "shuffle_partitions": 2 * cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
