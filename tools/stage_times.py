"""Stage and task times of some registered queries, from Spark's event log.

usage: python tools/stage_times.py SF_DIR query [query ...]
The event log goes to a fresh folder under /tmp (no UI, no server).  For each
query: wall time, number of stages and tasks, and the slowest stage with its
task-time spread (max / median), the first hint of skew.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf, names = sys.argv[1], sys.argv[2:]
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    from cityzones.bench_queries import QUERIES, prepare_landing
    from cityzones.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16,
                          conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    prepare_landing(spark, sf)
    marks = []
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        marks.append((name, time.perf_counter() - t0))
    spark.stop()
    stages, group_of_job, group_of_stage = {}, {}, {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        group_of_stage[sid] = grp
                elif kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    stages.setdefault(ev["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
    for name, wall in marks:
        mine = {s: t for s, t in stages.items() if group_of_stage.get(s) == name}
        ntasks = sum(len(t) for t in mine.values())
        line = f"{name:24s} wall={wall:6.2f}s stages={len(mine):3d} tasks={ntasks:5d}"
        if mine:
            sid, ts = max(mine.items(), key=lambda kv: sum(kv[1]))
            line += (f"  heaviest stage {sid}: {len(ts)} tasks, sum={sum(ts)/1000:.2f}s, "
                     f"max={max(ts)}ms, median={statistics.median(ts):.0f}ms")
        print(line)


if __name__ == "__main__":
    main()
