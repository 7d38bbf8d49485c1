"""Headline queries on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``; prints one JSON line.

Each query is fully materialised (Spark's no-op sink) and the best of two runs is kept,
after one warm-up query that starts the JVM and the Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time

from cliploom.plans import CATALOGUE
from cliploom.session import build_session

HEADLINE = (
    "dispatch_wave", "assign_pairings", "retry_checks", "verify_files", "hash_drift", "catalog_contract", "source_refs", "build_records",
    "robust_stats", "distribution", "pick_diverse", "pick_cold", "repair_blueprints", "smooth_binomial", "trajectory_measures",
    "best_window", "clamp_steps", "contact_runs", "image_stats", "camera_motion", "proximity_frames", "tree_depth",
    "task_gate_prepass", "garment_gate", "stream_status", "stream_stale", "assign_rounds",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cores=cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    CATALOGUE["queue_status"].run(spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        best = None
        for _ in range(2):
            begin = time.perf_counter()
            CATALOGUE[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - begin
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
