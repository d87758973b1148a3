"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through Spark's ``noop`` sink (the whole plan
executes, nothing is collected); driver-side planning actions inside a
query (grid planning, as-of bounds) are part of its time.  Before timing, the
JVM is warmed up (untimed) with one scan and, when the sf0.001 tables exist,
one run of the flagship query on them.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "match_drivers",          # Q1: exact top-k matching
    "multi_view_join",        # J2: point-in-time join, two TTLs
    "training_set",           # Q2
    "drift_score",            # A14 over match observations
    "materialize",            # A2
    "materialize_features",   # Q4: materialize → upsert online → lookup → coverage
    "decode_events",          # Q5 batch ingest: decode + route
    "online_lookup",          # J4
    "latency_p95_daily",      # A12 + A18
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from fleetcast.plans.catalog import QUERIES
    from fleetcast.session import build_session

    spark = build_session(f"local[{cpus}]", max(cpus, 8), app_name="fleetcast-bench",
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()  # warm-up
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.exists(f"{warm_dir}/events.parquet"):
        QUERIES["match_drivers"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times, rows = {}, {}
    for name in HEADLINE:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
