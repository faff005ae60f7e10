"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up, then ``BENCH_REPS`` (5) times; the median wall
time is reported.  Results are fully computed (``noop`` sink) but not
collected, so driver transfer is not measured.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "dq_checks_all_days",
    "anomalies_all_days",
    "check_dup_composite_key",
    "clean_events",
    "anomalies_by_entity",
    "checks_with_incidents",
    "health_daily",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    from tidewatch.plans.queries import REGISTRY
    from tidewatch.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(2, cpus))
    times: dict[str, float] = {}
    for name in HEADLINE:
        run = REGISTRY[name]
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        samples = []
        for _ in range(reps):
            t0 = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
    # Speed of the machine at measurement time: a trivial full scan of the
    # events file (its drift explains run-to-run differences of the totals).
    probe = []
    for _ in range(5):
        t0 = time.perf_counter()
        spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
        probe.append(time.perf_counter() - t0)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "env_probe_scan_sec": round(statistics.median(probe), 4),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
