"""The batch job entry point end to end on raw CSV."""

from __future__ import annotations

import os

from conftest import SF_SMALL

from tidewatch.plans import job
from tidewatch.session import scratch_path
from tidewatch.sources import test_tables as TT
from tidewatch.sources.raw_csv import write_raw_csv


def test_job_from_raw_csv_run_all_and_export(spark):
    raw_dir = scratch_path(spark, "job-raw")
    write_raw_csv(TT.raw_events_from_dir(spark, SF_SMALL), raw_dir)
    db = f"tw_job_{os.urandom(3).hex()}"
    out = job.main(["--database", db, "--raw-csv", raw_dir, "--run-all", "--export",
                    "--volume-min-rows", "30"])
    n_events = TT.read_table(spark, SF_SMALL, "events").count()
    assert spark.table(f"{db}.fact_events").count() == n_events
    days = spark.table(f"{db}.fact_events").select("event_date").distinct().count()
    assert spark.table(f"{db}.dq_check_results").count() == 4 * days
    assert spark.table(f"{db}.dq_anomalies").count() == 3 * days
    health = spark.read.option("header", True).csv(out["health_daily"])
    assert health.count() == days
    # a second single-day run of an existing day leaves the counts unchanged
    job.main(["--database", db, "--run-date", "2024-01-10", "--volume-min-rows", "30"])
    assert spark.table(f"{db}.dq_check_results").count() == 4 * days
