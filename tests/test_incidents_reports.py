"""Incident workflow and dashboard reports on hand-made check rows."""

from __future__ import annotations

import datetime as dt

from conftest import D, TS

from tidewatch import schemas
from tidewatch.operators import incidents as I
from tidewatch.operators import reports as V

CHECK_COLS = [f for f in schemas.CHECK_RESULTS if f.name != "created_at"]


def checks_df(spark, rows):
    from pyspark.sql import types as T

    schema = T.StructType(CHECK_COLS)
    data = [(D(d), name, "core.fact_events", sev, status, metric, "x", None if status == "PASS" else "bad")
            for d, name, sev, status, metric in rows]
    return spark.createDataFrame(data, schema)


NULL_RULE = "null_rate_session_id_run_date"


def test_incident_per_failing_check_and_idempotent_open(spark):
    checks = checks_df(spark, [
        ("2024-01-01", NULL_RULE, "P1", "FAIL", 5.0),
        ("2024-01-02", NULL_RULE, "P1", "PASS", 0.5),
        ("2024-01-03", NULL_RULE, "P1", "FAIL", 3.0),
        ("2024-01-03", "freshness_has_events_on_run_date", "P0", "PASS", 9.0),
    ])
    inc = I.open_incidents(spark, checks)
    got = sorted(r["incident_id"] for r in inc.collect())
    assert got == ["INC-2024-01-01-NULL-SESSION", "INC-2024-01-03-NULL-SESSION"]
    again = I.new_incidents(I.open_incidents(spark, checks), inc)
    assert again.count() == 0
    row = inc.where("incident_id = 'INC-2024-01-01-NULL-SESSION'").first()
    assert row["root_cause_type"] == "SCHEMA_OR_LOGGING_ISSUE" and row["status"] == "OPEN"
    assert row["detected_by"] == NULL_RULE and row["severity"] == "P1"


def test_resolution_when_check_passes_again(spark):
    checks = checks_df(spark, [
        ("2024-01-01", NULL_RULE, "P1", "FAIL", 5.0),
        ("2024-01-02", NULL_RULE, "P1", "FAIL", 4.0),
        ("2024-01-03", NULL_RULE, "P1", "PASS", 0.5),
        ("2024-01-04", NULL_RULE, "P1", "FAIL", 2.0),
    ])
    inc, log = I.incidents_for_checks(spark, checks)
    state = {r["incident_id"]: r for r in I.current_state(inc, log).collect()}
    assert state["INC-2024-01-01-NULL-SESSION"]["status"] == "RESOLVED"
    assert state["INC-2024-01-01-NULL-SESSION"]["closed_at"] == TS("2024-01-03T00:00:00")
    assert state["INC-2024-01-02-NULL-SESSION"]["status"] == "RESOLVED"
    assert state["INC-2024-01-04-NULL-SESSION"]["status"] == "OPEN"
    assert state["INC-2024-01-04-NULL-SESSION"]["closed_at"] is None


def test_status_log_out_of_order_arrival(spark):
    checks = checks_df(spark, [("2024-01-01", NULL_RULE, "P1", "FAIL", 5.0)])
    inc = I.open_incidents(spark, checks)
    iid = "INC-2024-01-01-NULL-SESSION"
    t = TS("2024-01-01T00:00:00")
    # arrival order: RESOLVED first, then the earlier steps
    changes = spark.createDataFrame([
        (iid, "RESOLVED", t + dt.timedelta(hours=5), "fixed"),
        (iid, "OPEN", t, "opened"),
        (iid, "MITIGATED", t + dt.timedelta(hours=3), "patched"),
        (iid, "TRIAGING", t + dt.timedelta(hours=1), "looking"),
    ], schemas.INCIDENT_STATUS_LOG)
    empty = spark.createDataFrame([], schemas.INCIDENT_STATUS_LOG)
    log = I.append_status(empty, changes)
    r = I.current_state(inc, log).first()
    assert r["status"] == "RESOLVED" and r["closed_at"] == t + dt.timedelta(hours=5)
    partial = log.where("status <> 'RESOLVED'")
    r2 = I.current_state(inc, partial).first()
    assert r2["status"] == "MITIGATED" and r2["closed_at"] is None


def test_checks_with_incidents_matches_day_and_failure_only(spark):
    checks = checks_df(spark, [
        ("2024-01-01", NULL_RULE, "P1", "FAIL", 5.0),
        ("2024-01-02", NULL_RULE, "P1", "PASS", 0.5),
        ("2024-01-02", "freshness_has_events_on_run_date", "P0", "FAIL", 0.0),
    ])
    inc = I.open_incidents(spark, checks.where("check_date = DATE'2024-01-01'"))
    out = {(r["check_date"].isoformat(), r["check_name"]): r for r in V.checks_with_incidents(checks, inc).collect()}
    assert len(out) == 3  # left join keeps every check row
    assert out[("2024-01-01", NULL_RULE)]["incident_id"] == "INC-2024-01-01-NULL-SESSION"
    assert out[("2024-01-02", NULL_RULE)]["incident_id"] is None  # PASS row, other day
    assert out[("2024-01-02", "freshness_has_events_on_run_date")]["incident_id"] is None  # no incident


def test_health_score_floor_and_weights(spark):
    rows = []
    for n_p0 in range(5):
        d = f"2024-01-0{n_p0 + 1}"
        rows += [(d, f"r{i}", "P0", "FAIL", 0.0) for i in range(n_p0)]
        rows += [(d, "ok", "P0", "PASS", 1.0)]
    rows += [("2024-01-06", "a", "P1", "FAIL", 1.0), ("2024-01-06", "b", "P2", "WARN", 1.0)]
    h = {r["check_date"].isoformat(): r for r in V.health_daily(checks_df(spark, rows)).collect()}
    assert [h[f"2024-01-0{i}"]["health_score"] for i in range(1, 6)] == [100, 70, 40, 10, 0]
    assert (h["2024-01-06"]["p1_issues"], h["2024-01-06"]["p2_issues"], h["2024-01-06"]["health_score"]) == (1, 1, 85)
    assert all(0 <= r["health_score"] <= 100 for r in h.values())


def test_pareto_with_equal_counts_and_top_failing(spark):
    incidents = spark.createDataFrame(
        [(f"INC-{i}", None, None, "P0", "OPEN", "s", "c", "a", rc, None, None, None, "o")
         for i, rc in enumerate(["B", "A", "A", "B", "C"])], schemas.INCIDENTS)
    p = V.root_cause_pareto(incidents).orderBy("pareto_rank").collect()
    assert [(r["root_cause_type"], r["incident_count"]) for r in p] == [("A", 2), ("B", 2), ("C", 1)]
    assert [r["cumulative_pct"] for r in p] == [40.0, 80.0, 100.0]
    checks = checks_df(spark, [
        ("2024-01-01", "x", "P0", "FAIL", 0.0), ("2024-01-02", "x", "P0", "WARN", 0.0),
        ("2024-01-01", "y", "P0", "FAIL", 0.0), ("2024-01-01", "z", "P0", "PASS", 0.0)])
    top = V.top_failing_checks(checks, 1).collect()
    assert [(r["check_name"], r["failwarn_days"], r["failwarn_rows"]) for r in top] == [("x", 2, 2)]


def test_incident_queue_order(spark):
    rows = [("INC-a", TS("2024-01-01T00:00:00"), "P1", "OPEN"), ("INC-b", TS("2024-01-02T00:00:00"), "P0", "OPEN"),
            ("INC-c", TS("2024-01-03T00:00:00"), "P0", "OPEN"), ("INC-d", TS("2024-01-04T00:00:00"), "P0", "RESOLVED")]
    incidents = spark.createDataFrame(
        [(i, t, None, s, st, "s", "c", "a", "R", None, None, None, "o") for i, t, s, st in rows], schemas.INCIDENTS)
    q = [r["incident_id"] for r in I.incident_queue(incidents).collect()]
    assert q == ["INC-c", "INC-b", "INC-a"]
