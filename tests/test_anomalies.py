"""Anomaly scoring: edge rules of the 14-row baseline and a golden replay."""

from __future__ import annotations

import csv
import os

import pytest
from conftest import D
from pyspark.sql import functions as F

from tidewatch.operators import anomalies as A
from tidewatch.operators import reports as V
from tidewatch.operators import rules as R

HERE = os.path.dirname(os.path.abspath(__file__))


def series(spark, values, metric="events_count", start="2024-01-01", skip=()):
    """A one-metric long series, one row per day (days in ``skip`` left out)."""
    import datetime as dt

    d0 = D(start)
    rows = [(d0 + dt.timedelta(days=i), "overall", None, metric, float(v) if v is not None else None)
            for i, v in enumerate(values) if i not in skip]
    return spark.createDataFrame(
        rows, "anomaly_date date, entity_type string, entity_id string, metric_name string, actual_value double")


def scored(spark, values, **kw):
    return [r.asDict() for r in A.score(series(spark, values, **kw)).orderBy("anomaly_date").collect()]


def test_first_second_and_constant_days(spark):
    rows = scored(spark, [100, 100, 100, 100])
    assert rows[0]["baseline_value"] is None and rows[0]["anomaly_flag"] == "N"
    assert rows[0]["pct_change"] is None
    assert rows[1]["baseline_value"] == 100.0 and rows[1]["z_score"] is None  # one value: sd NULL
    assert rows[2]["z_score"] is None  # constant: sd 0 -> z NULL
    assert rows[3]["pct_change"] == 0.0 and rows[3]["anomaly_flag"] == "N"


def test_previous_zero_gives_null_change(spark):
    rows = scored(spark, [0, 0, 5])
    assert rows[2]["pct_change"] is None and rows[2]["z_score"] is None
    assert rows[2]["anomaly_flag"] == "N"


@pytest.mark.parametrize("metric,prev,now,flag", [
    ("events_count", 100, 160, "N"), ("events_count", 100, 161, "Y"),
    ("events_count", 100, 40, "N"), ("events_count", 100, 39, "Y"),
    ("revenue", 100, 160, "N"), ("revenue", 100, 161, "Y"),
    ("revenue", 100, 60, "N"), ("revenue", 100, 59, "Y"),
    ("cvr", 0.5, 0.75, "N"), ("cvr", 0.5, 0.76, "Y"),
    ("cvr", 0.5, 0.25, "N"), ("cvr", 0.5, 0.24, "Y"),
])
def test_day_change_limits_are_strict(spark, metric, prev, now, flag):
    rows = scored(spark, [prev, prev, now], metric=metric)
    assert rows[2]["anomaly_flag"] == flag
    assert rows[2]["notes"] == A.THRESHOLDS[metric][3]


def test_z_just_over_three(spark):
    # baseline [10, 12] -> mean 11, sd sqrt(2); value 11 + 3.01*sqrt(2) flags via z only
    import math

    v = 11 + 3.01 * math.sqrt(2)
    rows = scored(spark, [10, 12, v])
    assert rows[2]["z_score"] == pytest.approx(3.01)
    assert abs(rows[2]["pct_change"]) < 0.6 and rows[2]["anomaly_flag"] == "Y"


def test_frame_keeps_fourteen_rows_and_skips_gaps_as_rows(spark):
    vals = [1000.0] + [10.0] * 15
    rows = scored(spark, vals)
    assert rows[14]["baseline_value"] == pytest.approx((1000 + 13 * 10) / 14)
    assert rows[15]["baseline_value"] == 10.0  # day 1 left the frame
    gap = scored(spark, [10, 20, 30, 40], skip=(2,))
    # the row before day 4 is day 2 (day 3 missing): change 40 vs 20
    assert gap[-1]["pct_change"] == 1.0


def test_every_metric_row_emitted_with_flag(spark):
    from conftest import day_events, fact_rows

    ev = day_events("2024-01-01", 10, purchases=2) + day_events("2024-01-02", 20, purchases=1)
    out = A.anomalies_all_days(fact_rows(spark, ev)).collect()
    assert len(out) == 6 and {r["anomaly_flag"] for r in out} <= {"Y", "N"}
    assert {r["entity_type"] for r in out} == {"overall"} and all(r["entity_id"] is None for r in out)
    rev = [r for r in out if r["metric_name"] == "revenue" and r["anomaly_date"] == D("2024-01-01")][0]
    assert rev["actual_value"] == 20.0


def test_rolling_median(spark):
    m = A.rolling_median(series(spark, [1, 9, 2, 8])).orderBy("anomaly_date").collect()
    assert m[0]["baseline_median"] is None and m[2]["baseline_median"] == 5.0
    assert m[3]["baseline_median"] == 2.0


def _golden_kpis(spark):
    rows = []
    with open(os.path.join(HERE, "fixtures", "golden_daily_counts.csv")) as fh:
        for r in csv.DictReader(fh):
            rows.append((D(r["d"]), float(r["events"]), float(r["purchases"])))
    df = spark.createDataFrame(rows, "d date, events_count double, purchases double")
    return df.withColumn("revenue", F.lit(None).cast("double")).withColumn(
        "cvr", F.col("purchases") / F.col("events_count"))


# The reference's tracked anomaly rows for events_count and cvr.
GOLDEN = {
    ("2019-11-15", "events_count"): (6220416.0, 1883673.642857143, 11.244229512542784, 1.0263749924260341, "Y"),
    ("2019-11-15", "cvr"): (0.0, 0.012975973636063424, -5.954709201755367, -1.0, "Y"),
    ("2019-11-30", "events_count"): (1754878.0, 2368232.4285714286, -0.35385650279583347, -0.05368130084457401, "N"),
    ("2019-11-30", "cvr"): (0.016056956665933472, 0.015642966481615294, 0.10122608844421323, -0.07258735097703473, "N"),
}


def test_golden_replay_of_anomalies(spark):
    long = A.kpis_long(_golden_kpis(spark), metrics=("events_count", "cvr"))
    got = {(r["anomaly_date"].isoformat(), r["metric_name"]): r for r in A.score(long).collect()}
    for key, (actual, base, z, pct, flag) in GOLDEN.items():
        r = got[key]
        assert r["actual_value"] == pytest.approx(actual, rel=1e-9)
        assert r["baseline_value"] == pytest.approx(base, rel=1e-9)
        assert r["z_score"] == pytest.approx(z, rel=1e-9)
        assert r["pct_change"] == pytest.approx(pct, rel=1e-9)
        assert r["anomaly_flag"] == flag


def test_golden_replay_of_checks_and_health(spark):
    kpis = _golden_kpis(spark)
    stats = kpis.select(F.col("d").alias("event_date"), F.col("events_count").cast("long").alias("n_events"),
                        F.col("purchases").cast("long").alias("n_purchases"),
                        F.lit(0).cast("long").alias("n_null_session"))
    checks = R.evaluate_rules(stats, R.default_rules())
    failing = sorted((r["check_date"].isoformat(), r["check_name"])
                     for r in checks.where("status <> 'PASS'").collect())
    assert failing == [("2019-11-01", "purchase_events_vanish_prev_day"),
                       ("2019-11-01", "volume_prev_day_events_min_1000"),
                       ("2019-11-16", "purchase_events_vanish_prev_day")]
    health = {r["check_date"].isoformat(): r for r in V.health_daily(checks).collect()}
    assert len(health) == 30 and all(h["total_checks"] == 4 for h in health.values())
    assert health["2019-11-01"]["health_score"] == 40
    assert health["2019-11-16"]["health_score"] == 70
    assert {h["health_score"] for d, h in health.items() if d not in ("2019-11-01", "2019-11-16")} == {100}


def test_bounded_run_date_scoring_equals_full_history(spark):
    import datetime as dt

    from conftest import day_events, fact_rows

    ev = []
    d0 = D("2024-01-01")
    for i in range(60):
        if i % 7 == 3:  # gaps: the 14 rows before a day span more than 14 calendar days
            continue
        ev += day_events((d0 + dt.timedelta(days=i)).isoformat(), 5 + (i * 7) % 11, purchases=1 + i % 3)
    fact = fact_rows(spark, ev)
    for run, n in (("2024-02-25", 3), ("2024-01-10", 3), ("2024-01-03", 3), ("2024-01-04", 0)):
        full = A.anomalies_for_run_date(fact, run, bounded=False).collect()
        part = A.anomalies_for_run_date(fact, run).collect()
        assert sorted(map(tuple, full)) == sorted(map(tuple, part)) and len(full) == n
    # 2024-01-04 has no events: no anomaly rows (grouped), as in a daily run
    assert A.lookback_start(fact, "2024-02-25", 15, first_window_days=10) is not None
    assert A.lookback_start(fact, "2024-01-03", 15) is None  # history shorter than the frame
