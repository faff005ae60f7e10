"""Property tests: rules and anomaly scoring against brute-force Python on random series."""

from __future__ import annotations

import datetime as dt
import math
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewatch.operators import anomalies as A
from tidewatch.operators import rules as R

D0 = dt.date(2024, 1, 1)

# A day series: present/absent flag, events, purchases, null sessions.
day = st.tuples(st.booleans(), st.integers(0, 1500), st.integers(0, 5), st.integers(0, 30))
series = st.lists(day, min_size=1, max_size=24)


def _stats_rows(days):
    rows = []
    for i, (present, n, p, nulls) in enumerate(days):
        if present and n > 0:
            rows.append((D0 + dt.timedelta(days=i), n, min(p, n), min(nulls, n)))
    return rows


def _expected_checks(rows):
    by_day = {d: (n, p, k) for d, n, p, k in rows}
    out = {}
    for d, (n, p, k) in by_day.items():
        prev = by_day.get(d - dt.timedelta(days=1), (0, 0, 0))
        out[(d, "freshness_has_events_on_run_date")] = ("PASS" if n > 0 else "FAIL", float(n))
        out[(d, "volume_prev_day_events_min_1000")] = ("PASS" if prev[0] >= 1000 else "FAIL", float(prev[0]))
        out[(d, "purchase_events_vanish_prev_day")] = ("PASS" if prev[1] > 0 else "FAIL", float(prev[1]))
        pct = 100.0 * k / n
        out[(d, "null_rate_session_id_run_date")] = ("PASS" if pct <= 1.0 else "FAIL", pct)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=series)
def test_rules_match_brute_force(spark, days):
    rows = _stats_rows(days)
    if not rows:
        return
    stats = spark.createDataFrame(rows, "event_date date, n_events long, n_purchases long, n_null_session long")
    got = {(r["check_date"], r["check_name"]): (r["status"], r["metric_value"])
           for r in R.evaluate_rules(stats, R.default_rules()).collect()}
    want = _expected_checks(rows)
    assert got.keys() == want.keys()
    for k, (status, metric) in want.items():
        assert got[k][0] == status and math.isclose(got[k][1], metric, rel_tol=1e-12, abs_tol=1e-12)


def _expected_scores(values, rows=14):
    """Brute force of the baseline/z/pct/flag rules for one events_count series."""
    out = []
    for i, v in enumerate(values):
        window = [x for x in values[max(0, i - rows):i]]
        base = sum(window) / len(window) if window else None
        sd = statistics.stdev(window) if len(window) > 1 else None
        prev = values[i - 1] if i > 0 else None
        z = (v - base) / sd if sd not in (None, 0) else None
        pct = (v - prev) / prev if prev not in (None, 0) else None
        if base is None:
            flag = "N"
        elif z is not None and abs(z) > 3:
            flag = "Y"
        elif pct is not None and (pct > 0.6 or pct < -0.6):
            flag = "Y"
        else:
            flag = "N"
        out.append((base, z, pct, flag))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.integers(0, 60).map(float), min_size=1, max_size=30))
def test_anomaly_scoring_matches_brute_force(spark, values):
    rows = [(D0 + dt.timedelta(days=2 * i), "overall", None, "events_count", v) for i, v in enumerate(values)]
    long = spark.createDataFrame(
        rows, "anomaly_date date, entity_type string, entity_id string, metric_name string, actual_value double")
    got = [(r["baseline_value"], r["z_score"], r["pct_change"], r["anomaly_flag"])
           for r in A.score(long).orderBy("anomaly_date").collect()]
    want = _expected_scores(values)

    def close(a, b):
        if a is None or b is None:
            return a is None and b is None
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)

    def on_limit(w):
        return ((w[1] is not None and abs(abs(w[1]) - 3) < 1e-9)
                or (w[2] is not None and abs(abs(w[2]) - 0.6) < 1e-9))

    for g, w in zip(got, want, strict=True):
        assert close(g[0], w[0]) and close(g[2], w[2])
        assert g[3] == w[3] or on_limit(w)
        # z near the +-3 limit may differ in the last bits; compare loosely
        assert close(g[1], w[1]) or (g[1] is not None and w[1] is not None and abs(g[1] - w[1]) < 1e-6)
