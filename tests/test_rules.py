"""Data-quality rules on hand-made days (edge cases of each rule)."""

from __future__ import annotations

from conftest import D, TS, day_events, fact_rows

from tidewatch.operators import rules as R


def by_rule(rows):
    return {(r["check_date"].isoformat(), r["check_name"]): r for r in rows}


def test_every_day_and_rule_once_and_calendar_previous_day(spark):
    # 2024-01-01: 1000 rows, 2 purchases; 01-02 missing; 01-03: 999 rows, 0 purchases.
    ev = day_events("2024-01-01", 1000, purchases=2) + day_events("2024-01-03", 999)
    fact = fact_rows(spark, ev)
    out = R.checks_all_days(fact, R.default_rules()).collect()
    assert len(out) == 2 * 4
    got = by_rule(out)
    assert len(got) == 8
    # 01-03: the day before (01-02) has no rows -> volume 0 FAIL, purchases 0 FAIL;
    # the row before the gap (01-01) must NOT be used.
    v = got[("2024-01-03", "volume_prev_day_events_min_1000")]
    assert (v["status"], v["metric_value"]) == ("FAIL", 0.0)
    assert v["failure_details"] == "Previous day events below 1000"
    p = got[("2024-01-03", "purchase_events_vanish_prev_day")]
    assert (p["status"], p["metric_value"]) == ("FAIL", 0.0)
    f = got[("2024-01-03", "freshness_has_events_on_run_date")]
    assert (f["status"], f["metric_value"], f["failure_details"]) == ("PASS", 999.0, None)


def test_volume_boundary_999_1000(spark):
    ev = day_events("2024-01-01", 999) + day_events("2024-01-02", 5) + \
        day_events("2024-01-03", 1000) + day_events("2024-01-04", 5)
    got = by_rule(R.checks_all_days(fact_rows(spark, ev), [R.volume_prev_day()]).collect())
    assert got[("2024-01-02", "volume_prev_day_events_min_1000")]["status"] == "FAIL"
    assert got[("2024-01-04", "volume_prev_day_events_min_1000")]["status"] == "PASS"


def test_null_rate_exactly_one_percent_passes(spark):
    ev = day_events("2024-01-01", 200, null_sessions=2) + day_events("2024-01-02", 200, null_sessions=3)
    got = by_rule(R.checks_all_days(fact_rows(spark, ev), [R.null_rate_session()]).collect())
    a = got[("2024-01-01", "null_rate_session_id_run_date")]
    b = got[("2024-01-02", "null_rate_session_id_run_date")]
    assert (a["status"], a["metric_value"]) == ("PASS", 1.0)
    assert (b["status"], b["metric_value"]) == ("FAIL", 1.5)
    assert b["expected_range"] == "<= 1%"


def test_run_date_without_events_still_yields_every_rule(spark):
    ev = day_events("2024-01-01", 10, purchases=1)
    out = R.checks_for_run_date(spark, fact_rows(spark, ev), "2024-01-05").collect()
    got = by_rule(out)
    assert len(out) == 4
    assert got[("2024-01-05", "freshness_has_events_on_run_date")]["status"] == "FAIL"
    n = got[("2024-01-05", "null_rate_session_id_run_date")]
    assert n["metric_value"] is None and n["status"] == "FAIL"  # NULL metric fails


def test_run_date_reads_previous_calendar_day(spark):
    ev = day_events("2024-01-01", 1200, purchases=3) + day_events("2024-01-02", 10)
    got = by_rule(R.checks_for_run_date(spark, fact_rows(spark, ev), "2024-01-02").collect())
    assert got[("2024-01-02", "volume_prev_day_events_min_1000")]["metric_value"] == 1200.0
    assert got[("2024-01-02", "purchase_events_vanish_prev_day")]["metric_value"] == 3.0


def test_dup_groups_of_two_and_three_count_two(spark):
    t = TS("2024-01-01T10:00:00")
    base = {"user_id": "u", "session_id": "s", "event_type": "view", "product_id": "p", "event_ts": t}
    ev = [dict(base), dict(base),  # group of 2
          dict(base, user_id="v"), dict(base, user_id="v"), dict(base, user_id="v"),  # group of 3
          dict(base, user_id="w"),  # single
          dict(base, user_id=None, session_id=None), dict(base, user_id=None, session_id=None)]
    ev[-1]["event_ts"] = TS("2024-01-01T10:00:01")  # NULL keys, different time: no dup
    got = by_rule(R.checks_all_days(fact_rows(spark, ev), [R.dup_composite_key()]).collect())
    r = got[("2024-01-01", "dup_composite_key_groups_run_date")]
    assert (r["status"], r["metric_value"]) == ("FAIL", 2.0)


def test_null_key_parts_group_together(spark):
    t = TS("2024-01-01T10:00:00")
    ev = [{"user_id": None, "session_id": None, "event_type": "view", "product_id": "p", "event_ts": t}] * 2
    got = by_rule(R.checks_all_days(fact_rows(spark, ev), [R.dup_composite_key()]).collect())
    assert got[("2024-01-01", "dup_composite_key_groups_run_date")]["metric_value"] == 1.0


def test_purchase_rules_zero_purchases(spark):
    ev = day_events("2024-01-01", 5) + day_events("2024-01-02", 5, purchases=1)
    rules = [R.purchases_run_date(), R.purchases_prev_day()]
    got = by_rule(R.checks_all_days(fact_rows(spark, ev), rules).collect())
    assert got[("2024-01-01", "purchase_events_on_run_date")]["status"] == "FAIL"
    assert got[("2024-01-02", "purchase_events_on_run_date")]["status"] == "PASS"
    assert got[("2024-01-02", "purchase_events_vanish_prev_day")]["status"] == "FAIL"


def test_freshness_rules_on_late_day_and_gap(spark):
    # 01-01 ends 22:00 (2h before midnight); 01-02 missing; 01-03 ends 23:30.
    ev = day_events("2024-01-01", 1, hour=22) + day_events("2024-01-03", 1, hour=23)
    ev[-1]["event_ts"] = TS("2024-01-03T23:30:00")
    rules = [R.latest_event_in_day(1.0), R.latest_event_24h(24.0)]
    got = by_rule(R.checks_for_days(spark, fact_rows(spark, ev), "2024-01-01", "2024-01-03", rules).collect())
    assert got[("2024-01-01", "freshness_latest_event_within_run_day")]["metric_value"] == 2.0
    assert got[("2024-01-01", "freshness_latest_event_within_run_day")]["status"] == "FAIL"
    assert got[("2024-01-03", "freshness_latest_event_within_run_day")]["status"] == "PASS"
    # 01-02 has no events: newest event so far is 01-01 22:00 -> 26h before 01-02 ends.
    stale = got[("2024-01-02", "freshness_latest_event_within_24h")]
    assert (stale["metric_value"], stale["status"]) == (26.0, "FAIL")
    assert got[("2024-01-02", "freshness_latest_event_within_run_day")]["status"] == "FAIL"


def test_shuffled_input_gives_same_results(spark):
    ev = day_events("2024-01-01", 30, purchases=2, null_sessions=1) + day_events("2024-01-02", 40)
    a = R.checks_all_days(fact_rows(spark, ev)).collect()
    b = R.checks_all_days(fact_rows(spark, list(reversed(ev))).repartition(5)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_check_dates_are_dates(spark):
    out = R.checks_all_days(fact_rows(spark, day_events("2024-01-01", 3))).first()
    assert out["check_date"] == D("2024-01-01")


def test_dup_strategies_agree(spark):
    from tidewatch.operators import stats as ST

    t = TS("2024-01-01T10:00:00")
    base = {"user_id": "u", "session_id": "s", "event_type": "view", "product_id": "p", "event_ts": t}
    ev = [dict(base)] * 3 + [dict(base, user_id="v")] * 2 + day_events("2024-01-02", 50)
    ev += [dict(base, event_ts=TS("2024-01-02T09:00:00"))] * 2
    fact = fact_rows(spark, ev)
    single = {r["event_date"]: r["dup_groups"] for r in ST.day_stats_with_dups(fact).collect()}
    prepass = {r["event_date"]: r["dup_groups"] for r in ST.day_stats_and_dups(fact).collect()}
    per_day = {r["event_date"]: r["dup_groups"] for r in ST.dup_groups_per_day(fact).collect()}
    assert single == prepass == {D("2024-01-01"): 2, D("2024-01-02"): 1}
    assert per_day == {D("2024-01-01"): 2, D("2024-01-02"): 1}


def test_newest_event_rule_looks_back_past_a_long_gap(spark):
    ev = day_events("2024-01-01", 2, hour=10)  # last event 2024-01-01 10:00:01
    got = by_rule(R.checks_for_run_date(spark, fact_rows(spark, ev), "2024-03-15",
                                        [R.latest_event_24h()]).collect())
    r = got[("2024-03-15", "freshness_latest_event_within_24h")]
    hours = (TS("2024-03-16T00:00:00") - TS("2024-01-01T10:00:01")).total_seconds() / 3600
    assert r["status"] == "FAIL" and abs(r["metric_value"] - hours) < 1e-9
