"""Incident episodes, reconciled log, day digests, recompute after late data, entity state."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from conftest import D, TS, day_events, fact_rows
from pyspark.sql import functions as F
from test_incidents_reports import NULL_RULE, checks_df

from tidewatch import schemas
from tidewatch.operators import anomalies as A
from tidewatch.operators import digests as DG
from tidewatch.operators import episodes as E
from tidewatch.operators import incidents as I
from tidewatch.operators import rules as R
from tidewatch.operators import series_state as SS
from tidewatch.plans import daily
from tidewatch.sources.tables import SERIES_TABLE, Store

SCORED = [f for f in schemas.ANOMALIES if f.name != "created_at"]


def days(first: str, n: int) -> list[str]:
    return [(D(first) + dt.timedelta(days=i)).isoformat() for i in range(n)]


# ---- episodes ------------------------------------------------------------------------

def test_check_runs_become_episodes(spark):
    marks = "FFPFWFPPF"
    status = {"F": "FAIL", "P": "PASS", "W": "WARN"}
    checks = checks_df(spark, [(d, NULL_RULE, "P1", status[m], 1.0) for d, m in zip(days("2024-01-01", 9), marks)]
                       + [("2024-01-05", "other_rule", "P2", "PASS", 0.0)])
    got = sorted((r["first_day"], r["last_day"], r["failing_days"], r["closed_on"]) for r in E.check_episodes(checks).collect())
    assert [(str(a), str(b), n, c and str(c)) for a, b, n, c in got[:2]] == [
        ("2024-01-01", "2024-01-02", 2, "2024-01-03"), ("2024-01-04", "2024-01-06", 3, "2024-01-07")]
    assert got[2][:3] == (D("2024-01-09"), D("2024-01-09"), 1) and got[2][3] is None


def scored_df(spark, flags: dict[str, str], entity=("overall", None), metric="revenue"):
    from pyspark.sql import types as T

    data = [(D(d), *entity, metric, 1.0, 1.0, 4.0 if f == "Y" else 0.0, 0.0, f, "n") for d, f in flags.items()]
    return spark.createDataFrame(data, T.StructType(SCORED))


def brute_episodes(flags: dict[str, str], gap: int):
    flagged = [D(d) for d in sorted(flags) if flags[d] == "Y"]
    runs = []
    for d in flagged:
        if runs and (d - runs[-1][-1]).days <= gap:
            runs[-1].append(d)
        else:
            runs.append([d])
    every = sorted(D(d) for d in flags)
    return [(r[0], r[-1], len(r), next((d for d in every if d > r[-1]), None)) for r in runs]


@pytest.mark.parametrize("gap", [1, 2, 4])
def test_flagged_days_merge_into_episodes(spark, gap):
    rng = random.Random(gap)
    flags = {d: rng.choice("YYNN") for d in days("2024-01-01", 40) if rng.random() < 0.8}
    got = E.anomaly_episodes(scored_df(spark, flags), gap).collect()
    assert sorted((r["first_day"], r["last_day"], r["flagged_days"], r["closed_on"]) for r in got) == brute_episodes(flags, gap)


def test_anomaly_incident_ids_are_stable_and_unique(spark):
    flags = {d: f for d, f in zip(days("2024-01-01", 6), "NYYNNY")}
    one = scored_df(spark, flags)
    both = one.unionByName(scored_df(spark, flags, ("category", "5"))).unionByName(scored_df(spark, flags, ("category", None)))
    ids = [r["incident_id"] for r in E.anomaly_incidents(E.anomaly_episodes(both)).collect()]
    assert len(ids) == len(set(ids)) == 6
    assert "INC-2024-01-02-ANOMALY-REVENUE" in ids and "INC-2024-01-02-ANOMALY-REVENUE-CATEGORY=5" in ids
    early = scored_df(spark, dict(list(flags.items())[:2]))  # the episode has just begun
    assert [r["incident_id"] for r in E.anomaly_incidents(E.anomaly_episodes(early)).collect()] == ["INC-2024-01-02-ANOMALY-REVENUE"]


# ---- the log -------------------------------------------------------------------------

LOG = "incident_id string, status string, changed_at timestamp, note string, origin string"


def test_reconciling_is_a_difference_and_order_does_not_matter(spark):
    def marks(text):
        return checks_df(spark, [(d, NULL_RULE, "P1", {"F": "FAIL", "P": "PASS"}[m], 1.0)
                                 for d, m in zip(days("2024-01-01", len(text)), text)])

    rng = random.Random(2)
    incidents = I.open_incidents(spark, marks("FFFFFF"))
    log = [(f"INC-{d}-NULL-SESSION", "OPEN", TS(f"{d}T00:00:00"), "", None) for d in days("2024-01-01", 6)]
    for text in ("FFPPFF", "PFPPFF", "FFFFPF", "FFPPFF", "PPPPPP", "FFFFFF"):
        closings = E.check_closings(marks(text))
        more = E.reconcile(incidents, spark.createDataFrame(log, LOG), closings, "check")
        log += [tuple(r) for r in more.select("incident_id", "status", "changed_at", "note", "origin").collect()]
        rng.shuffle(log)
        now = spark.createDataFrame(log, LOG)
        assert E.reconcile(incidents, now, closings, "check").isEmpty()
        for r in I.current_state(incidents, now).collect():
            at = int(r["incident_id"][12:14]) - 1
            ends = at if text[at] == "P" else text.find("P", at)
            assert r["status"] == ("OPEN" if ends < 0 else "RESOLVED")
            assert r["closed_at"] == (None if ends < 0 else TS(f"2024-01-{ends + 1:02d}T00:00:00"))
    assert any(r[1] == I.REOPENED for r in log)


def test_rows_by_hand_are_not_withdrawn(spark):
    checks = checks_df(spark, [("2024-01-01", NULL_RULE, "P1", "FAIL", 1.0)])
    incidents = I.open_incidents(spark, checks)
    log = spark.createDataFrame([("INC-2024-01-01-NULL-SESSION", "RESOLVED", TS("2024-01-03T00:00:00"), "by ops", None)], LOG)
    assert E.reconcile(incidents, log, E.check_closings(checks), "check").isEmpty()
    assert I.current_state(incidents, log).first()["status"] == "RESOLVED"


def test_repaired_day_closes_and_fails_again(spark):
    good, bad = (day_events(d, 20, purchases=1, null_sessions=n) for d, n in (("2024-01-06", 0), ("2024-01-06", 9)))
    other = day_events("2024-01-07", 20, purchases=1, null_sessions=9)
    store = Store.scratch(spark, "t_repair")
    daily.load_history(store, fact_rows(spark, bad + other))
    daily.backfill(store)

    def state():
        return {r["incident_id"][15:] + r["incident_id"][4:14]: (r["status"], r["closed_at"]) for r in daily.incidents_now(store).where(
            "detected_by = 'null_rate_session_id_run_date'").collect()}

    six, seven = "NULL-SESSION2024-01-06", "NULL-SESSION2024-01-07"
    assert state()[six][0] == "OPEN" and state()[seven][0] == "OPEN"
    daily.append_days(store, fact_rows(spark, good))
    for d in ("2024-01-06", "2024-01-07"):
        daily.run_day(store, d)
    assert state()[six] == ("RESOLVED", TS("2024-01-06T00:00:00")) and state()[seven][0] == "OPEN"
    daily.append_days(store, fact_rows(spark, bad))
    daily.run_day(store, "2024-01-06")
    assert state()[six] == ("OPEN", None)
    assert store.read("dq_incidents").groupBy("incident_id").count().where("count > 1").isEmpty()


def test_two_limits_of_one_rule_have_incidents_of_their_own(spark):
    rules = [R.volume_prev_day(5), R.volume_prev_day(8)]
    store = Store.scratch(spark, "t_limits")
    daily.load_history(store, fact_rows(spark, [e for d, n in zip(days("2024-01-01", 5), (9, 3, 6, 6, 9)) for e in day_events(d, n)]))
    daily.backfill(store, rules)
    got = {r["incident_id"]: r["status"] for r in daily.incidents_now(store).collect()}
    assert got["INC-2024-01-03-LOW-VOLUME-MIN-5"] == "RESOLVED" and got["INC-2024-01-03-LOW-VOLUME-MIN-8"] == "OPEN"
    assert "INC-2024-01-04-LOW-VOLUME-MIN-5" not in got and len(got) == 6  # both limits on days 1 and 3, the upper one on 4 and 5
    usual = checks_df(spark, [("2024-01-01", "volume_prev_day_events_min_1000", "P0", "FAIL", 1.0)])
    assert I.open_incidents(spark, usual).first()["incident_id"] == "INC-2024-01-01-LOW-VOLUME"


# ---- rules that warn -----------------------------------------------------------------

def test_rules_warn_between_their_limits(spark):
    fact = fact_rows(spark, [e for d, n in zip(days("2024-01-01", 4), (10, 7, 3, 9)) for e in day_events(d, n, null_sessions=1)])
    rules = [R.volume_prev_day(8, fail_below=5), R.null_rate_session(10.0, fail_above=20.0)]
    got = {(str(r["check_date"]), r["check_name"][:4]): (r["status"], r["failure_details"] is None)
           for r in R.checks_all_days(fact, rules).collect()}
    assert [got[(d, "volu")][0] for d in days("2024-01-01", 4)] == ["FAIL", "PASS", "WARN", "FAIL"]
    assert [got[(d, "null")] for d in days("2024-01-01", 4)] == [("PASS", True), ("WARN", False), ("FAIL", False), ("WARN", False)]


# ---- digests -------------------------------------------------------------------------

def test_digest_ignores_order_and_sees_every_change(spark):
    events = day_events("2024-01-01", 50)
    base = DG.day_digests(fact_rows(spark, events)).first()
    assert DG.day_digests(fact_rows(spark, events[::-1]).repartition(7)).first() == base
    for change in ({"brand": ""}, {"session_id": None}, {"price": 10.01}, {"category_id": "x", "category_code": None}):
        other = [dict(events[0], **change), *events[1:]]
        assert DG.day_digests(fact_rows(spark, other)).first() != base
    swapped = [dict(events[0], category_id="x", brand=None), dict(events[0], category_id=None, brand="x")]
    one, two = (DG.day_digests(fact_rows(spark, [e])).first() for e in swapped)
    assert one["hash_xor"] != two["hash_xor"]


def test_load_audit_names_every_kind(spark):
    def loaded(day, k):
        return day_events(day, 6) * k

    history = [e for i in range(1, 9) for e in loaded(f"2024-01-0{i}", 1) if i != 6]
    daily_rows = (loaded("2024-01-01", 1) + loaded("2024-01-02", 2) + loaded("2024-01-03", 3) + loaded("2024-01-04", 1)[:4]
                  + loaded("2024-01-06", 1) + [dict(e, brand="new") for e in loaded("2024-01-07", 1)[:2]] + loaded("2024-01-07", 1)[2:]
                  + loaded("2024-01-08", 1)[:5] + loaded("2024-01-08", 1)[:1])
    got = {str(r["event_date"])[8:]: (r["state"], r["missing_rows"], r["extra_rows"], r["foreign_rows"])
           for r in DG.load_audit(fact_rows(spark, history), fact_rows(spark, daily_rows)).collect()}
    assert got == {"01": ("ok", 0, 0, 0), "02": ("doubled", 0, 6, 0), "03": ("doubled", 0, 12, 0), "04": ("partial", 2, 0, 0),
                   "05": ("missing", 6, 0, 0), "06": ("foreign", 0, 6, 6), "07": ("mixed", 2, 2, 2), "08": ("mixed", 1, 1, 0)}


def test_days_reached_by_a_change():
    present = [D(d) for d in days("2024-01-01", 30) if d != "2024-01-10"]
    assert DG.days_checked([D("2024-01-05"), D("2024-01-09")], present) == [D(f"2024-01-0{i}") for i in (5, 6, 9)]
    assert DG.days_checked([D("2024-01-05")], present, running=True) == present[4:]
    assert DG.days_scored([D("2024-01-05")], present, 3) == [D(f"2024-01-0{i}") for i in (5, 6, 7, 8)]
    assert DG.days_scored([D("2024-01-10")], present, 3) == [D(f"2024-01-1{i}") for i in (1, 2, 3)]  # a day that is gone
    assert DG.days_scored([D("2024-02-10")], present, 3) == [] and DG.days_checked([], present, True) == []


def partition_files(spark, store, table):
    out = {}
    for r in store.read(table).select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect():
        out.setdefault(r[0].split("/")[-2], set()).add((os.path.basename(r[0]), r[1]))
    return out


def test_recompute_equals_backfill_and_leaves_other_days_alone(spark):
    rng = random.Random(6)
    every = {d: day_events(d, rng.randrange(20, 60), purchases=rng.randrange(0, 4), null_sessions=rng.randrange(0, 2)) for d in days("2024-01-01", 26)}
    first = [e for d, ev in every.items() if d not in ("2024-01-08",) for e in (ev[:10] if d == "2024-01-04" else ev)]
    second = [e for d, ev in every.items() if d != "2024-01-06" for e in ev]
    late, whole = Store.scratch(spark, "t_late"), Store.scratch(spark, "t_whole")
    daily.load_history(late, fact_rows(spark, first))
    daily.backfill(late)
    tables = ("fact_events", "dq_day_stats", "dq_check_results", "dq_anomalies", "dq_run_context")
    before = {t: partition_files(spark, late, t) for t in tables}
    daily.load_history(late, fact_rows(spark, second))
    done = daily.recompute(late)
    assert done["changed"] == [D("2024-01-04"), D("2024-01-06"), D("2024-01-08")]
    assert done["checked"] == [D(f"2024-01-0{i}") for i in (4, 5, 7, 8, 9)]
    assert done["scored"][-1] == D("2024-01-22") and D("2024-01-03") not in done["scored"]
    daily.load_history(whole, fact_rows(spark, second))
    daily.backfill(whole)
    for t in tables:
        a, b = (sorted(map(repr, s.read(t).drop("created_at").collect())) for s in (late, whole))
        assert a == b, t
    touched = {"fact_events": done["changed"], "dq_day_stats": done["changed"], "dq_run_context": done["changed"],
               "dq_check_results": done["checked"], "dq_anomalies": done["scored"]}
    for t, ds in touched.items():
        after = partition_files(spark, late, t)
        same = [p for p in after if p.split("=")[1] not in {str(d) for d in ds} | {"2024-01-06"}]
        assert same and all(after[p] == before[t][p] for p in same), t
    assert daily.recompute(late) == {"changed": [], "checked": [], "scored": []}
    audit = {r["state"] for r in daily.audit_load(late).collect()}
    assert audit == {"ok"}


# ---- entity state --------------------------------------------------------------------

LEVELS = (("category", "category_id"), ("product", "product_id"))


def entity_events(n_days=32):
    rng = random.Random(1)
    out = []
    for i, d in enumerate(days("2024-01-01", n_days)):
        for e in day_events(d, rng.randrange(15, 30), purchases=rng.randrange(1, 8), price=float(rng.randrange(1, 50))):
            out.append(dict(e, category_id=rng.choice(["1", "2", None, ""]), product_id=rng.choice(["p1", "p2"] + (["rare"] if i % 5 == 0 else []))))
    return out


def scored_rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in
                  df.select(*[f.name for f in SCORED if f.name != "entity_id"], F.coalesce("entity_id", F.lit("<null>")).alias("e")).fillna(-9.0).collect())


def test_state_scores_like_the_whole_history(spark):
    events = entity_events()
    fact = fact_rows(spark, events)
    kpis = A.entity_kpis(fact, LEVELS, include_overall=False)
    whole = A.score(A.kpis_long(kpis, None, "entity_id"))
    state = SS.state_of(kpis.where("d < DATE '2024-01-28'"), keep=18)
    for d in days("2024-01-28", 3):
        today = kpis.where(F.col("d") == F.lit(D(d)))
        assert SS.can_score(state, D(d))
        want = scored_rows(whole.where(F.col("anomaly_date") == F.lit(D(d))))
        assert scored_rows(SS.score_day(state, today, D(d))) == want
        state = spark.createDataFrame(
            SS.advanced(state, today, D(d), keep=18).collect(), SS.SERIES_STATE)
        assert scored_rows(SS.score_day(state, today, D(d))) == want  # the day again, with its rows in the state
    again = {tuple(r) for r in SS.advanced(state, kpis.where("d = DATE '2024-01-30'"), D("2024-01-30"), keep=18).select("entity_key", "last_day").collect()}
    assert again == {tuple(r) for r in state.select("entity_key", "last_day").collect()}
    assert not SS.can_score(state, D("2024-01-05"))  # rows before are cut: the caller scores from the facts
    gone = SS.advanced(state, kpis.where("false"), D("2024-01-30"), keep=18)
    assert gone.where("last_day >= DATE '2024-01-30'").isEmpty()


def test_store_scores_entities_by_day_and_at_once(spark):
    events = entity_events(31)
    loop, whole = Store.scratch(spark, "t_eloop"), Store.scratch(spark, "t_ewhole")
    daily.load_history(whole, fact_rows(spark, events))
    daily.backfill(whole, entities=LEVELS)
    daily.load_history(loop, fact_rows(spark, [e for e in events if str(e["event_ts"])[:10] < "2024-01-30"]))
    daily.backfill(loop, entities=LEVELS)
    daily.append_days(loop, fact_rows(spark, [e for e in events if str(e["event_ts"])[:10] >= "2024-01-30"]))
    for d in ("2024-01-30", "2024-01-31", "2024-01-30", "2024-01-03"):  # the last one is older than the state reaches
        daily.run_day(loop, d, entities=LEVELS)
    assert scored_rows(loop.read("dq_anomalies")) == scored_rows(whole.read("dq_anomalies"))
    daily.reset_replay(loop)
    assert loop.read(SERIES_TABLE).isEmpty()


def test_no_exchange_on_the_state(spark):
    store = Store.scratch(spark, "t_eplan")
    fact = fact_rows(spark, entity_events(20))
    kpis = A.entity_kpis(fact, LEVELS, include_overall=False)
    store.replace_series_state(SS.state_of(kpis))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        today = spark.createDataFrame(
            kpis.where("d = DATE '2024-01-20'").collect(), kpis.schema)
        for df in (SS.score_day(store.read(SERIES_TABLE), today, D("2024-01-20")),
                   SS.advanced(store.read(SERIES_TABLE), today, D("2024-01-20"))):
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            plan = plan.split("== Initial Plan ==")[0]
            assert plan.count("Exchange hashpartitioning") == 1  # the day's own rows, to the buckets
            assert f"{store.state_buckets})" in plan.split("Exchange hashpartitioning")[1].split("\n")[0].replace("]", ")") or "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_zero_days_between_first_and_last(spark):
    fact = fact_rows(spark, day_events("2024-01-01", 4, purchases=1) + day_events("2024-01-04", 5, purchases=0))
    kpis = A.entity_kpis(fact, (), include_overall=True)
    got = {str(r["d"]): (r["events_count"], r["cvr"]) for r in A.zero_filled(kpis).collect()}
    assert got == {"2024-01-01": (4.0, 0.25), "2024-01-02": (0.0, None), "2024-01-03": (0.0, None), "2024-01-04": (5.0, 0.0)}
    assert A.zero_filled(kpis, through="2024-01-06").count() == 6


def test_robust_score_is_not_moved_by_one_outlier(spark):
    from pyspark.sql import types as T

    values = [10, 11, 9, 10, 12, 500, 10, 11, 9, 10, 100]
    long = spark.createDataFrame([(D(d), "overall", None, "events_count", float(v)) for d, v in zip(days("2024-01-01", 11), values)],
                                 T.StructType([f for f in SCORED[:5]]))
    last = A.score_robust(long).where("anomaly_date = DATE '2024-01-11'").first()
    assert last["baseline_value"] == 10.0 and last["baseline_mad"] == 1.0 and last["anomaly_flag"] == "Y"
    assert abs(last["z_score"] - 90 / 1.4826) < 1e-9
    assert abs(A.score(long).where("anomaly_date = DATE '2024-01-11'").first()["z_score"]) < 1  # the mean hides it
    first = A.score_robust(long).where("anomaly_date = DATE '2024-01-01'").first()
    assert first["baseline_value"] is None and first["anomaly_flag"] == "N"
