"""Table writes: reruns are idempotent, and the daily loop equals the single pass."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF_SMALL, D, day_events, fact_rows
from pyspark.sql import functions as F

from tidewatch.plans import daily
from tidewatch.sources import test_tables as TT
from tidewatch.sources.tables import Store


def rows(df, drop=("created_at",)):
    return sorted(tuple(r) for r in df.drop(*drop).collect())


def test_ingest_twice_and_empty_second_version(spark):
    store = Store.scratch(spark, "t_ingest")
    daily.load_history(store, fact_rows(spark, day_events("2024-01-01", 5) + day_events("2024-01-02", 3)))
    daily.ingest_day(store, "2024-01-01")
    daily.ingest_day(store, "2024-01-01")
    assert store.read("fact_events").count() == 5
    # the day's new version is empty: a static partition overwrite clears it
    empty = store.read("fact_events_all").where(F.lit(False))
    store.overwrite_day("fact_events", empty, "2024-01-01")
    assert store.read("fact_events").count() == 0


def test_overwrite_days_replaces_only_days_present(spark):
    store = Store.scratch(spark, "t_days")
    daily.load_history(store, fact_rows(spark, day_events("2024-01-01", 5) + day_events("2024-01-02", 3)))
    store.overwrite_days("fact_events_all", fact_rows(spark, day_events("2024-01-02", 7)))
    got = {r["event_date"].isoformat(): r["n"] for r in
           store.read("fact_events_all").groupBy("event_date").agg(F.count("*").alias("n")).collect()}
    assert got == {"2024-01-01": 5, "2024-01-02": 7}


def test_daily_loop_equals_single_pass_and_reruns_converge(spark):
    fact = TT.fact_events_from_dir(spark, SF_SMALL)
    loop, single = Store.scratch(spark, "t_loop"), Store.scratch(spark, "t_single")
    daily.load_history(loop, fact)
    daily.load_history(single, fact)
    days = sorted(r["d"] for r in fact.select(F.col("event_date").alias("d")).distinct().collect())
    for d in days[:10]:
        daily.run_day(loop, d)
    daily.run_day(loop, days[9])  # rerun of one day changes nothing
    daily.backfill(single)
    daily.backfill(single)  # rerun of all days changes nothing
    first10 = F.col("check_date") <= F.lit(days[9])
    assert rows(loop.read("dq_check_results")) == rows(single.read("dq_check_results").where(first10))
    a10 = F.col("anomaly_date") <= F.lit(days[9])
    la = [tuple(round(x, 6) if isinstance(x, float) else x for x in r)
          for r in rows(loop.read("dq_anomalies"))]
    sa = [tuple(round(x, 6) if isinstance(x, float) else x for x in r)
          for r in rows(single.read("dq_anomalies").where(a10))]
    assert la == sa
    assert single.read("fact_events").count() == fact.count()
    assert single.read("dq_check_results").count() == 4 * len(days)
    ids = [r[0] for r in single.read("dq_incidents").select("incident_id").collect()]
    assert len(ids) == len(set(ids))  # no incident opened twice
    assert single.read("dq_run_context").count() == len(days)


def test_reset_then_ingest(spark):
    store = Store.scratch(spark, "t_reset")
    daily.load_history(store, fact_rows(spark, day_events("2024-01-01", 5) + day_events("2024-01-02", 3)))
    daily.backfill(store)
    daily.reset_replay(store)
    assert store.read("fact_events").count() == 0
    daily.ingest_day(store, "2024-01-02")
    assert store.read("fact_events").count() == 3


def test_spike_masks_same_rows_on_rerun(spark):
    fact = fact_rows(spark, day_events("2024-01-01", 2000) + day_events("2024-01-02", 100))
    a = daily.mask_sessions(fact, "2024-01-01", 0.2)
    b = daily.mask_sessions(fact.repartition(7), "2024-01-01", 0.2)
    ka = sorted(r[0] for r in a.where(F.col("session_id").isNull()).select("event_id").collect())
    kb = sorted(r[0] for r in b.where(F.col("session_id").isNull()).select("event_id").collect())
    assert ka == kb
    assert 0.17 < len(ka) / 2000 < 0.23
    assert a.where((F.col("event_date") == D("2024-01-02")) & F.col("session_id").isNull()).count() == 0


def test_spike_day_fails_null_rule(spark):
    store = Store.scratch(spark, "t_spike")
    daily.load_history(store, fact_rows(spark, day_events("2024-01-01", 500) + day_events("2024-01-02", 500)))
    daily.backfill(store, spike=("2024-01-02", 0.2))
    r = store.read("dq_check_results").where(
        (F.col("check_name") == "null_rate_session_id_run_date") & (F.col("check_date") == D("2024-01-02"))).first()
    assert r["status"] == "FAIL" and r["metric_value"] > 10
    opened = store.read("dq_incidents").where(F.col("incident_id") == "INC-2024-01-02-NULL-SESSION").count()
    assert opened == 1


def test_export_reports(spark, tmp_path):
    store = Store.scratch(spark, "t_export")
    daily.load_history(store, fact_rows(spark, day_events("2024-01-01", 5) + day_events("2024-01-02", 3)))
    daily.backfill(store)
    from tidewatch.session import scratch_path

    out = daily.export_reports(store, scratch_path(spark, "export-test"))
    health = spark.read.option("header", True).csv(out["health_daily"]).collect()
    assert [r["check_date"] for r in health] == ["2024-01-01", "2024-01-02"]
    checks = spark.read.option("header", True).csv(out["check_results_with_incidents"])
    assert checks.count() == 8 and "incident_id" in checks.columns


def test_init_tables_recovers_existing_folders(spark):
    from tidewatch.sources.tables import TABLES

    store = Store.scratch(spark, "t_recover")
    daily.load_history(store, fact_rows(spark, day_events("2024-01-01", 5) + day_events("2024-01-02", 3)))
    daily.backfill(store)
    before = {t: store.read(t).count() for t in TABLES}
    for t in TABLES:  # external tables: dropping the registration keeps the files
        spark.sql(f"DROP TABLE {store.name(t)}")
    again = Store(spark, root=store.root, database=store.database).init_tables()
    after = {t: again.read(t).count() for t in TABLES}
    assert after == before and after["fact_events"] == 8
    daily.run_day(again, "2024-01-02")  # and keeps working on the recovered tables
    assert again.read("dq_check_results").count() == before["dq_check_results"]


def test_csv_extract_format(spark):
    import glob

    from tidewatch.session import scratch_path
    from tidewatch.sources.tables import export_csv

    df = spark.createDataFrame(
        [("b", None, D("2024-01-02")), ("a", "x", D("2024-01-01"))], "k string, v string, d date"
    ).withColumn("t", F.to_timestamp(F.lit("2024-01-01 10:00:00")))
    path = export_csv(df, scratch_path(spark, "csv-format"), ["k"])
    files = [f for f in glob.glob(path.replace("file:", "") + "/part-*.csv")]
    assert len(files) == 1  # small report: one file
    lines = open(files[0]).read().splitlines()
    assert lines[0] == "k,v,d,t"
    assert lines[1] == "a,x,2024-01-01,2024-01-01 10:00:00.000000"
    assert lines[2] == "b,,2024-01-02,2024-01-01 10:00:00.000000"  # NULL -> empty field


def test_stats_follow_ingest_and_reset(spark):
    """Checks after a reset see only the facts that are there."""
    store = Store.scratch(spark, "t_follow")
    daily.load_history(store, fact_rows(spark, [e for d, n in (("2024-01-01", 5), ("2024-01-02", 6), ("2024-01-03", 7))
                                                for e in day_events(d, n, purchases=1)]))
    daily.backfill(store)
    daily.reset_replay(store)
    daily.run_day(store, "2024-01-03")
    got = {r["check_name"]: (r["status"], r["metric_value"]) for r in
           store.read("dq_check_results").where("check_date = DATE '2024-01-03'").collect()}
    assert got["purchase_events_vanish_prev_day"] == ("FAIL", 0.0)
    daily.ingest_day(store, "2024-01-02")
    daily.run_day(store, "2024-01-03")
    got = {r["check_name"]: r["status"] for r in
           store.read("dq_check_results").where("check_date = DATE '2024-01-03'").collect()}
    assert got["purchase_events_vanish_prev_day"] == "PASS"


def test_full_load_replaces_history_and_append_keeps_it(spark):
    store = Store.scratch(spark, "t_reload")
    daily.load_history(store, fact_rows(spark, day_events("2024-01-01", 5) + day_events("2024-01-02", 3)))
    daily.append_days(store, fact_rows(spark, day_events("2024-01-03", 2)))
    assert store.read("fact_events_all").count() == 10
    daily.load_history(store, fact_rows(spark, day_events("2024-01-02", 4)))
    assert store.read("fact_events_all").count() == 4


def test_store_resolves_incidents_once(spark):
    store = Store.scratch(spark, "t_resolve")
    daily.load_history(store, fact_rows(spark, day_events("2024-01-01", 5, purchases=1, null_sessions=5)
                                        + day_events("2024-01-02", 5, purchases=1)))
    daily.backfill(store)
    daily.backfill(store)
    log = store.read("dq_incident_status_log").where("incident_id = 'INC-2024-01-01-NULL-SESSION'")
    assert sorted(r["status"] for r in log.collect()) == ["OPEN", "RESOLVED"]
    now = daily.incidents_now(store).where("incident_id = 'INC-2024-01-01-NULL-SESSION'").first()
    assert now["status"] == "RESOLVED" and now["closed_at"] is not None


def test_revenue_keeps_every_price(spark):
    from tidewatch.operators.stats import day_stats, day_stats_with_dups

    prices = [1.00005, 1e19, 2.0, None]
    rows = [dict(e, event_type="purchase", price=p, user_id=f"u{i}") for i, (e, p) in
            enumerate(zip(day_events("2024-01-01", 4, purchases=4), prices))]
    fact = fact_rows(spark, rows)
    for stats in (day_stats(fact), day_stats_with_dups(fact)):
        assert stats.first()["revenue"] == 2.0 + (1.00005 + 1e19)


def test_csv_columns_by_header_name(spark):
    from tidewatch.session import scratch_path
    from tidewatch.sources.raw_csv import read_raw_csv

    path = scratch_path(spark, "csv-order")
    names = ["user_id", "price", "event_time", "event_type", "product_id", "category_id", "category_code", "brand", "user_session"]
    spark.createDataFrame([("u1", "2.5", "2024-01-01 00:00:00 UTC", "view", "p", "c", "cc", "b", "s")], names).write.option(
        "header", True).csv(path)
    row = read_raw_csv(spark, path).first()
    assert row["user_id"] == "u1" and row["price"] == "2.5" and row["event_time"].startswith("2024")
    bad = scratch_path(spark, "csv-bad")
    spark.createDataFrame([("u1",)], ["user_id"]).write.option("header", True).csv(bad)
    with pytest.raises(ValueError, match="header lacks"):
        read_raw_csv(spark, bad)


def test_incidents_logged_by_hand_are_checked(spark):
    store = Store.scratch(spark, "t_manual")
    one = "incident_id string, opened_at timestamp, severity string, summary string"
    at = dt.datetime(2024, 1, 1)
    daily.log_incident(store, spark.createDataFrame([("INC-2024-01-01-BY-HAND", at, "P1", "seen by ops")], one))
    change = "incident_id string, status string, changed_at timestamp, note string"
    daily.record_status(store, spark.createDataFrame(
        [("INC-2024-01-01-BY-HAND", "TRIAGING", dt.datetime(2024, 1, 2), "on it")], change))
    now = daily.incidents_now(store).collect()
    assert [(r["incident_id"], r["status"]) for r in now] == [("INC-2024-01-01-BY-HAND", "TRIAGING")]
    for row in (("INC-2024-01-01-BY-HAND", at, "P1", "again"), (None, at, "P1", ""), ("INC-2", at, "P9", "")):
        with pytest.raises(ValueError):
            daily.log_incident(store, spark.createDataFrame([row], one))
    for row in (("INC-NONE", "OPEN", at, ""), ("INC-2024-01-01-BY-HAND", "DONE", at, "")):
        with pytest.raises(ValueError):
            daily.record_status(store, spark.createDataFrame([row], change))
