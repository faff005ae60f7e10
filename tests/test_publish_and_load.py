"""A day's partitions change together; loads keep what they reject; exports in parts are in order."""

from __future__ import annotations

import glob

import pytest
from conftest import SF_SMALL, D, day_events, fact_rows
from pyspark.sql import functions as F

from tidewatch.operators import anomalies as A
from tidewatch.plans import daily
from tidewatch.session import scratch_path
from tidewatch.sources import publish
from tidewatch.sources import test_tables as TT
from tidewatch.sources.publish import DayRun
from tidewatch.sources.raw_csv import write_raw_csv
from tidewatch.sources.tables import Store, export_csv

DAY_TABLES = ("fact_events", "dq_day_stats", "dq_day_digest", "dq_check_results", "dq_anomalies", "dq_run_context")


def content(store):
    return {t: sorted(map(repr, store.read(t).drop("created_at").collect())) for t in DAY_TABLES}


@pytest.fixture
def changed(spark):
    """A store whose history has changed on a day since it was run, and what the run will give."""
    store, after = Store.scratch(spark, "t_pub"), Store.scratch(spark, "t_pubw")
    first = day_events("2024-01-01", 20, purchases=2) + day_events("2024-01-02", 20, purchases=2)
    second = day_events("2024-01-02", 33, purchases=0, null_sessions=8)
    daily.load_history(store, fact_rows(spark, first))
    daily.backfill(store)
    daily.append_days(store, fact_rows(spark, second))
    daily.load_history(after, fact_rows(spark, first[:20] + second))
    daily.backfill(after)
    return store, content(store), content(after)


@pytest.mark.parametrize("table", DAY_TABLES)
def test_a_run_that_fails_leaves_the_old_day(changed, monkeypatch, table):
    store, before, after = changed
    write = DayRun.write

    def failing(self, t, rows):
        if t == table:
            raise RuntimeError("executor lost for good")
        return write(self, t, rows)

    monkeypatch.setattr(DayRun, "write", failing)
    with pytest.raises(RuntimeError):
        daily.run_day(store, "2024-01-02")
    assert content(store) == before
    monkeypatch.undo()
    daily.run_day(store, "2024-01-02")
    assert content(store) == after


def test_a_publication_that_stops_halfway_is_completed(changed, monkeypatch):
    store, before, after = changed
    point, done = Store.point_day, []

    def failing(self, *args):
        if len(done) == 3:
            raise RuntimeError("driver lost")
        done.append(args)
        point(self, *args)

    monkeypatch.setattr(Store, "point_day", failing)
    with pytest.raises(RuntimeError):
        daily.run_day(store, "2024-01-02")
    assert content(store)["dq_run_context"] == before["dq_run_context"]  # the marker comes last
    monkeypatch.undo()
    store.init_tables()
    assert content(store) == after


def test_published_days_are_found_by_a_new_catalog_and_by_later_writes(spark, changed):
    store, _, after = changed
    daily.run_day(store, "2024-01-02")
    daily.run_day(store, "2024-01-02")
    for t in DAY_TABLES:
        spark.sql(f"DROP TABLE {store.name(t)}")
    again = Store(spark, root=store.root, database=store.database).init_tables()
    assert content(again) == after
    old = publish.vacuum(again)
    assert len(old) == len(DAY_TABLES) and content(again) == after and publish.vacuum(again) == []
    daily.backfill(again)  # static overwrite over published partitions
    assert content(again) == after
    for t in DAY_TABLES:
        spark.sql(f"DROP TABLE {store.name(t)}")
    assert content(Store(spark, root=store.root, database=store.database).init_tables()) == after


def test_a_copy_that_lacks_rows_is_refused(changed, monkeypatch):
    store, before, _ = changed
    write = DayRun.write
    monkeypatch.setattr(DayRun, "write", lambda self, t, rows: write(self, t, rows.limit(5) if t == "fact_events" else rows))
    with pytest.raises(RuntimeError, match="5 of 33"):
        daily.run_day(store, "2024-01-02")
    assert content(store) == before


def test_store_removes_only_its_own_folders(spark):
    store = Store.scratch(spark, "t_own")
    with pytest.raises(ValueError):
        store.remove(scratch_path(spark, "other"))
    store.drop()
    assert not store.exists(store.root) and not spark.catalog.databaseExists(store.database)


# ---- quarantine ----------------------------------------------------------------------

def test_load_keeps_rejected_rows_with_their_reason(spark):
    path = scratch_path(spark, "dirty")
    raw = TT.dirty_events_from_dir(spark, SF_SMALL)
    write_raw_csv(raw, path)
    store, plain = Store.scratch(spark, "t_quarantine"), Store.scratch(spark, "t_plain")
    counts = daily.load_raw_csv(store, path, quarantine=True)
    assert daily.load_raw_csv(plain, path) == {}
    kept, rejected = store.read("fact_events_all"), store.read("dq_rejected_rows")
    assert counts["raw_rows"] == raw.count() == kept.count() + rejected.count()
    assert counts["rejected_rows"] == rejected.count() > 0 and counts["unread_prices"] > 0
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, plain.read("fact_events_all").collect()))
    reasons = {(r["event_time"], r["reason"]) for r in rejected.collect()}
    assert reasons == {(None, "no event time"), ("junk", "unreadable event time")}
    daily.load_raw_csv(store, path, quarantine=True)  # a full load replaces
    assert store.read("dq_rejected_rows").count() == counts["rejected_rows"]


def test_load_with_nothing_or_everything_rejected(spark):
    store = Store.scratch(spark, "t_all")
    raw = TT.raw_events_from_dir(spark, SF_SMALL)
    counts = daily.load_with_quarantine(store, raw)
    assert counts["rejected_rows"] == 0 and counts["kept_rows"] == raw.count() and store.read("dq_rejected_rows").isEmpty()
    counts = daily.load_with_quarantine(store, raw.withColumn("event_time", F.lit("  ")))
    assert counts["kept_rows"] == 0 and store.read("fact_events_all").isEmpty()
    assert store.read("dq_rejected_rows").count() == raw.count()


# ---- export --------------------------------------------------------------------------

def test_export_in_parts_is_in_order_over_all_files(spark):
    df = A.anomalies_by_entity(TT.fact_events_from_dir(spark, SF_SMALL)).select("anomaly_date", "entity_type", "entity_id", "metric_name", "actual_value")
    order = [F.col("anomaly_date").desc(), "entity_type", "entity_id", "metric_name"]
    path = export_csv(df, scratch_path(spark, "parts"), order, parts=5)
    names = sorted(glob.glob(path.replace("file:", "") + "/part-*.csv"))
    assert len(names) == 5
    manifest = spark.read.option("header", True).csv(f"{path}_manifest").collect()
    lines, before = [], 0
    for r, name in zip(manifest, names, strict=True):
        assert name.endswith(r["file"]) and int(r["rows_before"]) == before
        rows = open(name).read().splitlines()[1:]
        assert int(r["rows"]) == len(rows)
        before += len(rows)
        lines += rows
    want = [",".join("" if v is None else str(v) for v in r) for r in df.orderBy(*order).collect()]
    assert [",".join(x.split(",")[:4]) for x in lines] == [",".join(x.split(",")[:4]) for x in want]
    assert D(lines[0].split(",")[0]) > D(lines[-1].split(",")[0])
