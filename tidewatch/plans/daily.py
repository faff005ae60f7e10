"""Runs over the store: load, one day, all days, reset, export.

Each step reads the table the previous step wrote, so lineage is cut at every
table: a lost executor costs at most the current step's tasks, and a rerun
of the same call rewrites the same partitions (idempotent).

``run_day`` touches only the partitions of its day (plus the stored day
aggregates of earlier days for the windows), so daily cost follows the size
of one day, not of the history.  ``backfill`` does all days in one pass per
step instead of a loop; because rule inputs are the run day and the calendar
day before, and anomaly frames look only backward, it yields the same rows
as running the days in order after a reset.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewatch.functions.arith import stable_bucket
from tidewatch.functions.dates import DateLike, as_date
from tidewatch.operators import anomalies as A
from tidewatch.operators import digests as DG
from tidewatch.operators import episodes as E
from tidewatch.operators import incidents as I
from tidewatch.operators import rules as R
from tidewatch.operators import series_state as SS
from tidewatch.operators import stats as ST
from tidewatch.operators.clean import clean_events, sorted_out
from tidewatch.session import materialize, scratch_path
from tidewatch.sources.publish import DayRun
from tidewatch.sources.raw_csv import read_raw_csv
from tidewatch.sources.tables import SERIES_TABLE, Store, export_csv

# Defaults of the reference's demo spike; a parameter, never applied unasked.
SPIKE_RATE = 0.20
SPIKE_SEED = "session-null-spike"


# ---- load --------------------------------------------------------------------

def load_history(store: Store, source: DataFrame, rebalance: bool = True) -> None:
    """Write cleaned, typed rows as the whole of ``fact_events_all`` (one pass, all days).

    A full load: days that an earlier load held and ``source`` lacks are gone
    afterwards.  ``append_days`` keeps them.

    Raw files usually mix days, so a plain partitioned write would leave one
    small file per task and day.  ``REBALANCE(event_date)`` clusters rows by
    day first and lets AQE size the write tasks: a small day becomes one
    file, a huge (skewed) day is split over several tasks.  It costs one
    shuffle of the loaded rows, paid once per load; pass ``rebalance=False``
    when the raw files are already cut by day (each task then writes one or
    two days anyway).
    """
    if rebalance:
        source = source.hint("rebalance", "event_date")
    store.replace("fact_events_all", source)


def append_days(store: Store, source: DataFrame) -> None:
    """Add or replace only the days present in ``source``; other days of the history stay."""
    store.overwrite_days("fact_events_all", source.hint("rebalance", "event_date"))


def load_raw_csv(store: Store, path: str, quarantine: bool = False) -> dict[str, int]:
    """Raw CSV → clean → history table; with ``quarantine`` also rejected rows → ``dq_rejected_rows``.

    Returns the counts of the quarantine (empty without it).
    """
    raw = read_raw_csv(store.spark, path)
    if quarantine:
        return load_with_quarantine(store, raw)
    load_history(store, clean_events(raw))
    return {}


def load_with_quarantine(store: Store, raw: DataFrame) -> dict[str, int]:
    """Full load that loses no row: kept rows are the history, the others ``dq_rejected_rows`` with a reason.

    The raw rows are scanned and parsed once, into a folder with a part for each kind;
    counts are observed in that scan.  A history that does not hold exactly the rows that
    were not rejected fails the load.
    """
    seen = Observation("load")
    rows = sorted_out(raw).withColumn("rejected", F.col("kept").isNull())
    rows = rows.observe(seen, F.count(F.lit(1)).alias("raw_rows"), F.count_if("rejected").alias("rejected_rows"),
                        F.count_if("unread_price").alias("unread_prices"))
    path = scratch_path(store.spark, "load")
    rows.write.partitionBy("rejected").parquet(path)
    staged = store.spark.read.schema(rows.schema).parquet(path)
    load_history(store, staged.where("NOT rejected").select("kept.*"))
    store.replace("dq_rejected_rows", staged.where("rejected").select("raw.*", "reason"))
    counts = {**seen.get, "kept_rows": store.read("fact_events_all").count()}  # from the files' footers
    if counts["kept_rows"] + counts["rejected_rows"] != counts["raw_rows"]:
        raise RuntimeError(f"rows of the load do not add up: {counts}")
    return counts


# ---- fault injection (testing the rules) ---------------------------------------

def mask_sessions(fact: DataFrame, day: DateLike, rate: float = SPIKE_RATE,
                  seed: str = SPIKE_SEED) -> DataFrame:
    """Set ``session_id`` to NULL for about ``rate`` of the rows of ``day``.

    Rows are picked by a hash of ``seed|event_id``, so reruns and task retries
    mask the same rows.
    """
    d = as_date(day)
    hit = (F.col("event_date") == F.lit(d)) & (stable_bucket(F.col("event_id"), seed) < int(round(rate * 10_000)))
    return fact.withColumn("session_id", F.when(hit, F.lit(None).cast("string")).otherwise(F.col("session_id")))


# ---- one day -------------------------------------------------------------------

def _staged_ingest(store: Store, run: DayRun, spike: tuple[DateLike, float] | None,
                   with_dups: bool) -> tuple[DataFrame, DataFrame]:
    """Stage the day's facts, their digest and aggregates; returns facts and aggregates.

    Refuses a copy that does not have the rows it was made from.
    """
    rows = store.read("fact_events_all").where(F.col("event_date") == F.lit(run.day))
    digest = run.write("dq_day_digest", DG.day_digests(rows))
    if spike is not None and as_date(spike[0]) == run.day:
        rows = mask_sessions(rows, run.day, spike[1])
    facts = run.write("fact_events", rows)
    stats = run.write("dq_day_stats", stats_for(facts, with_dups))
    copied, source = (df.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0] for df, c in ((stats, "n_events"), (digest, "n_rows")))
    if copied != source:
        raise RuntimeError(f"{run.day}: {copied} of {source} rows were copied")
    return facts, stats


def ingest_day(store: Store, day: DateLike, spike: tuple[DateLike, float] | None = None,
               with_dups: bool = False) -> None:
    """Replace the day in ``fact_events`` with the history's rows of that day.

    The day's stored aggregates follow the facts in the same step, so checks of
    later days never read aggregates of rows that are no longer there.
    """
    run = DayRun(store, as_date(day))
    _staged_ingest(store, run, spike, with_dups)
    run.publish()


def stats_for(fact: DataFrame, with_dups: bool) -> DataFrame:
    if with_dups:
        return ST.day_stats_with_dups(fact)
    return ST.day_stats(fact).withColumn("dup_groups", F.lit(None).cast("bigint"))


def needs_dups(rules: Sequence[R.Rule]) -> bool:
    return any("dup_groups" in r.needs for r in rules)


def _stored_stats(store: Store, upto: dt.date | None = None) -> DataFrame:
    stats = store.read("dq_day_stats")
    if upto is not None:
        stats = stats.where(F.col("event_date") <= F.lit(upto))
    return stats


def run_day(store: Store, day: DateLike, rules: Sequence[R.Rule] | None = None,
            spike: tuple[DateLike, float] | None = None, anomaly_incidents: bool = False,
            entities: Sequence[tuple[str, str]] = (), entity_limits: dict | None = None) -> None:
    """Ingest, aggregate, check and score one day; rerunning it is a no-op.

    The day's partitions are written beside the tables and published together, the run
    context last: a run that fails leaves the day as it was.  Incidents follow from the
    published rows.

    ``anomaly_incidents`` also opens incidents from runs of flagged KPI days.  ``entities``
    (such as ``anomalies.ENTITY_LEVELS``) also scores every entity of the day, with limits
    of their own if given.
    """
    rules = list(rules or R.default_rules())
    d = as_date(day)
    run = DayRun(store, d)
    facts, day_stats = _staged_ingest(store, run, spike, needs_dups(rules))

    stats = run.with_day("dq_day_stats", day_stats).where(F.col("event_date") <= F.lit(d))
    spine = store.spark.range(1).select(F.lit(d).alias("check_date"))
    checks = run.write("dq_check_results", R.evaluate_rules(stats, rules, spine))
    if checks.count() != len(rules):
        raise RuntimeError(f"{d}: every rule must have one result")
    scored = A.score(A.kpis_long(A.kpis_from_stats(stats))).where(F.col("anomaly_date") == F.lit(d))
    if entities:
        scored = scored.unionByName(score_entities_day(store, run, facts, entities, entity_limits))
    run.write("dq_anomalies", scored)
    run.write("dq_run_context", ST.run_context(day_stats))
    run.publish()

    open_new_incidents(store, store.read("dq_check_results").where(F.col("check_date") == F.lit(d)))
    if anomaly_incidents:
        open_anomaly_incidents(store, store.read("dq_anomalies").where(F.col("anomaly_date") <= F.lit(d)))
    reconcile_incidents(store, anomaly_incidents)


# ---- all days ------------------------------------------------------------------

def backfill(store: Store, rules: Sequence[R.Rule] | None = None,
             spike: tuple[DateLike, float] | None = None, anomaly_incidents: bool = False,
             entities: Sequence[tuple[str, str]] = (), entity_limits: dict | None = None) -> None:
    """Every day of the history in one pass per step (dynamic overwrites)."""
    rules = list(rules or R.default_rules())
    rows = store.read("fact_events_all")
    store.replace("dq_day_digest", DG.day_digests(rows))
    if spike is not None:
        rows = mask_sessions(rows, spike[0], spike[1])
    store.replace("fact_events", rows)

    store.replace("dq_day_stats", stats_for(store.read("fact_events"), needs_dups(rules)))
    store.overwrite_days("dq_check_results", R.evaluate_rules(_stored_stats(store), rules))
    scored = A.score(A.kpis_long(A.kpis_from_stats(store.read("dq_day_stats"))))
    if entities:
        scored = scored.unionByName(score_entities_all(store, store.read("fact_events"), entities, entity_limits))
    store.overwrite_days("dq_anomalies", scored)
    open_new_incidents(store, store.read("dq_check_results"))
    if anomaly_incidents:
        open_anomaly_incidents(store, store.read("dq_anomalies"))
    reconcile_incidents(store, anomaly_incidents)
    store.overwrite_days("dq_run_context", ST.run_context(store.read("dq_day_stats")))


def score_entities_all(store: Store, facts: DataFrame, entities: Sequence[tuple[str, str]],
                       limits: dict | None = None) -> DataFrame:
    """Scored rows of every entity and day of ``facts``; the stored state follows."""
    kpis = materialize(A.entity_kpis(facts, entities, include_overall=False))
    store.replace_series_state(SS.state_of(kpis, buckets=store.state_buckets))
    return A.score_kpis(kpis, thresholds=limits)


def score_entities_day(store: Store, run: DayRun, facts: DataFrame, entities: Sequence[tuple[str, str]],
                       limits: dict | None = None) -> DataFrame:
    """Scored rows of the entities of the run's day, from the stored state; the state follows.

    Reads one day of events (``facts``).  Where the state does not reach up to the day
    before, or a rerun goes further back than it does, the daily table is scored as a
    whole.  The state is a cache of the facts: a run that fails after this step finds
    the day in it and replaces it.
    """
    state, today = store.read(SERIES_TABLE), F.lit(run.day)
    before = store.read("dq_day_stats").where(F.col("event_date") < today).agg(F.max("event_date")).first()[0]
    upto = state.agg(F.max("last_day")).first()[0]
    if (before is not None and (upto is None or upto < before)) or not SS.can_score(state, run.day):
        whole = run.with_day("fact_events", facts)
        return score_entities_all(store, whole, entities, limits).where(F.col("anomaly_date") == today)
    kpis = materialize(A.entity_kpis(facts, entities, include_overall=False))
    scored = materialize(SS.score_day(state, kpis, run.day, limits))
    store.replace_series_state(SS.advanced(state, kpis, run.day))
    return scored


def reset_replay(store: Store) -> None:
    """Empty the daily fact table and its stored aggregates (history is untouched)."""
    store.truncate("fact_events")
    store.truncate("dq_day_stats")
    store.truncate("dq_day_digest")
    store.replace_series_state(store.spark.createDataFrame([], SS.SERIES_STATE))


# ---- late data -------------------------------------------------------------------

def recompute(store: Store, rules: Sequence[R.Rule] | None = None, anomaly_incidents: bool = False,
              entities: Sequence[tuple[str, str]] = (), entity_limits: dict | None = None) -> dict[str, list[dt.date]]:
    """Bring the store up to a history that changed, touching only what depends on the change.

    Days whose rows differ from what was ingested are found by their digests (one scan
    of the history, one small row per day and task).  Those days are ingested again; days
    that read them through a rule (the calendar day after) or through a frame (the next
    14 rows) get new check and anomaly rows; partitions of all other days keep their
    files.  The result is that of a full ``backfill``.  With ``entities`` every scored day
    from the first changed one on is written anew: frames count an entity's own rows, so
    a change may reach any later day.  Returns the days of each kind;
    lists of days come to the driver, never rows.
    """
    rules = list(rules or R.default_rules())
    history = store.read("fact_events_all")
    digests = materialize(DG.day_digests(history))
    found = DG.changed_days(digests, store.read("dq_day_digest")).collect()
    changed, gone = sorted(r["event_date"] for r in found), sorted(r["event_date"] for r in found if not r["here"])
    here = [d for d in changed if d not in gone]
    if not changed:
        return {"changed": [], "checked": [], "scored": []}

    for table in ("fact_events", "dq_day_stats", "dq_check_results", "dq_anomalies", "dq_run_context"):
        store.clear_days(table, gone)
    if here:
        on_days = F.col("event_date").isin(here)
        store.overwrite_days("fact_events", history.where(on_days))
        store.overwrite_days("dq_day_stats", stats_for(store.read("fact_events").where(on_days), needs_dups(rules)))
        store.overwrite_days("dq_run_context", ST.run_context(store.read("dq_day_stats").where(on_days)))

    present = [r[0] for r in store.read("dq_day_stats").select("event_date").distinct().collect()]
    checked = DG.days_checked(changed, present, any("latest_event_ts" in r.needs for r in rules))
    scored = [d for d in sorted(present) if d >= changed[0]] if entities else DG.days_scored(changed, present, A.BASELINE_ROWS)
    if checked:
        results = R.evaluate_rules(_stored_stats(store), rules).where(F.col("check_date").isin(checked))
        store.overwrite_days("dq_check_results", results)
    if scored:
        rows = A.score(A.kpis_long(A.kpis_from_stats(store.read("dq_day_stats"))))
        if entities:
            rows = rows.unionByName(score_entities_all(store, store.read("fact_events"), entities, entity_limits))
        store.overwrite_days("dq_anomalies", rows.where(F.col("anomaly_date").isin(scored)))
    open_new_incidents(store, store.read("dq_check_results").where(F.col("check_date").isin(checked)))
    if anomaly_incidents:
        open_anomaly_incidents(store, store.read("dq_anomalies"))
    reconcile_incidents(store, anomaly_incidents)
    store.clear_days("dq_day_digest", gone)  # last: a run that stopped before finds the change again
    if here:
        store.overwrite_days("dq_day_digest", digests.where(F.col("event_date").isin(here)))
    return {"changed": changed, "checked": checked, "scored": scored}


def audit_load(store: Store) -> DataFrame:
    """Days of the daily table against the history: ok, missing, foreign, doubled, partial or mixed."""
    return DG.load_audit(store.read("fact_events_all"), store.read("fact_events"))


# ---- incidents -------------------------------------------------------------------

def _record(store: Store, candidates: DataFrame, note: str) -> None:
    """Append candidates whose id is new, and the OPEN log rows that recorded incidents lack."""
    store.append("dq_incidents", I.new_incidents(candidates, store.read("dq_incidents")))
    opened = store.read("dq_incidents").join(
        store.read("dq_incident_status_log").select("incident_id"), "incident_id", "left_anti")
    store.append("dq_incident_status_log", opened.select(
        "incident_id", F.lit("OPEN").alias("status"), F.col("opened_at").alias("changed_at"), F.lit(note).alias("note")))


def open_new_incidents(store: Store, checks: DataFrame) -> None:
    """Record incidents for failing checks whose id is new, plus their OPEN log rows."""
    _record(store, I.open_incidents(store.spark, checks), "opened by failing check")


def open_anomaly_incidents(store: Store, scored: DataFrame) -> None:
    """Record one incident per run of flagged days whose id is new, plus its OPEN log row."""
    _record(store, E.anomaly_incidents(E.anomaly_episodes(scored)), "opened by flagged KPI")


def reconcile_incidents(store: Store, anomalies: bool = False) -> None:
    """Hold the log against the current check rows (and anomalies): close, and take closings back."""
    sources = [("check", E.check_closings(store.read("dq_check_results")))]
    if anomalies:
        sources.append(("anomaly", E.anomaly_closings(store.read("dq_anomalies"))))
    for origin, closings in sources:
        rows = E.reconcile(store.read("dq_incidents"), store.read("dq_incident_status_log"), closings, origin)
        store.append("dq_incident_status_log", materialize(rows))


def record_status(store: Store, changes: DataFrame) -> None:
    """Append manual status changes (incident_id, status, changed_at, note); ids and statuses are checked."""
    store.append("dq_incident_status_log", I.checked_changes(changes, store.read("dq_incidents")))


def log_incident(store: Store, rows: DataFrame) -> None:
    """Record incidents by hand, with their first status row; ids and domains are checked."""
    fresh = materialize(I.checked_manual(rows, store.read("dq_incidents")))
    store.append("dq_incidents", fresh)
    store.append("dq_incident_status_log", fresh.select(
        "incident_id", "status", F.col("opened_at").alias("changed_at"), F.lit("logged by hand").alias("note")))


def incidents_now(store: Store) -> DataFrame:
    return I.current_state(store.read("dq_incidents"), store.read("dq_incident_status_log"))


# ---- exports ---------------------------------------------------------------------

def export_reports(store: Store, out_dir: str, anomaly_parts: int = 0) -> dict[str, str]:
    """health_daily, check_results_with_incidents, incidents, anomalies as CSV.

    ``anomaly_parts``: write the anomalies as that many ordered files (entities make many rows).
    """
    from tidewatch.operators import reports as V

    checks = store.read("dq_check_results")
    incidents = incidents_now(store)
    out = out_dir.rstrip("/")
    return {
        "health_daily": export_csv(V.health_daily(checks), f"{out}/health_daily", ["check_date"]),
        "check_results_with_incidents": export_csv(
            V.checks_with_incidents(checks, incidents), f"{out}/check_results_with_incidents",
            ["check_date", "severity", "status", "check_name"]),
        "incidents": export_csv(incidents, f"{out}/incidents",
                                [F.col("opened_at").desc(), "incident_id"]),
        "anomalies": export_csv(store.read("dq_anomalies"), f"{out}/anomalies",
                                ["anomaly_date", "entity_type", "entity_id", "metric_name"], parts=anomaly_parts),
    }
