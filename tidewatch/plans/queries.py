"""Named queries over the test tables, one per inventory item.

Each query takes ``(spark, sf_dir)``, reads the given tables (whole) and
returns a DataFrame whose column names match the SQL oracle in
``tidewatch.plans.oracle``.  Doubles are rounded to 6 decimals at the very end
so the comparison does not hinge on the summation order of two engines;
``created_at`` stamps are left out (they are wall-clock values).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas
from tidewatch.functions.arith import guarded_ratio, pct_change
from tidewatch.functions.cleaning import (
    blank_to_null,
    event_id_md5,
    normalize_event_type,
    parse_event_ts,
    safe_price_cast,
)
from tidewatch.functions.dates import on_days, run_params
from tidewatch.operators import anomalies as A
from tidewatch.operators import digests as DG
from tidewatch.operators import episodes as E
from tidewatch.operators import incidents as I
from tidewatch.operators import reports as V
from tidewatch.operators import rules as R
from tidewatch.operators import stats as ST
from tidewatch.operators.clean import clean_events, distinct_event_dates, load_counts
from tidewatch.plans import daily
from tidewatch.session import materialize, scratch_path
from tidewatch.sources import test_tables as TT
from tidewatch.sources.raw_csv import read_raw_csv, write_raw_csv
from tidewatch.sources.tables import Store, export_csv, read_csv_extract

# Parameters of the registered queries (fixed; the data spans 2024-01-01..30).
RUN_DATE = dt.date(2024, 1, 15)
SPIKE_DAY = dt.date(2024, 1, 18)
VOLUME_MIN_MIX = 330  # gives both PASS and FAIL on the sf0.01 tables
VOLUME_MIN_DIRTY = 260  # the same on the careless events
WARN_BELOW = 280  # fewer events of a careless day warn, below VOLUME_MIN_DIRTY they fail
WARN_NULL_PCT = 10.0
MANUAL_ID = f"INC-{RUN_DATE.isoformat()}-BY-HAND"
COARSE_DUP_KEY = ("user_id", "event_type")
DETAIL_CHECK = "null_rate_session_id_run_date"
TOP_N = 10
DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.selectExpr(*[
        f"round(`{f.name}`, {digits}) AS `{f.name}`" if isinstance(f.dataType, T.DoubleType)
        else f"`{f.name}`"
        for f in df.schema.fields
    ])


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        REGISTRY[name].__doc__ = fn.__doc__
        return fn
    return deco


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TT.fact_events_from_dir(spark, sf_dir)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TT.raw_events_from_dir(spark, sf_dir)


def _finished(store: Store, result: DataFrame) -> DataFrame:
    """The result of a query that made a store for itself; the store is dropped."""
    out = materialize(result)
    store.drop()
    return out


def _no_created(df: DataFrame) -> DataFrame:
    return df.drop("created_at")


def checks_default(spark, sf_dir) -> DataFrame:
    return R.checks_all_days(fact(spark, sf_dir))


def shared_checks(spark, sf_dir) -> DataFrame:
    """The default checks computed once, for queries that read them in several
    branches (column pruning differs per branch, so Spark would not reuse the
    exchange and would scan the events once per branch)."""
    return materialize(checks_default(spark, sf_dir))


def incidents_and_log(spark, checks: DataFrame) -> tuple[DataFrame, DataFrame]:
    return I.incidents_for_checks(spark, checks)


def incidents_current(spark, checks: DataFrame) -> DataFrame:
    inc, log = incidents_and_log(spark, checks)
    return I.current_state(inc, log)


# ---- sources, loading, cleaning ----------------------------------------------

@query("load_csv_events")
def q_load_csv_events(spark, sf_dir):
    """Raw event text written as header CSV, read back with the all-text schema."""
    path = scratch_path(spark, "raw-csv")
    write_raw_csv(raw(spark, sf_dir), path)
    return read_raw_csv(spark, path)


@query("clean_events")
def q_clean_events(spark, sf_dir):
    """Raw text → typed, keyed rows (parse, trim, lower, try-cast, MD5 key)."""
    return clean_events(raw(spark, sf_dir))


@query("dirty_clean_events")
def q_dirty_clean_events(spark, sf_dir):
    """Careless raw text → typed rows: every cleaning branch fires."""
    return clean_events(TT.dirty_events_from_dir(spark, sf_dir))


@query("dirty_quarantine")
def q_dirty_quarantine(spark, sf_dir):
    """Rows that a load of careless CSV rejects, with the reason, as the store keeps them."""
    path = scratch_path(spark, "dirty-csv")
    write_raw_csv(TT.dirty_events_from_dir(spark, sf_dir), path)
    store = Store.scratch(spark, "quarantine")
    daily.load_raw_csv(store, path, quarantine=True)
    return _finished(store, store.read("dq_rejected_rows"))


@query("dirty_load_counts")
def q_dirty_load_counts(spark, sf_dir):
    return load_counts(TT.dirty_events_from_dir(spark, sf_dir))


def _warning_rules() -> list[R.Rule]:
    return [R.freshness_has_events(), R.volume_prev_day(WARN_BELOW, fail_below=VOLUME_MIN_DIRTY),
            R.null_rate_session(1.0, fail_above=WARN_NULL_PCT), R.purchases_run_date()]


@query("dirty_dq_checks")
def q_dirty_dq_checks(spark, sf_dir):
    """Eight rules over events with duplicates, a missing day, a day that ends early and one without purchases."""
    rules = [R.freshness_has_events(), R.volume_prev_day(VOLUME_MIN_DIRTY), R.purchases_prev_day(), R.null_rate_session(),
             R.dup_composite_key(), R.purchases_run_date(), R.latest_event_in_day(), R.latest_event_24h()]
    return R.checks_all_days(clean_events(TT.dirty_events_from_dir(spark, sf_dir)), rules)


@query("dirty_checks_every_day")
def q_dirty_checks_every_day(spark, sf_dir):
    """Rules that warn, for every calendar day of the careless events: also the one without any event."""
    events = materialize(clean_events(TT.dirty_events_from_dir(spark, sf_dir)))
    first, last = events.agg(F.min("event_date"), F.max("event_date")).first()
    return R.checks_for_days(spark, events, first, last, _warning_rules())


@query("dirty_warn_trend")
def q_dirty_warn_trend(spark, sf_dir):
    """Failing and warning checks a day, with rules that warn."""
    return V.fail_warn_trend(R.checks_all_days(clean_events(TT.dirty_events_from_dir(spark, sf_dir)), _warning_rules()))


@query("dirty_anomalies")
def q_dirty_anomalies(spark, sf_dir):
    return A.anomalies_all_days(clean_events(TT.dirty_events_from_dir(spark, sf_dir)))


@query("blank_to_null")
def q_blank_to_null(spark, sf_dir):
    r = raw(spark, sf_dir)
    return r.select(event_id_md5("user_id", "user_session", "event_time", "event_type",
                                 "product_id", "price").alias("event_id"),
                    blank_to_null("brand").alias("brand"),
                    blank_to_null("category_code").alias("category_code"))


@query("normalize_event_type")
def q_normalize_event_type(spark, sf_dir):
    r = raw(spark, sf_dir)
    return r.groupBy(normalize_event_type("event_type").alias("event_type")).agg(
        F.count(F.lit(1)).alias("rows"))


@query("parse_event_ts")
def q_parse_event_ts(spark, sf_dir):
    r = raw(spark, sf_dir)
    return r.select(F.col("event_time"), parse_event_ts("event_time").alias("event_ts"))


@query("safe_price_cast")
def q_safe_price_cast(spark, sf_dir):
    r = raw(spark, sf_dir)
    return r.select(F.col("price").alias("price_text"), safe_price_cast("price").alias("price"))


@query("event_id_md5")
def q_event_id_md5(spark, sf_dir):
    return fact(spark, sf_dir).select("event_id", "user_id", "session_id", "event_ts")


@query("run_params")
def q_run_params(spark, sf_dir):
    """(run_date, prev_date) for every day the runner would visit."""
    d = distinct_event_dates(fact(spark, sf_dir))
    return d.select(F.col("d").alias("run_date"), F.date_sub("d", 1).alias("prev_date"))


@query("distinct_event_dates")
def q_distinct_event_dates(spark, sf_dir):
    return distinct_event_dates(fact(spark, sf_dir))


@query("events_on_run_date")
def q_events_on_run_date(spark, sf_dir):
    return on_days(fact(spark, sf_dir), RUN_DATE)


@query("guarded_ratio")
def q_guarded_ratio(spark, sf_dir):
    """Share of session-less rows per day and event type, NULL-safe."""
    f = fact(spark, sf_dir)
    return f.groupBy("event_date", "event_type").agg(
        guarded_ratio(F.count_if(F.col("session_id").isNull()), F.count(F.lit(1))).alias("null_share"))


# ---- replay and table writes ------------------------------------------------------

def _store_with_history(spark, sf_dir, label) -> Store:
    store = Store.scratch(spark, label)
    daily.load_history(store, fact(spark, sf_dir))
    return store


@query("replay_day_join")
def q_replay_day_join(spark, sf_dir):
    """History rows of run_date through an equi-join with the one-row params."""
    f = fact(spark, sf_dir)
    p = F.broadcast(run_params(spark, RUN_DATE))  # one row
    return f.join(p, f["event_date"] == p["run_date"]).select(*f.columns)


@query("rows_loaded_for_day")
def q_rows_loaded_for_day(spark, sf_dir):
    f = fact(spark, sf_dir)
    p = F.broadcast(run_params(spark, RUN_DATE))
    return (f.join(p, f["event_date"] == p["run_date"]).groupBy("run_date")
            .agg(F.count(F.lit(1)).alias("rows_loaded_for_day")))


@query("ingest_day_idempotent")
def q_ingest_day_idempotent(spark, sf_dir):
    """Ingest run_date twice into the daily table; it holds the day once."""
    store = _store_with_history(spark, sf_dir, "ingest")
    daily.ingest_day(store, RUN_DATE)
    daily.ingest_day(store, RUN_DATE)
    return _finished(store, store.read("fact_events"))


@query("backfill_all_days")
def q_backfill_all_days(spark, sf_dir):
    """All days in one pass, twice; the daily table equals the history."""
    store = _store_with_history(spark, sf_dir, "backfill")
    daily.backfill(store)
    daily.backfill(store)
    return _finished(store, store.read("fact_events"))


@query("reset_then_ingest")
def q_reset_then_ingest(spark, sf_dir):
    store = _store_with_history(spark, sf_dir, "reset")
    daily.backfill(store)
    daily.reset_replay(store)
    daily.ingest_day(store, RUN_DATE)
    return _finished(store, store.read("fact_events"))


@query("reset_then_run_day")
def q_reset_then_run_day(spark, sf_dir):
    """After a reset the store knows one day only: its checks see no earlier day."""
    store = _store_with_history(spark, sf_dir, "resetrun")
    daily.backfill(store)
    daily.reset_replay(store)
    daily.run_day(store, RUN_DATE)
    return _finished(store, _no_created(store.read("dq_check_results").where(F.col("check_date") == F.lit(RUN_DATE))))


@query("reload_replaces_history")
def q_reload_replaces_history(spark, sf_dir):
    """A second full load that starts at run_date leaves no earlier day behind."""
    store = _store_with_history(spark, sf_dir, "reload")
    daily.load_history(store, fact(spark, sf_dir).where(F.col("event_date") >= F.lit(RUN_DATE)))
    return _finished(store, store.read("fact_events_all"))


@query("store_incident_state")
def q_store_incident_state(spark, sf_dir):
    """Incidents as the store has them after two backfills: opened, and resolved where checks pass again."""
    store = _store_with_history(spark, sf_dir, "incidents")
    daily.backfill(store)
    daily.backfill(store)
    return _finished(store, daily.incidents_now(store))


def _replay_rules() -> list[R.Rule]:
    """A rule that the replay breaks, and one kind with two limits side by side."""
    return [R.purchases_run_date(), R.volume_prev_day(VOLUME_MIN_MIX), R.volume_prev_day(VOLUME_MIN_DIRTY)]


def _without_purchases(events: DataFrame, *days: dt.date) -> DataFrame:
    hit = F.col("event_date").isin(*days) & (F.col("event_type") == F.lit("purchase"))
    return events.withColumn("event_type", F.when(hit, F.lit("view")).otherwise(F.col("event_type")))


@query("store_incident_replay")
def q_store_incident_replay(spark, sf_dir):
    """Two days fail, both are repaired, one fails again together with the next: the state follows the data."""
    events, rules = materialize(fact(spark, sf_dir)), _replay_rules()
    store = Store.scratch(spark, "replay")
    early, again = RUN_DATE - dt.timedelta(days=3), RUN_DATE + dt.timedelta(days=1)
    daily.load_history(store, _without_purchases(events, early, RUN_DATE))
    daily.backfill(store, rules)
    daily.append_days(store, events.where(F.col("event_date").isin(early, RUN_DATE)))
    for day in (early, RUN_DATE):
        daily.run_day(store, day, rules)
    daily.append_days(store, _without_purchases(events, RUN_DATE, again).where(F.col("event_date").isin(RUN_DATE, again)))
    for day in (RUN_DATE, again, again):
        daily.run_day(store, day, rules)
    return _finished(store, daily.incidents_now(store))


@query("store_manual_incidents")
def q_store_manual_incidents(spark, sf_dir):
    """An incident logged by hand and changes by hand, on top of the log that runs have written."""
    store = _store_with_history(spark, sf_dir, "manual")
    daily.backfill(store)
    at = dt.datetime.combine(RUN_DATE, dt.time(9))
    daily.log_incident(store, spark.createDataFrame(
        [(MANUAL_ID, at, "P1", "Seen by hand.")], "incident_id string, opened_at timestamp, severity string, summary string"))
    later = [(MANUAL_ID, "TRIAGING", 1), (MANUAL_ID, "RESOLVED", 3)]
    changes = spark.createDataFrame([(i, s, at + dt.timedelta(days=n), "by hand") for i, s, n in later], schemas.INCIDENT_STATUS_LOG)
    still_open = daily.incidents_now(store).where(f"status = 'OPEN' AND incident_id <> '{MANUAL_ID}'").selectExpr(
        "incident_id", "'MITIGATED' AS status", "opened_at + INTERVAL 60 DAY AS changed_at", "'by hand' AS note")
    daily.record_status(store, materialize(changes.unionByName(still_open)))
    daily.backfill(store)  # changes by hand stay
    return _finished(store, daily.incidents_now(store))


@query("store_anomaly_incidents")
def q_store_anomaly_incidents(spark, sf_dir):
    """Incidents from runs of flagged days, after two backfills and a rerun of a day."""
    store = Store.scratch(spark, "flagged")
    daily.load_history(store, clean_events(TT.dirty_events_from_dir(spark, sf_dir)))
    daily.backfill(store, anomaly_incidents=True)
    daily.run_day(store, RUN_DATE, anomaly_incidents=True)
    daily.backfill(store, anomaly_incidents=True)
    return _finished(store, daily.incidents_now(store).where("detected_by LIKE 'anomaly/%'"))


LATE_DAY, LOST_DAY = RUN_DATE + dt.timedelta(days=4), RUN_DATE + dt.timedelta(days=9)


def _recomputed_store(spark, sf_dir, rules=None) -> Store:
    """A day first loaded in part, one not at all, one with rows that are taken back later; then recomputed."""
    events = materialize(fact(spark, sf_dir))
    store = Store.scratch(spark, "late")
    day = F.col("event_date")
    early = events.where(~((day == F.lit(RUN_DATE)) & (F.col("price") < 50.0)) & (day != F.lit(LATE_DAY)))
    again = events.where(day == F.lit(LOST_DAY))
    daily.load_history(store, early.unionByName(again))
    daily.backfill(store, rules)
    daily.append_days(store, events.where(day.isin(RUN_DATE, LATE_DAY, LOST_DAY)))
    daily.recompute(store, rules)
    daily.recompute(store, rules)  # nothing changed since
    return store


@query("late_data_anomalies")
def q_late_data_anomalies(spark, sf_dir):
    """Anomalies after late data: the rows a full backfill gives."""
    store = _recomputed_store(spark, sf_dir)
    return _finished(store, _no_created(store.read("dq_anomalies")))


@query("late_data_checks")
def q_late_data_checks(spark, sf_dir):
    """Checks after late data, the duplicate rule and the running newest event among them."""
    rules = R.default_rules() + [R.dup_composite_key(), R.latest_event_24h()]
    store = _recomputed_store(spark, sf_dir, rules)
    return _finished(store, _no_created(store.read("dq_check_results")))


@query("load_audit")
def q_load_audit(spark, sf_dir):
    """Daily table against history, with days loaded twice, three times, in part, with foreign rows, or not at all."""
    events = fact(spark, sf_dir)
    n = F.dayofmonth("event_date")
    copies = F.expr("CASE dayofmonth(event_date) WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN if(price < 50, 1, 0) WHEN 6 THEN 0 "
                    "WHEN 8 THEN if(price < 50, 0, 2) ELSE 1 END")
    loaded = events.withColumn("copies", copies).select("*", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("copy"))
    loaded = loaded.where("copy <= copies").drop("copy", "copies")
    loaded = loaded.withColumn("brand", F.when((n == 7) & (F.col("price") < 50.0), F.lit("other")).otherwise(F.col("brand")))
    return DG.load_audit(events.where(n != 9), loaded)


@query("rerun_checks_idempotent")
def q_rerun_checks_idempotent(spark, sf_dir):
    store = _store_with_history(spark, sf_dir, "checks")
    daily.backfill(store)
    daily.run_day(store, RUN_DATE)
    daily.backfill(store)
    return _finished(store, _no_created(store.read("dq_check_results")))


@query("rerun_anomalies_idempotent")
def q_rerun_anomalies_idempotent(spark, sf_dir):
    store = _store_with_history(spark, sf_dir, "anomalies")
    daily.backfill(store)
    daily.run_day(store, RUN_DATE)
    daily.run_day(store, RUN_DATE)
    return _finished(store, _no_created(store.read("dq_anomalies")))


@query("rerun_entity_anomalies_idempotent")
def q_rerun_entity_anomalies_idempotent(spark, sf_dir):
    """Overall and entity anomalies as the store has them: all days but two at once, two from the stored state, both again."""
    events = materialize(fact(spark, sf_dir))
    last = events.agg(F.max("event_date")).first()[0]
    days = [last - dt.timedelta(days=1), last]
    store = Store.scratch(spark, "entities")
    daily.load_history(store, events.where(F.col("event_date") < F.lit(days[0])))
    daily.backfill(store, entities=A.ENTITY_LEVELS)
    daily.append_days(store, events.where(F.col("event_date").isin(days)))
    for day in (*days, *days):
        daily.run_day(store, day, entities=A.ENTITY_LEVELS)
    return _finished(store, _no_created(store.read("dq_anomalies")))


@query("replay_progress")
def q_replay_progress(spark, sf_dir):
    return ST.replay_progress(fact(spark, sf_dir))


@query("null_spike_masked_rate")
def q_null_spike_masked_rate(spark, sf_dir):
    """Session ids masked on one day (20 %, hash-picked rows); null rate per day."""
    f = daily.mask_sessions(fact(spark, sf_dir), SPIKE_DAY, daily.SPIKE_RATE)
    s = ST.day_stats(f)
    return s.select("event_date", "n_events", "n_null_session",
                    (F.lit(100.0) * guarded_ratio(F.col("n_null_session"), F.col("n_events")))
                    .alias("null_pct"))


# ---- aggregates, windows ----------------------------------------------------------

@query("daily_kpis")
def q_daily_kpis(spark, sf_dir):
    return A.daily_kpis(fact(spark, sf_dir)).select("d", "events_count", "purchases", "revenue")


@query("daily_cvr")
def q_daily_cvr(spark, sf_dir):
    return A.daily_kpis(fact(spark, sf_dir)).select("d", "purchases", "events_count", "cvr")


@query("kpis_long")
def q_kpis_long(spark, sf_dir):
    return A.kpis_long(A.daily_kpis(fact(spark, sf_dir)))


@query("rolling_baseline_14")
def q_rolling_baseline_14(spark, sf_dir):
    b = A.baselines(A.kpis_long(A.daily_kpis(fact(spark, sf_dir))))
    return b.select("anomaly_date", "metric_name", "actual_value", "baseline_value", "baseline_sd")


@query("day_over_day_change")
def q_day_over_day_change(spark, sf_dir):
    b = A.baselines(A.kpis_long(A.daily_kpis(fact(spark, sf_dir))))
    return b.select("anomaly_date", "metric_name", "actual_value", "prev_value",
                    pct_change(F.col("actual_value"), F.col("prev_value")).alias("pct_change"))


@query("rolling_median_14")
def q_rolling_median_14(spark, sf_dir):
    m = A.rolling_median(A.kpis_long(A.daily_kpis(fact(spark, sf_dir))))
    return m.select("anomaly_date", "metric_name", "actual_value", "baseline_median")


@query("anomaly_zscore")
def q_anomaly_zscore(spark, sf_dir):
    s = A.anomalies_all_days(fact(spark, sf_dir))
    return s.select("anomaly_date", "metric_name", "z_score")


def _metric(spark, sf_dir, metric):
    return A.anomalies_all_days(fact(spark, sf_dir)).where(F.col("metric_name") == metric)


@query("anomaly_events_count")
def q_anomaly_events_count(spark, sf_dir):
    return _metric(spark, sf_dir, "events_count")


@query("anomaly_revenue")
def q_anomaly_revenue(spark, sf_dir):
    return _metric(spark, sf_dir, "revenue")


@query("anomaly_cvr")
def q_anomaly_cvr(spark, sf_dir):
    return _metric(spark, sf_dir, "cvr")


@query("anomalies_for_run_date")
def q_anomalies_for_run_date(spark, sf_dir):
    return A.anomalies_for_run_date(fact(spark, sf_dir), RUN_DATE)


@query("anomalies_all_days")
def q_anomalies_all_days(spark, sf_dir):
    return A.anomalies_all_days(fact(spark, sf_dir))


@query("anomalies_latest_day")
def q_anomalies_latest_day(spark, sf_dir):
    return A.anomalies_latest_day(fact(spark, sf_dir))


@query("anomalies_by_entity")
def q_anomalies_by_entity(spark, sf_dir):
    return A.anomalies_by_entity(fact(spark, sf_dir))


@query("anomalies_by_entity_zero_days")
def q_anomalies_by_entity_zero_days(spark, sf_dir):
    """Entity anomalies with days without events as zeros between an entity's first and last day."""
    return A.anomalies_by_entity(fact(spark, sf_dir), zero_days=True)


@query("anomalies_robust")
def q_anomalies_robust(spark, sf_dir):
    """Overall and entity KPIs against median and median absolute deviation."""
    return A.score_robust(A.kpis_long(A.entity_kpis(fact(spark, sf_dir)), None, "entity_id"))


# ---- rules ---------------------------------------------------------------------

def _rule_all_days(spark, sf_dir, rule: R.Rule) -> DataFrame:
    return R.checks_all_days(fact(spark, sf_dir), [rule])


@query("check_freshness")
def q_check_freshness(spark, sf_dir):
    return _rule_all_days(spark, sf_dir, R.freshness_has_events())


@query("check_volume_prev_day")
def q_check_volume_prev_day(spark, sf_dir):
    return _rule_all_days(spark, sf_dir, R.volume_prev_day(VOLUME_MIN_MIX))


@query("check_purchase_prev_day")
def q_check_purchase_prev_day(spark, sf_dir):
    return _rule_all_days(spark, sf_dir, R.purchases_prev_day())


@query("check_null_rate")
def q_check_null_rate(spark, sf_dir):
    return _rule_all_days(spark, sf_dir, R.null_rate_session())


@query("check_dup_composite_key")
def q_check_dup_composite_key(spark, sf_dir):
    return _rule_all_days(spark, sf_dir, R.dup_composite_key())


@query("check_dup_coarse_key")
def q_check_dup_coarse_key(spark, sf_dir):
    """The duplicate rule on a coarse key (user, event type per day): finds groups."""
    f = fact(spark, sf_dir)
    rules = [R.dup_composite_key()]
    return R.evaluate_rules(R.rule_stats(f, rules, dup_key=COARSE_DUP_KEY), rules)


@query("check_purchase_run_date")
def q_check_purchase_run_date(spark, sf_dir):
    return _rule_all_days(spark, sf_dir, R.purchases_run_date())


@query("check_latest_event_in_day")
def q_check_latest_event_in_day(spark, sf_dir):
    return _rule_all_days(spark, sf_dir, R.latest_event_in_day())


@query("check_latest_event_24h")
def q_check_latest_event_24h(spark, sf_dir):
    return _rule_all_days(spark, sf_dir, R.latest_event_24h())


@query("dq_checks_for_run_date")
def q_dq_checks_for_run_date(spark, sf_dir):
    return R.checks_for_run_date(spark, fact(spark, sf_dir), RUN_DATE)


@query("dq_checks_all_days")
def q_dq_checks_all_days(spark, sf_dir):
    return checks_default(spark, sf_dir)


@query("run_context")
def q_run_context(spark, sf_dir):
    return ST.run_context(ST.day_stats(fact(spark, sf_dir)))


# ---- incidents -------------------------------------------------------------------

@query("incidents_auto_open")
def q_incidents_auto_open(spark, sf_dir):
    inc, _ = incidents_and_log(spark, checks_default(spark, sf_dir))
    return inc


@query("incident_log_append")
def q_incident_log_append(spark, sf_dir):
    """OPEN rows and automatic RESOLVED rows appended to an empty status log."""
    _, log = incidents_and_log(spark, checks_default(spark, sf_dir))
    empty = spark.createDataFrame([], schemas.INCIDENT_STATUS_LOG)
    return I.append_status(empty, log)


@query("incident_current_state")
def q_incident_current_state(spark, sf_dir):
    return incidents_current(spark, shared_checks(spark, sf_dir))


@query("incident_queue")
def q_incident_queue(spark, sf_dir):
    return I.incident_queue(incidents_current(spark, shared_checks(spark, sf_dir)))


@query("incident_related_failing_checks")
def q_incident_related_failing_checks(spark, sf_dir):
    checks = shared_checks(spark, sf_dir)
    inc, _ = incidents_and_log(spark, checks)
    return I.related_failing_checks(inc, checks)


@query("check_episodes")
def q_check_episodes(spark, sf_dir):
    """Runs of failing days of the default rules on the careless events."""
    rules = R.default_rules(volume_min_rows=VOLUME_MIN_DIRTY) + [R.purchases_run_date(), R.dup_composite_key()]
    return E.check_episodes(R.checks_all_days(clean_events(TT.dirty_events_from_dir(spark, sf_dir)), rules))


@query("anomaly_episodes")
def q_anomaly_episodes(spark, sf_dir):
    """Runs of flagged days of every series, days up to two apart merged."""
    return E.anomaly_episodes(A.anomalies_by_entity(fact(spark, sf_dir)), max_gap_days=2)


# ---- reports ---------------------------------------------------------------------

@query("health_daily")
def q_health_daily(spark, sf_dir):
    return V.health_daily(checks_default(spark, sf_dir))


@query("checks_with_incidents")
def q_checks_with_incidents(spark, sf_dir):
    checks = shared_checks(spark, sf_dir)
    return V.checks_with_incidents(checks, incidents_current(spark, checks))


@query("fail_warn_trend")
def q_fail_warn_trend(spark, sf_dir):
    return V.fail_warn_trend(checks_default(spark, sf_dir))


@query("check_detail_trend")
def q_check_detail_trend(spark, sf_dir):
    return V.check_detail_trend(checks_default(spark, sf_dir), DETAIL_CHECK)


@query("root_cause_counts")
def q_root_cause_counts(spark, sf_dir):
    return V.root_cause_counts(incidents_current(spark, shared_checks(spark, sf_dir)))


@query("root_cause_pareto")
def q_root_cause_pareto(spark, sf_dir):
    return V.root_cause_pareto(incidents_current(spark, shared_checks(spark, sf_dir)))


@query("top_failing_checks")
def q_top_failing_checks(spark, sf_dir):
    return V.top_failing_checks(checks_default(spark, sf_dir), TOP_N)


# ---- CSV extracts (written, then read back) -----------------------------------------

def _extract(spark, df, label, order, schema) -> DataFrame:
    path = scratch_path(spark, label)
    export_csv(df, path, order)
    return read_csv_extract(spark, path, schema)


@query("export_health_csv")
def q_export_health_csv(spark, sf_dir):
    return _extract(spark, V.health_daily(checks_default(spark, sf_dir)), "health",
                    ["check_date"], schemas.HEALTH_DAILY)


@query("export_checks_csv")
def q_export_checks_csv(spark, sf_dir):
    checks = shared_checks(spark, sf_dir)
    df = V.checks_with_incidents(checks, incidents_current(spark, checks))
    schema = T.StructType([f for f in schemas.CHECK_RESULTS.fields if f.name != "created_at"] + [
        T.StructField(c, T.TimestampType() if c == "incident_opened_at" else T.StringType(), True)
        for c in V.INCIDENT_COLUMNS])
    return _extract(spark, df, "checks", ["check_date", "severity", "status", "check_name"], schema)


@query("export_incidents_csv")
def q_export_incidents_csv(spark, sf_dir):
    return _extract(spark, incidents_current(spark, shared_checks(spark, sf_dir)), "incidents",
                    [F.col("opened_at").desc(), "incident_id"], schemas.INCIDENTS)


@query("export_entity_anomalies_csv")
def q_export_entity_anomalies_csv(spark, sf_dir):
    """Entity anomalies written as eight ordered files, read back."""
    path = scratch_path(spark, "entity-anomalies")
    export_csv(A.anomalies_by_entity(fact(spark, sf_dir)), path, ["anomaly_date", "entity_type", "entity_id", "metric_name"], parts=8)
    return read_csv_extract(spark, path, T.StructType([f for f in schemas.ANOMALIES.fields if f.name != "created_at"]))


@query("export_anomalies_csv")
def q_export_anomalies_csv(spark, sf_dir):
    df = A.anomalies_all_days(fact(spark, sf_dir))
    schema = T.StructType([f for f in schemas.ANOMALIES.fields if f.name != "created_at"])
    return _extract(spark, df, "anomalies", ["anomaly_date", "metric_name"], schema)


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
