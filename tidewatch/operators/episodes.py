"""Episodes: runs of failing checks, runs of flagged KPI days, and the incident log held against them.

The check and anomaly tables change when a day is repaired or data arrives late; the
incident log is append-only.  So the log is not written as things happen but *reconciled*:
the closings that the current rows call for are compared with the closings the log has in
force, and only the difference is appended.

- a closing that is called for and not in force: a ``RESOLVED`` row at that time;
- a closing in force that is not called for any more (the day that passed fails now, or
  the day itself fails again): a ``REOPENED`` row at the *same* time.  It takes one closing
  of that time out of force; a later ``RESOLVED`` row puts it back.

Closings in force are ``RESOLVED`` minus ``REOPENED`` rows per (incident, time), a sum over
a multiset: the state does not depend on the order in which rows arrive, and reconciling
twice appends nothing.  Rows written by hand have no ``origin``; they are never withdrawn.

All windows here are per rule or per series and ordered by day: their size is the number
of monitored days, never the event volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.sqltext import sql_str
from tidewatch.operators.incidents import DEFAULT_OWNER, REOPENED, incident_id_sql

#: Flagged days this many days apart are one episode.
MAX_GAP_DAYS = 1

_SERIES = "entity_type, entity_id, metric_name"


# ---- checks --------------------------------------------------------------------------

def _islands(checks: DataFrame) -> DataFrame:
    """Check rows with ``island``: the passes of the rule before the row.

    A run of failing rows and the passing row that ends it have the same number.
    """
    return checks.selectExpr(
        "check_date", "check_name", "severity", "status",
        "count_if(status = 'PASS') OVER (PARTITION BY check_name ORDER BY check_date "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS island")


def check_episodes(checks: DataFrame) -> DataFrame:
    """One row per run of failing (or warning) days of a rule; ``closed_on`` is the day it passes again."""
    runs = _islands(checks).groupBy("check_name", "island").agg(
        F.expr("min(check_date) FILTER (WHERE status <> 'PASS') AS first_day"),
        F.expr("max(check_date) FILTER (WHERE status <> 'PASS') AS last_day"),
        F.expr("count_if(status <> 'PASS') AS failing_days"),
        F.expr("min(severity) FILTER (WHERE status <> 'PASS') AS severity"),
        F.expr("min(check_date) FILTER (WHERE status = 'PASS') AS closed_on"))
    return runs.where("failing_days > 0").drop("island")


def check_closings(checks: DataFrame) -> DataFrame:
    """(incident_id, changed_at, note) for every check row's incident; no time while it stays open.

    A failing day closes when its run ends; a day that passes now closes on the day
    itself (its incident, if one was ever recorded, has been repaired).
    """
    rows = _islands(checks).selectExpr(
        "*", "min(CASE WHEN status = 'PASS' THEN check_date END) OVER (PARTITION BY check_name, island) AS ends")
    return rows.selectExpr(
        f"{incident_id_sql()} AS incident_id",
        "CAST(CASE WHEN status = 'PASS' THEN check_date ELSE ends END AS TIMESTAMP) AS changed_at",
        "CASE WHEN status = 'PASS' THEN 'check passes after a repair' "
        "ELSE concat('check passed again on ', date_format(ends, 'yyyy-MM-dd')) END AS note")


# ---- anomalies -----------------------------------------------------------------------

def _sessions(scored: DataFrame, max_gap_days: int) -> DataFrame:
    """Scored rows with ``session`` (0: before the first flagged day), ``starts`` and the session's last flagged day."""
    order = f"OVER (PARTITION BY {_SERIES} ORDER BY anomaly_date ROWS BETWEEN UNBOUNDED PRECEDING AND"
    flagged = "anomaly_flag = 'Y'"
    rows = scored.selectExpr("*", f"max(CASE WHEN {flagged} THEN anomaly_date END) {order} 1 PRECEDING) AS _before")
    rows = rows.selectExpr("*", f"{flagged} AND (_before IS NULL OR datediff(anomaly_date, _before) > {int(max_gap_days)}) AS starts")
    rows = rows.selectExpr("*", f"count_if(starts) {order} CURRENT ROW) AS session",
                           f"min(CASE WHEN starts THEN anomaly_date END) OVER (PARTITION BY {_SERIES} ORDER BY anomaly_date "
                           "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS _next")
    return rows.selectExpr("*", f"max(CASE WHEN {flagged} THEN anomaly_date END) OVER (PARTITION BY {_SERIES}, session) AS last_day")


def anomaly_episodes(scored: DataFrame, max_gap_days: int = MAX_GAP_DAYS) -> DataFrame:
    """Flagged days of a series at most ``max_gap_days`` apart, merged; one row per run.

    ``closed_on`` is the first scored day after the last flagged one (a flagged day
    beyond the gap counts: it starts an episode of its own); none while no day follows.
    """
    rows = _sessions(scored, max_gap_days).where("session > 0")
    return rows.groupBy("entity_type", "entity_id", "metric_name", "session").agg(
        F.expr("min(anomaly_date) AS first_day"), F.expr("max(last_day) AS last_day"),
        F.expr("count_if(anomaly_flag = 'Y') AS flagged_days"),
        F.expr("max(CASE WHEN anomaly_flag = 'Y' THEN abs(z_score) END) AS peak_z"),
        F.expr("coalesce(min(CASE WHEN anomaly_date > last_day THEN anomaly_date END), max(_next)) AS closed_on"),
    ).drop("session")


def anomaly_incident_id_sql(day: str) -> str:
    """SQL for ``INC-<day>-ANOMALY-<METRIC>[-<TYPE>[=<id>]]``; ``overall`` has no type part."""
    return (f"concat('INC-', date_format({day}, 'yyyy-MM-dd'), '-ANOMALY-', upper(replace(metric_name, '_', '-')), "
            "CASE WHEN entity_type = 'overall' THEN '' ELSE concat('-', upper(entity_type), coalesce(concat('=', entity_id), '')) END)")


def anomaly_incidents(episodes: DataFrame, owner: str = DEFAULT_OWNER) -> DataFrame:
    """One OPEN incident per episode, known by its first day, in ``dq_incidents`` shape.

    An episode keeps its id while it grows; overall KPIs are P1, entities P2.
    """
    series = "concat_ws('/', entity_type, entity_id, metric_name)"
    day = "date_format(first_day, 'yyyy-MM-dd')"
    return episodes.selectExpr(
        f"{anomaly_incident_id_sql('first_day')} AS incident_id",
        "CAST(first_day AS TIMESTAMP) AS opened_at", "CAST(NULL AS TIMESTAMP) AS closed_at",
        "CASE WHEN entity_type = 'overall' THEN 'P1' ELSE 'P2' END AS severity", "'OPEN' AS status",
        f"concat('Unusual ', metric_name, ' from ', {day}, '.') AS summary",
        f"concat('anomaly/', {series}) AS detected_by", "'dq_anomalies' AS impacted_assets",
        "'KPI_SHIFT' AS root_cause_type",
        "'KPI_SHIFT: the KPI left the range of its trailing days.' AS root_cause_details",
        "'Compare the KPI with its baseline in dq_anomalies and the checks of the same days.' AS resolution_steps",
        "'Watch the KPI in dq_anomalies from day to day.' AS preventive_actions",
        f"{sql_str(owner)} AS owner")


def anomaly_closings(scored: DataFrame, max_gap_days: int = MAX_GAP_DAYS) -> DataFrame:
    """(incident_id, changed_at, note) for the incident every scored day could have; no time while it stays open.

    A day that starts no episode now (it is not flagged any more, or belongs to an
    earlier episode) closes the incident of its own day on that day.
    """
    rows = _sessions(scored, max_gap_days)
    ends = ("coalesce(min(CASE WHEN anomaly_date > last_day THEN anomaly_date END) "
            f"OVER (PARTITION BY {_SERIES}, session), max(_next) OVER (PARTITION BY {_SERIES}, session))")
    rows = rows.selectExpr("*", f"{ends} AS _ends")
    return rows.selectExpr(
        f"{anomaly_incident_id_sql('anomaly_date')} AS incident_id",
        "CAST(CASE WHEN starts THEN _ends ELSE anomaly_date END AS TIMESTAMP) AS changed_at",
        "CASE WHEN starts THEN concat('not flagged on ', date_format(_ends, 'yyyy-MM-dd')) "
        "ELSE 'starts no episode any more' END AS note")


# ---- the log -------------------------------------------------------------------------

def closings_in_force(log: DataFrame) -> DataFrame:
    """(incident_id, changed_at, origin): automatic closings that no REOPENED row took back."""
    rows = log.where(f"origin IS NOT NULL AND status IN ('RESOLVED', '{REOPENED}')")
    return rows.groupBy("incident_id", "changed_at", "origin").agg(
        F.expr(f"count_if(status = 'RESOLVED') - count_if(status = '{REOPENED}') AS n")).where("n > 0").drop("n")


def reconcile(incidents: DataFrame, log: DataFrame, closings: DataFrame, origin: str) -> DataFrame:
    """Log rows to append so that the closings of ``origin`` in force are those of ``closings``.

    Only recorded incidents that ``closings`` knows take part; the incident of a day or
    rule that is gone keeps its state.
    """
    known = closings.join(incidents.select("incident_id"), "incident_id", "left_semi")
    force = closings_in_force(log).where(F.col("origin") == F.lit(origin)).join(
        known.select("incident_id").distinct(), "incident_id", "left_semi")
    wanted = known.where("changed_at IS NOT NULL")
    more = wanted.join(force, ["incident_id", "changed_at"], "left_anti").selectExpr(
        "incident_id", "'RESOLVED' AS status", "changed_at", "note")
    back = force.join(wanted.select("incident_id", "changed_at"), ["incident_id", "changed_at"], "left_anti").selectExpr(
        "incident_id", f"'{REOPENED}' AS status", "changed_at", "'closing withdrawn' AS note")
    return more.unionByName(back).withColumn("origin", F.lit(origin))
