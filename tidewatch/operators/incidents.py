"""Incident workflow on append-only tables.

- ``open_incidents``: one incident per failing (check_date, check) with id
  ``INC-<yyyy-mm-dd>-<SLUG>``; texts come from a small per-rule catalogue.
- ``new_incidents``: drops ids already recorded (left anti join), so reruns
  never open the same incident twice.
- status changes are rows of a log (Parquet has no UPDATE); the current state
  is the latest row per incident by ``changed_at`` — arrival order is ignored.
- ``resolution_events``: a failing check that passes again on a later run
  resolves its incident; found with a per-rule forward-looking window, not
  by pairing incidents with later checks.  (The store reconciles its log with
  the current check rows instead, see ``operators.episodes``.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.sqltext import sql_str
from tidewatch.schemas import INCIDENT_STATUS_LOG, INCIDENTS, INCIDENT_STATUSES, SEVERITIES

DEFAULT_OWNER = "data-reliability"
#: Log status that takes a closing of the same time out of force; never a current status.
REOPENED = "REOPENED"

# Incident id slugs and root-cause types of the rules.
# rule kind -> (slug, root_cause_type, what the rule measures, who reads it)
_RULE_FACTS: dict[str, tuple[str, str, str, str]] = {
    "dup_composite_key_groups_run_date": ("DUP-EVENT", "PIPELINE_DUPLICATION", "groups of equal composite keys", "check drill-down"),
    "freshness_latest_event_within_run_day": ("FRESHNESS", "LATE_DATA_OR_JOB_FAILURE", "newest event time of the day", "health report"),
    "freshness_latest_event_within": ("STALE", "LATE_DATA_OR_JOB_FAILURE", "age of the newest event", "health report"),
    "freshness_has_events_on_run_date": ("NO-EVENTS", "LATE_DATA_OR_JOB_FAILURE", "events of the day", "health report"),
    "null_rate_session_id_run_date": ("NULL-SESSION", "SCHEMA_OR_LOGGING_ISSUE", "share of events without session", "session figures"),
    "volume_prev_day_events": ("LOW-VOLUME", "UPSTREAM_MISSING", "events of the day before", "health report"),
    "purchase_events_vanish_prev_day": ("NO-PURCHASES-PREV", "LOGIC_BUG", "purchases of the day before", "revenue figures"),
    "purchase_events_on_run_date": ("NO-PURCHASES", "LOGIC_BUG", "purchases of the day", "revenue figures"),
}


def _texts(slug: str, cause: str, metric: str, readers: str) -> tuple[str, str, str, str, str, str, str]:
    """Incident texts from what the engine knows of a rule: its metric, readers and cause type."""
    return (slug, f"Out of range: {metric}", readers, cause, f"{cause}: the rule saw its metric ({metric}) out of range.",
            f"Compare {metric} in dq_day_stats with the raw files, reload the day and run its checks again.",
            f"Watch {metric} in dq_day_stats from day to day.")


# rule kind -> (slug, summary, impacted assets, root_cause_type, root cause,
#               resolution steps, preventive actions)
CATALOG: dict[str, tuple[str, str, str, str, str, str, str]] = {k: _texts(*v) for k, v in _RULE_FACTS.items()}

_CATALOG_COLS = ("rule_kind", "slug", "summary", "impacted", "root_cause_type",
                 "root_cause_details", "resolution_steps", "preventive_actions")


def catalog_df(spark: SparkSession) -> DataFrame:
    """The per-rule incident texts as an inline table.

    A handful of rows, one per rule kind: broadcast-safe by construction.
    """
    rows = ", ".join("(" + ", ".join(sql_str(x) for x in (k, *v)) + ")" for k, v in CATALOG.items())
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {rows} AS catalog({', '.join(_CATALOG_COLS)})"))


# Names of the rules whose limit is the usual one; their ids carry the bare slug.
USUAL_LIMITS = ("volume_prev_day_events_min_1000", "freshness_latest_event_within_24h")

_LIMIT = r"_(min_)?[0-9]+(\\.[0-9]+)?h?$"
_KIND_SQL = f"regexp_replace({{name}}, '{_LIMIT}', '')"
_DAY_SQL = r"to_date(regexp_extract({iid}, 'INC-(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1))"


def incident_id_sql(check_date: str = "check_date", check_name: str = "check_name") -> str:
    """SQL for ``INC-<yyyy-mm-dd>-<SLUG>[-<LIMIT>]``.

    Rules of one kind with different limits run side by side: a limit other than the
    usual one is part of the id.  Rules outside the catalogue get their name, upper-cased.
    """
    kind = _KIND_SQL.format(name=check_name)
    whens = " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in CATALOG.items())
    usual = ", ".join(f"'{n}'" for n in USUAL_LIMITS)
    limit = (f"CASE WHEN {check_name} IN ({usual}) THEN '' "
             f"ELSE upper(replace(regexp_extract({check_name}, '{_LIMIT}', 0), '_', '-')) END")
    slug = f"coalesce(CASE {kind} {whens} END || {limit}, upper(replace({check_name}, '_', '-')))"
    return f"concat('INC-', date_format({check_date}, 'yyyy-MM-dd'), '-', {slug})"


def incident_day_sql(incident_id: str = "incident_id") -> str:
    """SQL for the date inside ``INC-<yyyy-mm-dd>-...``."""
    return _DAY_SQL.format(iid=incident_id)


def incident_day(incident_id: Column) -> Column:
    """The date inside ``INC-<yyyy-mm-dd>-...``."""
    return F.to_date(F.regexp_extract(incident_id, r"INC-(\d{4}-\d{2}-\d{2})", 1))


def open_incidents(spark: SparkSession, checks: DataFrame, owner: str = DEFAULT_OWNER) -> DataFrame:
    """One OPEN incident per failing check row, in ``dq_incidents`` shape."""
    failing = checks.where("status <> 'PASS'").selectExpr(
        "*", f"{_KIND_SQL.format(name='check_name')} AS rule_kind")
    j = failing.join(catalog_df(spark), "rule_kind", "left")
    day = "date_format(check_date, 'yyyy-MM-dd')"
    return j.selectExpr(
        f"{incident_id_sql()} AS incident_id",
        "CAST(check_date AS TIMESTAMP) AS opened_at",
        "CAST(NULL AS TIMESTAMP) AS closed_at",
        "severity",
        "'OPEN' AS status",
        f"concat(coalesce(summary, check_name), ' on ', {day}, '.') AS summary",
        "check_name AS detected_by",
        "concat_ws('; ', table_name, impacted) AS impacted_assets",
        "root_cause_type", "root_cause_details", "resolution_steps", "preventive_actions",
        f"{sql_str(owner)} AS owner",
    )


def new_incidents(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates whose id is not recorded yet (idempotent auto-open), each id once."""
    return candidates.dropDuplicates(["incident_id"]).join(existing.select("incident_id"), "incident_id", "left_anti").select(
        *INCIDENTS.names)


def checked_manual(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Incidents logged by hand, in ``dq_incidents`` shape; refused with ValueError when an
    id is missing, repeated or already recorded, or severity or status is outside its domain.

    Columns that ``rows`` lacks are NULL; status is OPEN unless given.
    """
    have = set(rows.columns)
    if extra := have - set(INCIDENTS.names):
        raise ValueError(f"unknown incident columns: {', '.join(sorted(extra))}")
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name) for f in INCIDENTS.fields]
    out = rows.select(*cols).fillna("OPEN", ["status"])
    known = F.col("severity").isin(*SEVERITIES) & F.col("status").isin(*INCIDENT_STATUSES)
    if not out.where(F.col("incident_id").isNull() | F.col("opened_at").isNull() | ~F.coalesce(known, F.lit(False))).isEmpty():
        raise ValueError("an incident needs incident_id, opened_at and a known severity and status")
    if not out.groupBy("incident_id").count().where("count > 1").isEmpty():
        raise ValueError("an incident id is given twice")
    if not out.join(existing.select("incident_id"), "incident_id", "left_semi").isEmpty():
        raise ValueError("an incident id is already recorded")
    return out


def checked_changes(changes: DataFrame, existing: DataFrame) -> DataFrame:
    """Status changes whose status is in the domain and whose incident exists; else ValueError."""
    if not changes.where(~F.coalesce(F.col("status").isin(*INCIDENT_STATUSES), F.lit(False))
                         | F.col("changed_at").isNull()).isEmpty():
        raise ValueError(f"a status change needs changed_at and a status of {', '.join(INCIDENT_STATUSES)}")
    if not changes.join(existing.select("incident_id"), "incident_id", "left_anti").isEmpty():
        raise ValueError("a status change names an incident that is not recorded")
    return changes


def resolution_events(checks: DataFrame) -> DataFrame:
    """Status-log rows: OPEN for each failing check, RESOLVED when it next passes.

    ``min(pass day) over (rule, following rows)`` finds, for every row, the
    next day the same rule passed; one sort per rule, no pairing of rows.
    """
    nxt = checks.selectExpr(
        "check_date", "check_name", "status",
        "min(CASE WHEN status = 'PASS' THEN check_date END) OVER (PARTITION BY check_name "
        "ORDER BY check_date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_pass",
    ).where("status <> 'PASS'")
    events = nxt.selectExpr(
        f"{incident_id_sql()} AS incident_id",
        "inline(array("
        "named_struct('status', 'OPEN', 'changed_at', CAST(check_date AS TIMESTAMP), "
        "'note', 'opened by failing check'), "
        "named_struct('status', 'RESOLVED', 'changed_at', CAST(next_pass AS TIMESTAMP), "
        "'note', concat('check passed again on ', date_format(next_pass, 'yyyy-MM-dd')))))",
    )
    return events.where("changed_at IS NOT NULL").select(*INCIDENT_STATUS_LOG.names)


_RANK_SQL = ("array_position(array(" + ", ".join(f"'{s}'" for s in INCIDENT_STATUSES)
             + "), status)")


def effective(log: DataFrame) -> DataFrame:
    """Log rows that count: closings that were taken back, and the rows that did so, are left out."""
    if "origin" not in log.columns:
        return log
    at = "OVER (PARTITION BY incident_id, changed_at, origin)"
    rows = log.selectExpr("*", f"count_if(status = 'RESOLVED') {at} - count_if(status = '{REOPENED}') {at} AS _net")
    return rows.where(f"status <> '{REOPENED}' AND NOT (status = 'RESOLVED' AND origin IS NOT NULL AND _net <= 0)").drop("_net")


def current_state(incidents: DataFrame, status_log: DataFrame) -> DataFrame:
    """Incidents with status and closed_at taken from the latest log row that counts.

    Latest = greatest ``changed_at``; ties go to the later workflow step.
    ``closed_at`` is the time of the latest row when that row is RESOLVED.  Closings that
    a REOPENED row took back do not count.
    """
    latest = effective(status_log).selectExpr(
        "incident_id", "status AS _status", "changed_at AS _changed_at",
        f"row_number() OVER (PARTITION BY incident_id ORDER BY changed_at DESC, {_RANK_SQL} DESC) AS _rn",
    ).where("_rn = 1").drop("_rn")
    j = incidents.join(latest, "incident_id", "left")
    cols = []
    for c in INCIDENTS.names:
        if c == "status":
            cols.append("coalesce(_status, status) AS status")
        elif c == "closed_at":
            cols.append("CASE WHEN _status = 'RESOLVED' THEN _changed_at ELSE closed_at END AS closed_at")
        else:
            cols.append(f"`{c}`")
    return j.selectExpr(*cols)


def append_status(log: DataFrame, changes: DataFrame) -> DataFrame:
    """Manual or automatic status changes appended to the log (schema-checked)."""
    bad = set(changes.columns) ^ set(INCIDENT_STATUS_LOG.names)
    if bad:
        raise ValueError(f"status change rows need columns {INCIDENT_STATUS_LOG.names}")
    return log.unionByName(changes.select(*INCIDENT_STATUS_LOG.names))


def incidents_for_checks(spark: SparkSession, checks: DataFrame,
                         owner: str = DEFAULT_OWNER) -> tuple[DataFrame, DataFrame]:
    """(incidents, status log) derived from a run of checks."""
    return open_incidents(spark, checks, owner), resolution_events(checks)


def related_failing_checks(incidents: DataFrame, checks: DataFrame) -> DataFrame:
    """Each incident with the failing check rows that triggered it."""
    failing = checks.where(F.col("status") != F.lit("PASS"))
    inc = incidents.select("incident_id", "detected_by", incident_day(F.col("incident_id")).alias("_day"))
    j = inc.join(failing, (inc["detected_by"] == failing["check_name"]) & (inc["_day"] == failing["check_date"]))
    return j.select("incident_id", "check_date", "check_name", "severity", "status",
                    "metric_value", "expected_range", "failure_details")


def incident_queue(incidents: DataFrame, statuses: Sequence[str] = ("OPEN",)) -> DataFrame:
    """Ops queue: chosen statuses, P0 first, then newest opened."""
    return incidents.where(F.col("status").isin(*statuses)).orderBy(
        F.col("severity").asc(), F.col("opened_at").desc(), F.col("incident_id").asc())
