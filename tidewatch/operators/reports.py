"""Dashboard data: health, drill-down, incident and root-cause reports.

All inputs are check results and incidents — one row per (day, rule) and per
incident — so these are small aggregates; none touches the event volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.incidents import incident_day_sql

# Health score = 100 - 30·P0 - 10·P1 - 5·P2 issues, floored at 0.  The P0
# weight is fixed by the reference's outputs (0 → 100, 1 → 70, 2 → 40); the P1
# and P2 weights and the floor are not observable there and are parameters.
HEALTH_WEIGHTS = {"P0": 30, "P1": 10, "P2": 5}
ISSUE_STATUSES = ("FAIL", "WARN")


def _is_issue(sev: str | None = None) -> Column:
    cond = F.col("status") != F.lit("PASS")
    return cond & (F.col("severity") == F.lit(sev)) if sev else cond


def health_daily(checks: DataFrame, weights: dict[str, int] | None = None,
                 floor: int = 0) -> DataFrame:
    """Per check_date: total checks, issues by severity and a 0..100 score."""
    w = weights or HEALTH_WEIGHTS
    agg = checks.groupBy("check_date").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(_is_issue("P0")).alias("p0_issues"),
        F.count_if(_is_issue("P1")).alias("p1_issues"),
        F.count_if(_is_issue("P2")).alias("p2_issues"),
    )
    penalty = (F.col("p0_issues") * w["P0"] + F.col("p1_issues") * w["P1"]
               + F.col("p2_issues") * w["P2"])
    return agg.withColumn("health_score", F.greatest(F.lit(100) - penalty, F.lit(floor)).cast("bigint"))


INCIDENT_COLUMNS = ("incident_id", "incident_status", "incident_summary",
                    "incident_root_cause_type", "incident_root_cause_details",
                    "incident_opened_at", "incident_owner")


def checks_with_incidents(checks: DataFrame, incidents: DataFrame) -> DataFrame:
    """Every check row, with the incident it triggered (if any).

    An incident belongs to a check row when it was detected by that check, on
    the day inside its id, and the row did not pass.  Left join: all check
    rows stay.  The incident side is left to AQE, which broadcasts it when its
    measured size is small and shuffles otherwise.
    """
    inc = incidents.selectExpr(
        "detected_by AS _by", f"{incident_day_sql()} AS _day", "incident_id",
        "status AS incident_status", "summary AS incident_summary",
        "root_cause_type AS incident_root_cause_type",
        "root_cause_details AS incident_root_cause_details",
        "opened_at AS incident_opened_at", "owner AS incident_owner",
    )
    cond = F.expr("check_name = _by AND check_date = _day AND status <> 'PASS'")
    j = checks.join(inc, cond, "left")
    return j.select(*checks.columns, *INCIDENT_COLUMNS)


def fail_warn_trend(checks: DataFrame) -> DataFrame:
    """Per day and severity: FAIL and WARN counts and total issues."""
    return checks.groupBy("check_date", "severity").agg(
        F.count_if(F.col("status") == "FAIL").alias("fail_checks"),
        F.count_if(F.col("status") == "WARN").alias("warn_checks"),
        F.count_if(F.col("status") != "PASS").alias("issue_checks"),
        F.count(F.lit(1)).alias("total_checks"),
    )


def check_detail_trend(checks: DataFrame, check_name: str, first=None, last=None) -> DataFrame:
    """Drill-down: one check's rows over time, with the change against the prior run."""
    sel = checks.where(F.col("check_name") == F.lit(check_name))
    if first is not None:
        sel = sel.where(F.col("check_date") >= F.lit(first))
    if last is not None:
        sel = sel.where(F.col("check_date") <= F.lit(last))
    w = Window.partitionBy("check_name").orderBy("check_date")
    return sel.select(
        "check_date", "check_name", "severity", "status", "metric_value", "expected_range",
        "failure_details",
        (F.col("metric_value") - F.lag("metric_value").over(w)).alias("metric_change"),
    )


def root_cause_counts(incidents: DataFrame) -> DataFrame:
    return incidents.groupBy("root_cause_type").agg(F.count(F.lit(1)).alias("incident_count"))


def root_cause_pareto(incidents: DataFrame) -> DataFrame:
    """Counts by root cause, largest first, with the cumulative share in percent.

    The window runs over one row per root-cause type (a short fixed list).
    """
    counts = root_cause_counts(incidents)
    order = Window.orderBy(F.col("incident_count").desc(), F.col("root_cause_type").asc())
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("incident_count").over(Window.partitionBy(F.lit(1)))
    cum = F.sum("incident_count").over(running)
    return counts.select(
        "root_cause_type", "incident_count",
        F.row_number().over(order).cast("bigint").alias("pareto_rank"),
        cum.cast("bigint").alias("cumulative_count"),
        (F.lit(100.0) * cum / total).alias("cumulative_pct"),
    )


def top_failing_checks(checks: DataFrame, n: int = 10) -> DataFrame:
    """Checks with the most FAIL/WARN days and rows; the top ``n`` (a top-n report)."""
    issue = F.col("status").isin(*ISSUE_STATUSES)
    agg = checks.groupBy("check_name").agg(
        F.count_distinct(F.when(issue, F.col("check_date"))).alias("failwarn_days"),
        F.count_if(issue).alias("failwarn_rows"),
    ).where(F.col("failwarn_rows") > 0)
    return agg.orderBy(F.col("failwarn_days").desc(), F.col("failwarn_rows").desc(),
                       F.col("check_name").asc()).limit(n)
