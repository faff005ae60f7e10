"""Data-quality rules: one result row per (check_date, rule).

A rule is data: a name, a severity, which day it reads (the run date or the
calendar day before), a metric and a pass condition written as SQL over the
per-day aggregates, and two texts.  The fact table is aggregated once per
day; a window over those day rows supplies the calendar day before; all
rules for all requested days are then evaluated in one projection and turned
into long form with ``inline(array(named_struct(...)))`` -- no union, no
self-join.  Rules being SQL text keeps them declarative (they can be stored
as configuration) and makes the whole evaluation one expression for Catalyst.

Status is ``PASS`` when the condition holds, ``WARN`` when only the rule's
weaker condition does, and ``FAIL`` otherwise; a NULL metric (e.g. a null rate
over zero rows) therefore fails.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.dates import DateLike, as_date, on_days
from tidewatch.functions.sqltext import sql_str
from tidewatch.operators.stats import (
    DUP_KEY,
    day_stats,
    day_stats_and_dups,
    day_stats_with_dups,
    lookback_start,
)

# Fixed value: the table name the reference's rules report on.
FACT_TABLE = "core.fact_events"


@dataclass(frozen=True)
class Rule:
    """A rule; ``metric`` is SQL over ``{stat}`` placeholders (the stats of the
    day the rule reads) and ``{d}`` (the check date); ``passes`` and ``warns`` are
    SQL over ``{m}`` (the metric); without ``warns`` the rule never warns."""

    name: str
    severity: str
    day_offset: int  # 0: the run date itself, 1: the calendar day before
    metric: str
    passes: str
    expected_range: str
    failure_details: str
    needs: tuple[str, ...] = field(default=("n_events",))
    warns: str | None = None


def _num(x: float) -> str:
    return f"{x:g}"


def _count(stat: str) -> str:
    return f"CAST(coalesce({{{stat}}}, 0) AS DOUBLE)"


# ---- the reference's rules (texts are fixed values) ----------------------

def freshness_has_events() -> Rule:
    return Rule("freshness_has_events_on_run_date", "P0", 0, _count("n_events"), "{m} > 0",
                "> 0 rows on run_date", "No events found for run_date")


def volume_prev_day(min_rows: int = 1000, fail_below: int | None = None) -> Rule:
    """With ``fail_below``, counts from there up to ``min_rows`` only warn."""
    return Rule(f"volume_prev_day_events_min_{min_rows}", "P0", 1, _count("n_events"),
                f"{{m}} >= {int(min_rows)}", f">= {min_rows}",
                f"Previous day events below {min_rows}",
                warns=None if fail_below is None else f"{{m}} >= {int(fail_below)}")


def purchases_prev_day() -> Rule:
    return Rule("purchase_events_vanish_prev_day", "P0", 1, _count("n_purchases"), "{m} > 0",
                "> 0", "No purchases on previous day", ("n_purchases",))


def null_rate_session(max_pct: float = 1.0, fail_above: float | None = None) -> Rule:
    """With ``fail_above``, rates over ``max_pct`` up to there only warn."""
    return Rule("null_rate_session_id_run_date", "P1", 0,
                "100.0D * CAST({n_null_session} AS DOUBLE) / nullif(CAST({n_events} AS DOUBLE), 0.0D)",
                f"{{m}} <= {float(max_pct)!r}D",
                f"<= {_num(max_pct)}%",
                f"session_id null% exceeded {_num(max_pct)}% on run_date",
                ("n_events", "n_null_session"),
                None if fail_above is None else f"{{m}} <= {float(fail_above)!r}D")


def dup_composite_key() -> Rule:
    return Rule("dup_composite_key_groups_run_date", "P0", 0, _count("dup_groups"), "{m} = 0",
                "= 0 groups", "Duplicate groups found on run_date", ("dup_groups",))


def purchases_run_date() -> Rule:
    return Rule("purchase_events_on_run_date", "P0", 0, _count("n_purchases"), "{m} > 0",
                "> 0 purchases", "No purchases found on run_date", ("n_purchases",))


# ---- declared rules with no source text; thresholds and texts are ours ---

def _hours_until_day_end(ts: str) -> str:
    return (f"CAST(timestampdiff(MICROSECOND, {ts}, CAST(date_add({{d}}, 1) AS TIMESTAMP_NTZ)) "
            "AS DOUBLE) / 3.6e9D")


def latest_event_in_day(max_gap_hours: float = 1.0) -> Rule:
    """Newest event of run_date lies at most ``max_gap_hours`` before the day ends."""
    return Rule("freshness_latest_event_within_run_day", "P0", 0,
                _hours_until_day_end("{max_event_ts}"), f"{{m}} <= {float(max_gap_hours)!r}D",
                f"<= {_num(max_gap_hours)}h before end of run_date",
                f"Latest event_ts more than {_num(max_gap_hours)}h before end of run_date",
                ("max_event_ts",))


def latest_event_24h(max_age_hours: float = 24.0) -> Rule:
    """Newest event up to run_date is at most ``max_age_hours`` old at the end of run_date."""
    return Rule(f"freshness_latest_event_within_{_num(max_age_hours)}h", "P0", 0,
                _hours_until_day_end("{latest_event_ts}"), f"{{m}} <= {float(max_age_hours)!r}D",
                f"<= {_num(max_age_hours)}h",
                f"Latest event_ts older than {_num(max_age_hours)}h",
                ("latest_event_ts",))


def default_rules(volume_min_rows: int = 1000, null_max_pct: float = 1.0) -> list[Rule]:
    """The four rules the reference runs every day."""
    return [freshness_has_events(), volume_prev_day(volume_min_rows), purchases_prev_day(),
            null_rate_session(null_max_pct)]


# ---- evaluation ------------------------------------------------------------

def _needs(rules: Sequence[Rule]) -> set[str]:
    return {n for r in rules for n in r.needs}


def rule_stats(fact: DataFrame, rules: Sequence[Rule], first: DateLike | None = None,
               last: DateLike | None = None, dup_key: Sequence[str] = DUP_KEY,
               dup_strategy: str = "single_scan") -> DataFrame:
    """Per-day aggregates the rules need.

    With a range, only days ``[first-1, last]`` are read (back to the last
    event day before ``first`` when a rule needs the newest event so far).  Without the
    duplicate rule this is one scan and one small shuffle.  With it,
    ``dup_strategy`` picks ``hash_prepass`` (shuffle key hashes, then the
    full key only for repeated hashes: least shuffle when duplicates are
    rare) or ``single_scan`` (one scan, full key shuffled for every row).
    """
    need = _needs(rules)
    if first is not None:
        hi = as_date(last if last is not None else first)
        lo = as_date(first) - dt.timedelta(days=1)
        if "latest_event_ts" in need:
            # the newest event up to `first` lies in the last event day <= first
            start = lookback_start(fact, first, 1)
            fact = fact.where(F.col("event_date") <= F.lit(hi))
            if start is not None:
                fact = fact.where(F.col("event_date") >= F.lit(min(start, lo)))
        else:
            fact = on_days(fact, lo, hi)
    if "dup_groups" in need:
        if dup_strategy == "single_scan":
            return day_stats_with_dups(fact, dup_key)
        return day_stats_and_dups(fact, dup_key)
    return day_stats(fact)


def _day_rows(stats: DataFrame, spine: DataFrame | None) -> DataFrame:
    rows = stats.withColumnRenamed("event_date", "check_date")
    if spine is None:
        return rows.withColumn("_in_spine", F.lit(True))
    marks = spine.select("check_date", F.lit(True).alias("_in_spine"))
    return rows.join(marks, "check_date", "full")


def _stat_names(text: str) -> list[str]:
    import string

    return [f for _, f, _, _ in string.Formatter().parse(text) if f]


def with_prev_day(stats: DataFrame, cols: Sequence[str],
                  spine: DataFrame | None = None) -> DataFrame:
    """Day rows with ``d0_<c>`` (the day) and ``d1_<c>`` (the calendar day before).

    One window over the day rows, ordered by day: the previous row is the
    calendar day before only when its date is exactly one day earlier, so a
    missing day yields NULL, never the row before the gap.  The same window
    carries the running newest event.  It has no partition key, so it runs in
    one task over one row per day -- a bound set by the calendar, not by the
    event volume.
    """
    rows = _day_rows(stats, spine)
    w = "OVER (ORDER BY check_date)"
    exprs = ["check_date", "coalesce(_in_spine, false) AS _in_spine"]
    for c in cols:
        if c == "latest_event_ts":
            exprs.append(f"max(max_event_ts) OVER (ORDER BY check_date ROWS BETWEEN UNBOUNDED "
                         f"PRECEDING AND CURRENT ROW) AS d0_latest_event_ts")
            continue
        exprs.append(f"`{c}` AS d0_{c}")
        exprs.append(f"CASE WHEN lag(check_date) {w} = date_sub(check_date, 1) "
                     f"THEN lag(`{c}`) {w} END AS d1_{c}")
    return rows.selectExpr(*exprs)


def _result_struct(rule: Rule, table_name: str) -> str:
    prefix = f"d{rule.day_offset}_"
    fields = {n: f"{prefix}{n}" for n in _stat_names(rule.metric) if n != "d"}
    metric = "CAST(" + rule.metric.format(d="check_date", **fields) + " AS DOUBLE)"
    ok = rule.passes.format(m=metric)
    warn = f"WHEN {rule.warns.format(m=metric)} THEN 'WARN' " if rule.warns else ""
    return (
        "named_struct("
        f"'check_name', {sql_str(rule.name)}, "
        f"'table_name', {sql_str(table_name)}, "
        f"'severity', {sql_str(rule.severity)}, "
        f"'status', CASE WHEN {ok} THEN 'PASS' {warn}ELSE 'FAIL' END, "
        f"'metric_value', {metric}, "
        f"'expected_range', {sql_str(rule.expected_range)}, "
        f"'failure_details', CASE WHEN {ok} THEN CAST(NULL AS STRING) "
        f"ELSE {sql_str(rule.failure_details)} END)"
    )


def evaluate_rules(stats: DataFrame, rules: Sequence[Rule], spine: DataFrame | None = None,
                   table_name: str = FACT_TABLE) -> DataFrame:
    """Long-form results ``(check_date, check_name, ..., failure_details)``.

    ``stats`` holds one row per event day; ``spine`` lists the days to check
    (column ``check_date``), by default every day in ``stats``.  A spine day
    without rows still gets one result per rule (counts 0), like a global
    aggregate over an empty day.  The results come from one projection with
    ``inline(array(named_struct(...)))`` -- no union, so the aggregates below
    are computed once.
    """
    cols = sorted(c for c in _needs(rules) if c in stats.columns or c == "latest_event_ts")
    days = with_prev_day(stats, cols, spine).where(F.col("_in_spine"))
    structs = ", ".join(_result_struct(r, table_name) for r in rules)
    return days.selectExpr("check_date", f"inline(array({structs}))")


def checks_all_days(fact: DataFrame, rules: Sequence[Rule] | None = None,
                    table_name: str = FACT_TABLE) -> DataFrame:
    """Every rule for every day present in the fact table (one scan)."""
    rules = list(rules or default_rules())
    return evaluate_rules(rule_stats(fact, rules), rules, None, table_name)


def checks_for_run_date(spark: SparkSession, fact: DataFrame, run_date: DateLike,
                        rules: Sequence[Rule] | None = None,
                        table_name: str = FACT_TABLE) -> DataFrame:
    """All rules for one run date; reads only run_date and the day before."""
    rules = list(rules or default_rules())
    d = as_date(run_date)
    stats = rule_stats(fact, rules, d, d)
    spine = spark.range(1).select(F.lit(d).alias("check_date"))
    return evaluate_rules(stats, rules, spine, table_name)


def checks_for_days(spark: SparkSession, fact: DataFrame, first: DateLike, last: DateLike,
                    rules: Sequence[Rule] | None = None,
                    table_name: str = FACT_TABLE) -> DataFrame:
    """All rules for every calendar day in ``[first, last]``, empty days included."""
    from tidewatch.functions.dates import date_spine

    rules = list(rules or default_rules())
    stats = rule_stats(fact, rules, first, last)
    return evaluate_rules(stats, rules, date_spine(spark, first, last), table_name)
