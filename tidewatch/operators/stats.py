"""Per-day aggregates of the fact table.

Every rule and every KPI reads only these few numbers per day, so one
two-phase aggregate (partial per task, final after a shuffle of one row per
day and task) replaces the reference's four scans per rule and day plus a
whole-history rescan per day.  A hot day or key cannot skew it: the partial
aggregate collapses each task's rows before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.dates import DateLike, as_date

PURCHASE = "purchase"
# Revenue is summed in fixed point so the sum is exact and independent of the
# order rows arrive in; 4 decimals hold 2-decimal prices without loss.
REVENUE_DECIMAL = "decimal(22,4)"

# Fixed value: the composite key of the duplicate rule.
DUP_KEY = ("user_id", "session_id", "event_ts", "event_type", "product_id")


def is_purchase(c: str = "event_type") -> Column:
    return F.col(c) == F.lit(PURCHASE)


_AS_DECIMAL = f"try_cast(price AS {REVENUE_DECIMAL})"
_FITS = f"coalesce(CAST({_AS_DECIMAL} AS DOUBLE) = price, false)"
# Prices that fixed point holds without loss; NULL prices add nothing.
_EXACT = (f"CASE WHEN event_type = '{PURCHASE}' AND price IS NULL THEN NULL WHEN event_type = '{PURCHASE}' AND {_FITS} "
          f"THEN {_AS_DECIMAL} ELSE CAST(0 AS {REVENUE_DECIMAL}) END")
# Prices it cannot hold (too large, finer than its scale, not finite): summed as doubles, never dropped.
_REST = f"CASE WHEN event_type = '{PURCHASE}' AND price IS NOT NULL AND NOT {_FITS} THEN price END"


def revenue_decimal() -> Column:
    """Per-row revenue in fixed point: a purchase's price where that holds it, else 0."""
    return F.expr(_EXACT)


def revenue_rest() -> Column:
    """Per-row revenue that fixed point cannot hold, as double."""
    return F.expr(_REST)


REVENUE_SQL = f"CAST(sum({_EXACT}) AS DOUBLE) + coalesce(sum({_REST}), 0D)"


def revenue_sum() -> Column:
    """``sum(price of purchases, 0 otherwise)`` as double: exact where prices fit, no price left out."""
    return F.expr(REVENUE_SQL)


def day_stats(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per ``event_date`` (and ``by`` columns) with the counts all rules use."""
    return fact.groupBy("event_date", *by).agg(
        F.expr("count(1) AS n_events"),
        F.expr(f"count_if(event_type = '{PURCHASE}') AS n_purchases"),
        F.expr("count_if(session_id IS NULL) AS n_null_session"),
        F.expr(f"{REVENUE_SQL} AS revenue"),
        F.expr("max(event_ts) AS max_event_ts"),
    )


def day_stats_with_dups(fact: DataFrame, key: Sequence[str] = DUP_KEY) -> DataFrame:
    """``day_stats`` plus ``dup_groups`` from a single scan.

    Level 1 groups by (day, key) and keeps partial counts; level 2 folds the
    groups of a day into the day's totals and counts groups with more than
    one row.  The first shuffle is the one duplicate detection needs anyway;
    a hot key is folded to one row per task by the partial aggregate before it.
    NULL key parts group together, as in SQL ``GROUP BY``.
    """
    groups = fact.groupBy("event_date", *key).agg(
        F.count(F.lit(1)).alias("rows_in_group"),
        F.count_if(is_purchase()).alias("g_purchases"),
        F.count_if(F.col("session_id").isNull()).alias("g_null_session"),
        F.sum(revenue_decimal()).alias("g_revenue"),
        F.sum(revenue_rest()).alias("g_rest"),
        F.max("event_ts").alias("g_max_ts"),
    )
    return groups.groupBy("event_date").agg(
        F.sum("rows_in_group").alias("n_events"),
        F.sum("g_purchases").alias("n_purchases"),
        F.sum("g_null_session").alias("n_null_session"),
        (F.sum("g_revenue").cast("double") + F.coalesce(F.sum("g_rest"), F.lit(0.0))).alias("revenue"),
        F.max("g_max_ts").alias("max_event_ts"),
        F.count_if(F.col("rows_in_group") > 1).alias("dup_groups"),
    )


def dup_groups_per_day(fact: DataFrame, key: Sequence[str] = DUP_KEY) -> DataFrame:
    """Per day, the number of key groups holding more than one row (exact).

    An option for wide keys: (day, 64-bit hash of the key) is shuffled first, and
    the full key only for rows whose hash repeats (a duplicate always repeats its
    hash; a collision only adds a candidate, which the second grouping removes).
    The join's way is left to the planner.
    """
    kh = F.xxhash64(*[F.col(c) for c in key]).alias("_kh")
    cand = (fact.select("event_date", kh).groupBy("event_date", "_kh")
            .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
            .select("event_date", "_kh"))
    suspects = fact.select("event_date", *key, kh).join(cand, ["event_date", "_kh"], "left_semi")
    groups = (suspects.groupBy("event_date", *key).agg(F.count(F.lit(1)).alias("rows_in_group"))
              .where(F.col("rows_in_group") > 1))
    return groups.groupBy("event_date").agg(F.count(F.lit(1)).alias("dup_groups"))


def day_stats_and_dups(fact: DataFrame, key: Sequence[str] = DUP_KEY) -> DataFrame:
    """``day_stats`` with ``dup_groups`` (0 on days without duplicates)."""
    return day_stats(fact).join(dup_groups_per_day(fact, key), "event_date", "left").withColumn(
        "dup_groups", F.coalesce(F.col("dup_groups"), F.lit(0).cast("bigint")))


def run_context(stats: DataFrame) -> DataFrame:
    """``dq_run_context`` rows: run_date and the newest event of that day."""
    return stats.select(F.col("event_date").alias("run_date"), F.col("max_event_ts"))


def replay_progress(fact: DataFrame) -> DataFrame:
    """Loaded range and size: min/max event day and total rows."""
    return fact.agg(
        F.min("event_date").alias("min_loaded_date"),
        F.max("event_date").alias("max_loaded_date"),
        F.count(F.lit(1)).alias("total_rows_loaded"),
    )


def lookback_start(fact: DataFrame, run_date: DateLike, rows_needed: int,
                   first_window_days: int = 30) -> dt.date | None:
    """Earliest day to read so that ``rows_needed`` event days up to run_date are in.

    Scoring one day needs that day and the ``rows_needed - 1`` event days
    before it (frames count rows, not calendar days).  A calendar window is
    tried first and doubled while it holds too few event days; each probe is a
    pruned distinct over the window's day column (one number back to the
    driver).  ``None``: the whole history up to run_date is needed.
    """
    d = as_date(run_date)
    days = fact.select("event_date").where(F.col("event_date") <= F.lit(d))
    earliest = None
    span = first_window_days
    while True:
        start = d - dt.timedelta(days=span - 1)
        present = days.where(F.col("event_date") >= F.lit(start)).distinct().count()
        if present >= rows_needed:
            return start
        if earliest is None:
            earliest = days.select(F.min("event_date")).first()[0]
        if earliest is None or start <= earliest:
            return None
        span *= 2
