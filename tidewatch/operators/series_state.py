"""Scoring one day of many series from a stored state instead of their history.

The state has one row per series (entity type and id): its last ``KEEP`` day rows as an
array.  The table is bucketed by series, so a day's rows are shuffled to the buckets and
meet the state where it lies: no exchange on the state's side, whatever the history's
length.  Frames count a series' own rows, not calendar days, so a sparse series needs
rows from long ago; the array has them.

``KEEP`` is more than a frame needs: a rerun of one of the last days drops the rows from
that day on and still has a whole frame.  A series is ``cut`` once rows were dropped; for
an older rerun that a cut series cannot serve, ``can_score`` is false and the caller
scores from the daily table.

A null id is a series of its own; keys are written without nulls, so that plain equality
(which buckets serve) is enough.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators import anomalies as A

BASELINE = A.BASELINE_ROWS
#: Day rows kept per series: one frame and as many days as a rerun may go back.
KEEP = 2 * BASELINE
KEY = ("entity_type", "entity_key")
KPIS = ("events_count", "purchases", "revenue")

_DAY = T.StructType([T.StructField("d", T.DateType())] + [T.StructField(k, T.DoubleType()) for k in KPIS])
SERIES_STATE = T.StructType([
    T.StructField("entity_type", T.StringType()), T.StructField("entity_key", T.StringType()),
    T.StructField("last_day", T.DateType()), T.StructField("cut", T.BooleanType()),
    T.StructField("history", T.ArrayType(_DAY))])

_ENTRY = "struct(d, events_count, purchases, revenue)"


def keyed(kpis: DataFrame) -> DataFrame:
    """Entity KPIs with ``entity_key``: the id with a mark before it, empty for null."""
    return kpis.withColumn("entity_key", F.expr("coalesce(concat('=', entity_id), '')")).drop("entity_id", "cvr")


def state_of(kpis: DataFrame, keep: int = KEEP, buckets: int = 0) -> DataFrame:
    """State after all days of ``kpis`` (``anomalies.entity_kpis``).

    With ``buckets`` the rows are dealt as the table is, so each bucket is written by one task, as one file.
    """
    series = keyed(kpis)
    if buckets:
        series = series.repartition(buckets, *KEY)
    rows = series.selectExpr(*KEY, f"{_ENTRY} AS entry",
                                  "row_number() OVER (PARTITION BY entity_type, entity_key ORDER BY d DESC) AS n")
    return rows.where(F.col("n") <= keep + 1).groupBy(*KEY).agg(
        F.max("entry.d").alias("last_day"), (F.max("n") > keep).alias("cut"),
        F.expr(f"array_sort(collect_list(entry) FILTER (WHERE n <= {int(keep)}))").alias("history"))


def advanced(state: DataFrame, day_kpis: DataFrame, day: dt.date, keep: int = KEEP) -> DataFrame:
    """State with the rows of ``day`` in place of those it had for that day.

    Most series have none on either side: their history passes through as it is.
    """
    today = keyed(day_kpis).selectExpr(*KEY, f"{_ENTRY} AS today")
    rows = state.join(today.hint("merge"), list(KEY), "full").selectExpr(
        *KEY, "coalesce(cut, false) AS cut",
        f"CASE WHEN today IS NULL AND last_day < DATE '{day.isoformat()}' AND history[0].d IS NOT NULL THEN history ELSE "
        f"array_sort(concat(filter(coalesce(history, array()), x -> x.d <> DATE '{day.isoformat()}'), "
        "if(today IS NULL, array(), array(today)))) END AS entries")
    return rows.where("size(entries) > 0").selectExpr(
        *KEY, "element_at(entries, -1).d AS last_day", f"cut OR size(entries) > {int(keep)} AS cut",
        f"CASE WHEN size(entries) > {int(keep)} THEN slice(entries, size(entries) - {int(keep) - 1}, {int(keep)}) "
        "ELSE entries END AS history")


def can_score(state: DataFrame, day: dt.date) -> bool:
    """Whether every series still has a whole frame before ``day`` (or all of its rows)."""
    return state.where(
        f"cut AND last_day >= DATE '{day.isoformat()}' "
        f"AND size(filter(history, x -> x.d < DATE '{day.isoformat()}')) < {BASELINE}").isEmpty()


def score_day(state: DataFrame, day_kpis: DataFrame, day: dt.date, thresholds: dict | None = None) -> DataFrame:
    """Scored rows of ``day`` for the series that have events on it."""
    today = keyed(day_kpis).selectExpr(*KEY, f"{_ENTRY} AS today")
    # the state grows with the series and is never broadcast, however small its files are
    rows = today.join(state.select(*KEY, "history").hint("merge"), list(KEY), "left").selectExpr(
        *KEY, f"filter(coalesce(history, array()), x -> x.d < DATE '{day.isoformat()}') AS before", "today")
    rows = rows.selectExpr(*KEY, f"inline(concat(slice(before, greatest(1, size(before) - {BASELINE - 1}), {BASELINE}), array(today)))")
    kpis = rows.selectExpr("*", "purchases / nullif(events_count, 0.0D) AS cvr")
    scored = A.score_kpis(kpis, "entity_key", thresholds=thresholds).where(F.col("anomaly_date") == F.lit(day))
    return scored.withColumn("entity_id", F.expr("CASE WHEN entity_id <> '' THEN substring(entity_id, 2) END"))
