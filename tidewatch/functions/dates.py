"""Run parameters and day arithmetic.

Two meanings of "previous day" exist and are kept apart:
- the *calendar* day before (``prev_calendar_day``), used by the rules;
- the previous *row* of a day series (``lag`` in the anomaly windows).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DateLike = dt.date | str


def as_date(d: DateLike) -> dt.date:
    """``yyyy-MM-dd`` text or a date."""
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.datetime.strptime(d, "%Y-%m-%d").date()


def prev_calendar_day(c: Column) -> Column:
    return F.date_sub(c, 1)


def run_params(spark: SparkSession, run_date: DateLike) -> DataFrame:
    """One-row relation ``(run_date, prev_date)``; prev_date is the calendar day before."""
    d = as_date(run_date)
    return spark.range(1).select(
        F.lit(d).alias("run_date"), F.lit(d - dt.timedelta(days=1)).alias("prev_date")
    )


def day_start(d: DateLike) -> dt.datetime:
    d = as_date(d)
    return dt.datetime(d.year, d.month, d.day)


def date_spine(spark: SparkSession, first: DateLike, last: DateLike) -> DataFrame:
    """Every calendar day in ``[first, last]`` as ``check_date`` (computed by Spark)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(as_date(first)), F.lit(as_date(last)))).alias("check_date")
    )


def on_days(df: DataFrame, first: DateLike, last: DateLike | None = None,
            ts_col: str = "event_ts", date_col: str = "event_date") -> DataFrame:
    """Rows whose event day is in ``[first, last]``.

    Filters both the day column (partition pruning on stored tables) and the
    timestamp range (Parquet row-group pushdown when the day is derived).
    """
    a = as_date(first)
    b = as_date(last) if last is not None else a
    lo, hi = day_start(a), day_start(b + dt.timedelta(days=1))
    cond = F.col(date_col).between(F.lit(a), F.lit(b))
    if ts_col in df.columns:
        cond = cond & (F.col(ts_col) >= F.lit(lo).cast("timestamp_ntz")) & (
            F.col(ts_col) < F.lit(hi).cast("timestamp_ntz"))
    return df.where(cond)
