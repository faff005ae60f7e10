"""Order-independent digests of days, and what follows from comparing them.

A day's digest is (rows, sum of row hashes, xor of row hashes).  It does not depend on
the order or the files of the rows, folds map-side to one row per task and day, and
tells a day loaded k times from any other change: rows and sum are k times the
original, and the xor is the original or 0.

Two states of a day with equal digests are taken as equal (a change would have to keep
the count, a 64-bit sum and a 64-bit xor).  Where digests differ, rows are compared as
multisets, for those days only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.schemas import FACT_EVENTS

DIGEST = ("n_rows", "hash_sum", "hash_xor")


def row_hash(cols: Sequence[str] = tuple(FACT_EVENTS.names)) -> Column:
    """64-bit hash of a row; a null and an empty value differ, and so do nulls in different columns."""
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in cols])
    return F.xxhash64(*[F.col(c) for c in cols], nulls)


def day_digests(fact: DataFrame) -> DataFrame:
    """One row per day: ``event_date``, ``n_rows``, ``hash_sum``, ``hash_xor``."""
    hashed = fact.select("event_date", row_hash().alias("h"))
    return hashed.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("h").cast("decimal(20,0)")).alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"))


def changed_days(now: DataFrame, before: DataFrame) -> DataFrame:
    """Days whose digests differ, or that only one side has: ``event_date``, ``here`` (still has rows)."""
    a, b = now.alias("a"), before.alias("b")
    same = F.lit(True)
    for c in DIGEST:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    both = a.join(b, F.col("a.event_date") == F.col("b.event_date"), "full")
    return both.where(~same).select(
        F.coalesce("a.event_date", "b.event_date").alias("event_date"), F.col("a.n_rows").isNotNull().alias("here"))


# ---- what a change reaches --------------------------------------------------------------

def days_checked(changed: Iterable[dt.date], present: Iterable[dt.date], running: bool = False) -> list[dt.date]:
    """Days whose rules read a changed day: the day itself and the calendar day after.

    ``running``: a rule reads the newest event so far, so every later day does.
    """
    changed, day = set(changed), dt.timedelta(days=1)
    if running and changed:
        return sorted(d for d in present if d >= min(changed))
    return sorted(d for d in set(present) if d in changed or d - day in changed)


def days_scored(changed: Iterable[dt.date], present: Iterable[dt.date], frame_rows: int) -> list[dt.date]:
    """Days whose frame of ``frame_rows`` preceding rows, or own row, holds (or held) a changed day."""
    days = sorted(set(present))
    out = set()
    for c in set(changed):
        first = next((i for i, d in enumerate(days) if d >= c), len(days))
        here = first < len(days) and days[first] == c
        out.update(days[first:first + frame_rows + here])
    return sorted(out)


# ---- audit of a load --------------------------------------------------------------------

def load_audit(history: DataFrame, daily: DataFrame) -> DataFrame:
    """Per day: is the daily table's content the history's?

    ``state``: ok, missing (no rows), foreign (a day the history lacks), doubled (every
    row k times), partial (rows are missing, none is too many), mixed.  ``missing_rows``
    and ``extra_rows`` count rows too few and too many, ``foreign_rows`` those of the
    extra ones that the history's day does not have at all.

    Digests settle days that are equal, absent or doubled; rows are shuffled (hashes
    only) for the other days.
    """
    a, b = day_digests(history).alias("a"), day_digests(daily).alias("b")
    both = a.join(b, F.col("a.event_date") == F.col("b.event_date"), "full").select(
        F.coalesce("a.event_date", "b.event_date").alias("event_date"),
        F.coalesce("a.n_rows", F.lit(0)).alias("history_rows"), F.coalesce("b.n_rows", F.lit(0)).alias("daily_rows"),
        *[F.col(f"{t}.{c}").alias(f"{t}_{c}") for t in "ab" for c in DIGEST[1:]])
    times = "daily_rows div history_rows"
    both = both.selectExpr("event_date", "history_rows", "daily_rows", f"""CASE
        WHEN daily_rows = 0 THEN 'missing' WHEN history_rows = 0 THEN 'foreign'
        WHEN daily_rows = history_rows AND a_hash_sum = b_hash_sum AND a_hash_xor = b_hash_xor THEN 'ok'
        WHEN daily_rows > history_rows AND daily_rows % history_rows = 0 AND b_hash_sum = a_hash_sum * ({times})
             AND b_hash_xor = if(({times}) % 2 = 0, 0, a_hash_xor) THEN 'doubled' END AS settled""")

    open_days = both.where("settled IS NULL").select("event_date")
    counts = [t.join(F.broadcast(open_days), "event_date").groupBy("event_date", row_hash().alias("h")).agg(
        F.count(F.lit(1)).alias(n)) for t, n in ((history, "x"), (daily, "y"))]  # one row per calendar day is broadcast
    rows = counts[0].join(counts[1], ["event_date", "h"], "full").selectExpr(
        "event_date", "coalesce(x, 0) AS x", "coalesce(y, 0) AS y")
    rows = rows.groupBy("event_date").agg(
        F.expr("sum(greatest(x - y, 0)) AS m"), F.expr("sum(greatest(y - x, 0)) AS e"), F.expr("sum(if(x = 0, y, 0)) AS f"))
    return both.join(rows, "event_date", "left").selectExpr(
        "event_date", "coalesce(settled, CASE WHEN e = 0 THEN 'partial' ELSE 'mixed' END) AS state", "history_rows", "daily_rows",
        "coalesce(m, greatest(history_rows - daily_rows, 0)) AS missing_rows",
        "coalesce(e, greatest(daily_rows - history_rows, 0)) AS extra_rows",
        "coalesce(f, if(history_rows = 0, daily_rows, 0)) AS foreign_rows")
