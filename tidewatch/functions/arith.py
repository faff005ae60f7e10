"""Guarded arithmetic: no expression here can throw under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)`` as double; NULL when the denominator is 0 or NULL."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def z_score(actual: Column, baseline: Column, sd: Column) -> Column:
    """``(actual - baseline) / sd``; NULL when sd is NULL or 0."""
    return guarded_ratio(actual - baseline, sd)


def pct_change(actual: Column, previous: Column) -> Column:
    """Fractional change against the previous value; NULL when it is NULL or 0."""
    return guarded_ratio(actual - previous, previous)


def stable_bucket(key: Column, seed: str, buckets: int = 10_000) -> Column:
    """A bucket in ``[0, buckets)`` taken from MD5 of ``seed|key``.

    Deterministic per row, so a task that is re-run after executor loss masks
    exactly the same rows (``rand()`` would depend on the partitioning).
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)
