"""Raw text → typed, keyed history rows (the load step)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.cleaning import (
    blank_to_null,
    event_id_md5,
    normalize_event_type,
    parse_event_ts,
    safe_price_cast,
)
from tidewatch.schemas import EVENTS_RAW


def clean_events(raw: DataFrame) -> DataFrame:
    """Type and key raw events; rows whose time does not parse are dropped.

    - ids are kept as text;
    - category_code and brand: trimmed, blank → NULL;
    - event_type: trimmed, lower-cased, blank → NULL;
    - event_ts: ``... UTC`` text parsed as zone-less timestamp;
    - price: plain-number text → double, else NULL;
    - event_id: MD5 over the *raw* (untrimmed) values, NULLs skipped.

    The time is parsed once: it is produced by a one-element generator
    (``explode(array(parse))``), and Catalyst never pushes a filter on a
    generated column below its generator -- a plain projection + filter
    would be rewritten to evaluate the (regex + cast) parse twice.  The
    remaining columns are computed after the filter, for kept rows only.
    """
    return _parsed(raw).where(F.col("_event_ts").isNotNull()).select(*_typed())


def _parsed(raw: DataFrame) -> DataFrame:
    return raw.select("*", F.explode(F.array(parse_event_ts("event_time"))).alias("_event_ts"))


def _typed() -> list[Column]:
    return [
        F.col("user_id").cast("string").alias("user_id"),
        F.col("user_session").cast("string").alias("session_id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("category_id").cast("string").alias("category_id"),
        blank_to_null("category_code").alias("category_code"),
        blank_to_null("brand").alias("brand"),
        normalize_event_type("event_type").alias("event_type"),
        F.col("_event_ts").alias("event_ts"),
        safe_price_cast("price").alias("price"),
        event_id_md5("user_id", "user_session", "event_time", "event_type", "product_id",
                     "price").alias("event_id"),
        F.to_date("_event_ts").alias("event_date"),
    ]


def sorted_out(raw: DataFrame) -> DataFrame:
    """Every raw row once: ``kept`` (the ``clean_events`` row, or NULL), ``raw`` and ``reason`` (of rejected rows).

    For loads that keep what they reject: both kinds come from one scan and one parse.
    """
    reason = F.when(F.nullif(F.trim("event_time"), F.lit("")).isNull(), F.lit("no event time")).otherwise(F.lit("unreadable event time"))
    good = F.col("_event_ts").isNotNull()
    rows = F.struct(*[F.col(c).cast("string").alias(c) for c in EVENTS_RAW.names])
    return _parsed(raw).select(
        F.when(good, F.struct(*_typed())).alias("kept"), F.when(~good, rows).alias("raw"), F.when(~good, reason).alias("reason"),
        (unread_price()).alias("unread_price"))


def unread_price() -> Column:
    """A price text that is not blank and not a number."""
    return F.nullif(F.trim(F.col("price")), F.lit("")).isNotNull() & safe_price_cast("price").isNull()


def load_counts(raw: DataFrame) -> DataFrame:
    """One row: raw rows, rows the load rejects (time does not parse), prices it cannot read."""
    return raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(parse_event_ts("event_time").isNull()).alias("rejected_rows"),
        F.count_if(unread_price()).alias("unread_prices"))


def distinct_event_dates(fact: DataFrame) -> DataFrame:
    """Days present in a fact table, as ``d`` (ascending when ordered)."""
    return fact.select(F.col("event_date").alias("d")).distinct()
