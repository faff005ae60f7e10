"""Adapter from the driver's test tables to the engine's event shapes.

The engine monitors a click-stream fact table.  The test data carries an
``events`` table (event_id, ts, user_id, event_type, value, props) and a
``part`` catalogue; this module maps them onto

- the raw file shape (all text, what a CSV of the stream would hold), and
- the typed ``fact_events`` shape,

with the same meaning in Spark and in the SQL oracle:

==============  =======================================================
user_id         text of ``user_id``
session_id      ``props.k`` as text, ``'0'`` meaning "no session"
product_id      ``event_id`` modulo (largest ``p_partkey`` + 1): every part is a product
category_id     text of ``p_size``; category_code ``p_type``; brand ``p_brand``
event_ts/price  ``ts`` / ``value``
raw time text   ``yyyy-MM-dd HH:mm:ss UTC``; raw price text: 2-decimal text
==============  =======================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.cleaning import KEY_SEPARATOR

# Fixed values of the adapter: the "no session" marker and the raw text formats.
NO_SESSION = "0"
RAW_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
RAW_TIME_SUFFIX = " UTC"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table as a DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _product_catalog(part: DataFrame) -> DataFrame:
    """Every part, one row per key.

    Grouping by the key states its uniqueness to Catalyst (``max`` returns the
    row's own values): a query that uses no catalogue column then loses the left
    join altogether.  Whether this side is broadcast is left to AQE.
    """
    return part.groupBy("p_partkey").agg(
        F.expr("CAST(max(p_size) AS STRING) AS category_id"),
        F.expr("max(p_type) AS category_code"),
        F.expr("max(p_brand) AS brand"),
    )


# The raw click-stream text of each column, as SQL over the joined events.
SESSION_SQL = f"nullif(get_json_object(props, '$.k'), '{NO_SESSION}')"
RAW_SQL = {
    "event_time": f"concat(date_format(ts, '{RAW_TIME_FORMAT}'), '{RAW_TIME_SUFFIX}')",
    "event_type": "event_type",
    "product_id": "CAST(product_key AS STRING)",
    "category_id": "category_id",
    "category_code": "category_code",
    "brand": "brand",
    "price": "CAST(CAST(value AS DECIMAL(18,2)) AS STRING)",
    "user_id": "CAST(user_id AS STRING)",
    "user_session": SESSION_SQL,
}
# Surrogate-key input order (fixed): user, session, time, type, product, price.
KEY_FIELDS = ("user_id", "user_session", "event_time", "event_type", "product_id", "price")


def _events_with_catalog(events: DataFrame, part: DataFrame) -> DataFrame:
    products = part.select(F.max("p_partkey") + 1).scalar()
    e = events.select("event_id", "ts", "user_id", "event_type", "value", "props",
                      (F.col("event_id") % products).alias("product_key"))
    return e.join(_product_catalog(part), F.expr("product_key = p_partkey"), "left")


def raw_events(events: DataFrame, part: DataFrame) -> DataFrame:
    """The test events as raw click-stream text (the CSV shape, all strings)."""
    e = _events_with_catalog(events, part)
    return e.selectExpr(*[f"{sql} AS {name}" for name, sql in RAW_SQL.items()])


def fact_events(events: DataFrame, part: DataFrame) -> DataFrame:
    """The test events in ``fact_events`` shape (typed, keyed, with event_date)."""
    e = _events_with_catalog(events, part)
    key = ", ".join(RAW_SQL[f] for f in KEY_FIELDS)
    return e.selectExpr(
        f"{RAW_SQL['user_id']} AS user_id",
        f"{SESSION_SQL} AS session_id",
        f"{RAW_SQL['product_id']} AS product_id",
        "category_id", "category_code", "brand", "event_type",
        "ts AS event_ts",
        "value AS price",
        f"md5(concat_ws('{KEY_SEPARATOR}', {key})) AS event_id",
        "to_date(ts) AS event_date",
    )


def fact_events_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_events(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "part"))


def raw_events_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "part"))


# The same events as a careless producer would write them, by fixed rules on event_id:
# several time shapes (and none), padded, blank and odd-case text, bad prices, every
# 20th event of even days twice, no events on the 7th, none after 20:00 on the 12th and no purchases
# on the 15th of a month.
DIRTY_SQL = RAW_SQL | {
    "event_time": (f"CASE event_id % 13 WHEN 1 THEN date_format(ts, 'yyyy/M/d H:m:s') "
                   "WHEN 2 THEN concat(date_format(ts, 'yyyy-MM-dd'), 'T', date_format(ts, 'HH:mm:ss'), 'Z') "
                   f"WHEN 3 THEN concat('  ', date_format(ts, '{RAW_TIME_FORMAT}'), ' ') "
                   f"WHEN 4 THEN concat(date_format(ts, '{RAW_TIME_FORMAT}'), '+02') "
                   "WHEN 5 THEN 'junk' WHEN 6 THEN '' WHEN 7 THEN NULL "
                   f"ELSE {RAW_SQL['event_time']} END"),
    "event_type": ("CASE WHEN event_type = 'purchase' AND day(ts) = 15 THEN 'view' "
                   "WHEN event_id % 5 = 1 THEN upper(event_type) WHEN event_id % 5 = 2 THEN concat(' ', event_type, ' ') "
                   "WHEN event_id % 45 = 3 THEN '  ' ELSE event_type END"),
    "brand": "CASE event_id % 7 WHEN 1 THEN '  ' WHEN 2 THEN concat(' ', brand, ' ') ELSE brand END",
    "category_code": "CASE event_id % 9 WHEN 1 THEN '' ELSE category_code END",
    "price": ("CASE event_id % 17 WHEN 1 THEN 'abc' WHEN 2 THEN '1_000.5' WHEN 3 THEN '' WHEN 4 THEN ' 12.5 ' "
              f"WHEN 5 THEN '1e3' ELSE {RAW_SQL['price']} END"),
}
DIRTY_KEEP = "day(ts) <> 7 AND NOT (day(ts) = 12 AND hour(ts) >= 20)"


def dirty_events_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test events as careless raw text."""
    e = _events_with_catalog(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "part")).where(DIRTY_KEEP)
    twice = F.explode(F.expr("CASE WHEN event_id % 20 = 0 AND day(ts) % 2 = 0 THEN array(1, 2) ELSE array(1) END"))
    return e.select("*", twice.alias("copy")).selectExpr(*[f"{sql} AS {name}" for name, sql in DIRTY_SQL.items()])
