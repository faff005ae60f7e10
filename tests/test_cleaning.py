"""Raw text → typed rows: timestamp, blank, event type, price and key edge cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.operators.clean import clean_events
from tidewatch.schemas import EVENTS_RAW


def raw_df(spark, rows):
    names = EVENTS_RAW.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], EVENTS_RAW)


def test_timestamp_text_shapes(spark):
    cases = {
        "2019-11-01 00:00:00 UTC": dt.datetime(2019, 11, 1, 0, 0, 0),
        "2019-11-01 10:20:30": dt.datetime(2019, 11, 1, 10, 20, 30),
        "2019-11-01": dt.datetime(2019, 11, 1),
        "2019-11-01 00:00:00UTC": None,  # no space before the zone: not a time
        "2019-11-01 10:00:00+02": dt.datetime(2019, 11, 1, 10),  # the zone is left out
        "2019-11-01T10:00:00Z": dt.datetime(2019, 11, 1, 10),
        "2019-1-1": dt.datetime(2019, 1, 1),
        "2019/11/01": dt.datetime(2019, 11, 1),
        "  2019-11-01 0:0:0 ": dt.datetime(2019, 11, 1),
        "2019-13-01": None,
        "10:00:00": None,  # time without a date
        "": None,
        "junk": None,
        None: None,
    }
    df = raw_df(spark, [{"event_time": k, "user_id": str(i)} for i, k in enumerate(cases)])
    from tidewatch.functions.cleaning import parse_event_ts

    got = {r["event_time"]: r["ts"] for r in df.select("event_time", parse_event_ts("event_time").alias("ts")).collect()}
    assert got == cases


def test_clean_drops_unparseable_times_and_normalises(spark):
    rows = [
        {"event_time": "2019-11-01 00:00:00 UTC", "event_type": " Purchase ", "brand": "",
         "category_code": "  ", "price": "12.5", "user_id": "1", "user_session": "s",
         "product_id": "9", "category_id": "3"},
        {"event_time": "2019-11-01 01:00:00 UTC", "event_type": "VIEW", "brand": "\tacme",
         "category_code": "a.b", "price": "abc", "user_id": "2", "user_session": None,
         "product_id": "9", "category_id": "3"},
        {"event_time": "2019-11-01 02:00:00 UTC", "event_type": "  ", "brand": " x ",
         "price": "", "user_id": "3", "user_session": "t", "product_id": "9"},
        {"event_time": "junk", "event_type": "view", "user_id": "4"},
    ]
    out = {r["user_id"]: r for r in clean_events(raw_df(spark, rows)).collect()}
    assert set(out) == {"1", "2", "3"}
    assert out["1"]["event_type"] == "purchase" and out["1"]["brand"] is None
    assert out["1"]["category_code"] is None and out["1"]["price"] == 12.5
    assert out["2"]["event_type"] == "view" and out["2"]["brand"] == "\tacme"  # tab kept
    assert out["2"]["price"] is None and out["2"]["session_id"] is None
    assert out["3"]["event_type"] is None and out["3"]["brand"] == "x" and out["3"]["price"] is None
    assert out["1"]["event_date"] == dt.date(2019, 11, 1)


def test_price_cast_rejects_lenient_suffixes(spark):
    from tidewatch.functions.cleaning import safe_price_cast

    df = spark.createDataFrame([("1d",), ("1.5",), (" 2 ",), ("-3e2",), ("1f",), (None,)], "p string")
    got = [r[0] for r in df.select(safe_price_cast("p")).collect()]
    assert got == [None, 1.5, 2.0, -300.0, None, None]


def test_price_cast_keeps_what_a_number_cast_keeps(spark):
    import math

    from tidewatch.functions.cleaning import safe_price_cast

    df = spark.createDataFrame([("1_000",), ("inf",), ("-Infinity",), ("nan",), ("1.",), (".5",), ("1__0",), ("_1",), ("1,0",)],
                               "p string")
    got = [r[0] for r in df.select(safe_price_cast("p")).collect()]
    assert got[:3] == [1000.0, math.inf, -math.inf] and math.isnan(got[3]) and got[4:] == [1.0, 0.5, None, None, None]


def test_event_id_is_md5_of_raw_values_skipping_nulls(spark):
    from tidewatch.functions.cleaning import event_id_md5

    df = spark.createDataFrame([("a", None, "b")], "x string, y string, z string")
    got = df.select(event_id_md5("x", "y", "z").alias("k"), F.md5(F.lit("a|b")).alias("e")).first()
    assert got["k"] == got["e"]  # NULL skipped: ('a', NULL, 'b') hashes like 'a|b'


def test_event_id_uses_untrimmed_text(spark):
    rows = [{"event_time": "2019-11-01 00:00:00 UTC", "event_type": " Purchase ", "user_id": "1",
             "user_session": "s", "product_id": "9", "price": "12.5"}]
    r = clean_events(raw_df(spark, rows)).first()
    import hashlib

    expect = hashlib.md5("1|s|2019-11-01 00:00:00 UTC| Purchase |9|12.5".encode()).hexdigest()
    assert r["event_id"] == expect
