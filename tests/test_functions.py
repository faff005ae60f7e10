"""Column helpers: guarded arithmetic, stable buckets, run parameters, day filters."""

from __future__ import annotations

import datetime as dt

from conftest import D, day_events, fact_rows
from pyspark.sql import functions as F

from tidewatch.functions import arith, dates


def test_guarded_arithmetic_never_throws(spark):
    df = spark.createDataFrame([(1.0, 0.0, None), (3.0, 2.0, 1.0), (None, 2.0, 0.0)], "a double, b double, c double")
    got = df.select(arith.guarded_ratio(F.col("a"), F.col("b")).alias("r"),
                    arith.pct_change(F.col("a"), F.col("b")).alias("p"),
                    arith.z_score(F.col("a"), F.col("b"), F.col("c")).alias("z")).collect()
    assert [tuple(r) for r in got] == [(None, None, None), (1.5, 0.5, 1.0), (None, None, None)]


def test_stable_bucket_is_deterministic_and_spread(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    b = df.select(arith.stable_bucket(F.col("k"), "seed").alias("b"))
    a1 = [r[0] for r in b.collect()]
    a2 = [r[0] for r in df.repartition(7).orderBy("k").select(arith.stable_bucket(F.col("k"), "seed")).collect()]
    assert sorted(a1) == sorted(a2)
    assert min(a1) >= 0 and max(a1) < 10000
    assert 0.18 < sum(1 for x in a1 if x < 2000) / len(a1) < 0.22


def test_run_params_and_spine(spark):
    p = dates.run_params(spark, "2024-03-01").first()
    assert (p["run_date"], p["prev_date"]) == (D("2024-03-01"), D("2024-02-29"))
    spine = [r[0] for r in dates.date_spine(spark, "2024-02-27", "2024-03-02").collect()]
    assert spine == [D("2024-02-27") + dt.timedelta(days=i) for i in range(5)]


def test_on_days_keeps_whole_days_and_pushes_time_range(spark):
    ev = day_events("2024-01-01", 3, hour=23) + day_events("2024-01-02", 4, hour=0) + day_events("2024-01-03", 5)
    fact = fact_rows(spark, ev)
    assert dates.on_days(fact, "2024-01-02").count() == 4
    assert dates.on_days(fact, "2024-01-01", "2024-01-02").count() == 7
