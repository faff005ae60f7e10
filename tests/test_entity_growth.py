"""Entity scoring over many series: nothing that grows with them is broadcast or sorted once per metric."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tests.conftest import D
from tidewatch.operators import anomalies as A
from tidewatch.operators import series_state as SS

KPIS = "d date, entity_type string, entity_id string, events_count double, purchases double, revenue double, cvr double"


def _kpis(spark, days=20):
    rng, rows = random.Random(3), []
    for e in ("a", "b", "", None, "c"):
        for i in range(days):
            if rng.random() < 0.8:
                n = float(rng.randint(0, 5))
                rows.append((D("2024-01-01") + dt.timedelta(days=i), "product", e, n, min(n, 2.0), rng.choice([None, 1.5, n]),
                             min(n, 2.0) / n if n else None))
    return spark.createDataFrame(rows, KPIS)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_metrics_are_unpivoted_after_the_window(spark):
    kpis = _kpis(spark)
    got, want = A.score_kpis(kpis), A.score(A.kpis_long(kpis, None, "entity_id"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() == 3 * kpis.count()
    plan = _plan(A.anomalies_by_entity(spark.createDataFrame(
        [("p", "c", "view", 1.0, D("2024-01-01"))], "product_id string, category_id string, event_type string, price double, event_date date")))
    assert plan.index("stack(") < plan.index("Window ")  # a plan is printed from the result down


def test_the_state_is_not_broadcast(spark, tmp_path):
    kpis = _kpis(spark)
    day = D("2024-01-20")
    SS.state_of(kpis.where(F.col("d") < F.lit(day)), buckets=4).write.parquet(f"{tmp_path}/state")
    kpis.where(F.col("d") == F.lit(day)).write.parquet(f"{tmp_path}/today")
    state, today = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("state", "today"))
    got = SS.score_day(state, today, day)
    assert "Broadcast" not in _plan(got) and "Broadcast" not in _plan(SS.advanced(state, today, day))
    want = A.score(A.kpis_long(kpis, None, "entity_id")).where(F.col("anomaly_date") == F.lit(day)).select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_series_without_rows_of_the_day_keep_their_history(spark):
    kpis = _kpis(spark, 40)
    day = D("2024-02-05")
    state = SS.state_of(kpis.where(F.col("d") < F.lit(day)))
    for d in (day, day, D("2024-01-20")):  # a day more, the same again, an older one that has no rows any more
        today = kpis.where((F.col("d") == F.lit(day)) & (F.lit(d) == F.lit(day)))
        state = SS.advanced(state, today, d)
    left = kpis.where((F.col("d") <= F.lit(day)) & (F.col("d") != F.lit(D("2024-01-20"))))
    got = {r["entity_key"]: [x["d"] for x in r["history"]] for r in state.collect()}
    want = {r["entity_key"]: [x["d"] for x in r["history"]] for r in SS.state_of(left).collect()}
    assert got.keys() == want.keys() and all(want[k][-len(v):] == v and len(v) >= len(want[k]) - 1 for k, v in got.items())
    assert all(r["last_day"] == r["history"][-1]["d"] for r in state.collect())
