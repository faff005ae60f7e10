"""Every registered query against its DuckDB SQL, and plan properties."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest
from conftest import SF_SMALL

from __spark_entry__ import entry
from __spark_entry__ import queries as every_query
from tidewatch.plans.oracle import oracle_sql
from tidewatch.plans.queries import queries

NAMES = sorted(queries())


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "part", "orders", "lineitem", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries()) <= set(every_query())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    order = lambda cs: sorted(range(len(cs)), key=lambda i: cs[i])
    a = Counter(tuple(norm(r[i]) for i in order(cols)) for r in got)
    b = Counter(tuple(norm(r[i]) for i in order(dcols)) for r in want)
    assert a == b


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["anomaly_date", "entity_type", "entity_id", "metric_name", "actual_value",
                          "baseline_value", "z_score", "pct_change", "anomaly_flag", "notes"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dq_checks_all_days", "anomalies_all_days", "anomalies_by_entity",
                                  "check_dup_composite_key", "clean_events", "checks_with_incidents"])
def test_no_python_udf_in_plans(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_one_day_read_prunes_partitions(spark):
    from tidewatch.plans import daily
    from tidewatch.sources import test_tables as TT
    from tidewatch.sources.tables import Store

    store = Store.scratch(spark, "t_plan")
    daily.load_history(store, TT.fact_events_from_dir(spark, SF_SMALL))
    from pyspark.sql import functions as F

    day = store.read("fact_events_all").where(F.col("event_date") == F.lit(dt.date(2024, 1, 5)))
    plan = _plan(day)
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-05" in plan


def test_events_day_filter_reaches_parquet(spark):
    df = queries()["events_on_run_date"](spark, SF_SMALL)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_checks_scan_events_once(spark):
    plan = _plan(queries()["dq_checks_all_days"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1
    assert "part.parquet" not in plan  # unused catalogue join removed
