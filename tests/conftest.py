from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch import schemas  # noqa: E402
from tidewatch.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app_name="tidewatch-tests")
    yield s
    s.stop()


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def TS(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def fact_rows(spark, rows):
    """Fact rows from dicts; missing columns are NULL, event_date from event_ts."""
    names = [n for n in schemas.FACT_EVENTS.names]
    data = []
    for i, r in enumerate(rows):
        r = dict(r)
        r.setdefault("event_id", f"e{i}")
        if "event_ts" in r and "event_date" not in r:
            r["event_date"] = r["event_ts"].date()
        data.append(tuple(r.get(n) for n in names))
    return spark.createDataFrame(data, schemas.FACT_EVENTS)


def day_events(day: str, n: int, purchases: int = 0, null_sessions: int = 0,
               price: float = 10.0, hour: int = 12):
    """``n`` events on ``day``: the first ``purchases`` are purchases, the first
    ``null_sessions`` have no session."""
    base = TS(f"{day}T{hour:02d}:00:00")
    out = []
    for i in range(n):
        out.append({
            "user_id": f"u{i % 7}", "session_id": None if i < null_sessions else f"s{i}",
            "product_id": f"p{i % 5}", "event_type": "purchase" if i < purchases else "view",
            "event_ts": base + dt.timedelta(seconds=i), "price": price,
            "event_id": f"{day}-{i}",
        })
    return out
