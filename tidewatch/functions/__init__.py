"""Column-level building blocks (built-in Spark expressions only)."""

from tidewatch.functions.arith import guarded_ratio, pct_change, stable_bucket, z_score
from tidewatch.functions.cleaning import (
    blank_to_null,
    event_id_md5,
    normalize_event_type,
    parse_event_ts,
    safe_price_cast,
)
from tidewatch.functions.dates import as_date, date_spine, on_days, prev_calendar_day, run_params

__all__ = [
    "as_date", "blank_to_null", "date_spine", "event_id_md5", "guarded_ratio",
    "normalize_event_type", "on_days", "parse_event_ts", "pct_change", "prev_calendar_day",
    "run_params", "safe_price_cast", "stable_bucket", "z_score",
]
