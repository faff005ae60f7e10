"""Target schemas of the engine's tables and their value domains."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, DT = T.StringType(), T.DoubleType(), T.DateType()
TS, NTZ, L = T.TimestampType(), T.TimestampNTZType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw click-stream file: every column is read as text, so nothing the reader
# guesses can change the strings the surrogate key is hashed from.
EVENTS_RAW = _struct(
    ("event_time", S), ("event_type", S), ("product_id", S), ("category_id", S),
    ("category_code", S), ("brand", S), ("price", S), ("user_id", S), ("user_session", S),
)

# Raw rows that a load could not use, and why.
REJECTED_ROWS = T.StructType(EVENTS_RAW.fields + _struct(("reason", S)).fields)

FACT_EVENTS = _struct(
    ("user_id", S), ("session_id", S), ("product_id", S), ("category_id", S),
    ("category_code", S), ("brand", S), ("event_type", S), ("event_ts", NTZ),
    ("price", D), ("event_id", S), ("event_date", DT),
)

CHECK_RESULTS = _struct(
    ("check_date", DT), ("check_name", S), ("table_name", S), ("severity", S),
    ("status", S), ("metric_value", D), ("expected_range", S), ("failure_details", S),
    ("created_at", TS),
)

ANOMALIES = _struct(
    ("anomaly_date", DT), ("entity_type", S), ("entity_id", S), ("metric_name", S),
    ("actual_value", D), ("baseline_value", D), ("z_score", D), ("pct_change", D),
    ("anomaly_flag", S), ("notes", S), ("created_at", TS),
)

INCIDENTS = _struct(
    ("incident_id", S), ("opened_at", TS), ("closed_at", TS), ("severity", S),
    ("status", S), ("summary", S), ("detected_by", S), ("impacted_assets", S),
    ("root_cause_type", S), ("root_cause_details", S), ("resolution_steps", S),
    ("preventive_actions", S), ("owner", S),
)

# Append-only status log: Parquet has no UPDATE, so a status change is a row.
INCIDENT_STATUS_LOG = _struct(
    ("incident_id", S), ("status", S), ("changed_at", TS), ("note", S),
)

# The stored log also says who wrote a row: "check", "anomaly", or NULL for rows by hand.
STORED_STATUS_LOG = T.StructType(INCIDENT_STATUS_LOG.fields + _struct(("origin", S)).fields)

RUN_CONTEXT = _struct(("run_date", DT), ("max_event_ts", NTZ), ("created_at", TS))

# One row per event day with every aggregate the rules and KPIs need.
DAY_STATS = _struct(
    ("event_date", DT), ("n_events", L), ("n_purchases", L), ("n_null_session", L),
    ("revenue", D), ("max_event_ts", NTZ),
)

# Digest of the history rows that a day was ingested from.
DAY_DIGEST = _struct(("event_date", DT), ("n_rows", L), ("hash_sum", T.DecimalType(38, 0)), ("hash_xor", L))

HEALTH_DAILY = _struct(
    ("check_date", DT), ("total_checks", L), ("p0_issues", L), ("p1_issues", L),
    ("p2_issues", L), ("health_score", L),
)

# Fixed value domains.
SEVERITIES = ("P0", "P1", "P2")
CHECK_STATUSES = ("PASS", "FAIL", "WARN")
INCIDENT_STATUSES = ("OPEN", "TRIAGING", "MITIGATED", "RESOLVED")
ENTITY_TYPES = ("overall", "category", "product")
FLAGS = ("Y", "N")
