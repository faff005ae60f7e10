"""DuckDB SQL with the same meaning as each registered query.

Views ``events``, ``part`` (and the other test tables) are registered by the
caller.  Doubles are rounded to 6 decimals, as on the Spark side.
"""

from __future__ import annotations

import datetime as dt

from tidewatch.plans.queries import (
    DIGITS,
    MANUAL_ID,
    DETAIL_CHECK,
    RUN_DATE,
    SPIKE_DAY,
    TOP_N,
    VOLUME_MIN_DIRTY,
    VOLUME_MIN_MIX,
    WARN_BELOW,
    WARN_NULL_PCT,
)
from tidewatch.plans.daily import SPIKE_RATE, SPIKE_SEED

RD = f"DATE '{RUN_DATE.isoformat()}'"

SESSION = "NULLIF(json_extract_string(e.props, '$.k'), '0')"
PRODUCT = "CAST(e.product_key AS VARCHAR)"
EVENTS = ("(SELECT *, event_id % (SELECT max(p_partkey) + 1 FROM part) AS product_key FROM events) e "
          "LEFT JOIN part p ON p.p_partkey = e.product_key")
RAW_TIME = "strftime(e.ts, '%Y-%m-%d %H:%M:%S') || ' UTC'"
RAW_PRICE = "CAST(CAST(e.value AS DECIMAL(18,2)) AS VARCHAR)"

RAW_CTE = f"""raw_events AS (
  SELECT {RAW_TIME} AS event_time, e.event_type AS event_type, {PRODUCT} AS product_id,
         CAST(p.p_size AS VARCHAR) AS category_id, p.p_type AS category_code, p.p_brand AS brand,
         {RAW_PRICE} AS price, CAST(e.user_id AS VARCHAR) AS user_id, {SESSION} AS user_session
  FROM {EVENTS}
)"""

FACT_CTE = f"""fact_events AS (
  SELECT CAST(e.user_id AS VARCHAR) AS user_id, {SESSION} AS session_id, {PRODUCT} AS product_id,
         CAST(p.p_size AS VARCHAR) AS category_id, p.p_type AS category_code, p.p_brand AS brand,
         e.event_type AS event_type, e.ts AS event_ts, e.value AS price,
         md5(concat_ws('|', CAST(e.user_id AS VARCHAR), {SESSION}, {RAW_TIME}, e.event_type,
                       {PRODUCT}, {RAW_PRICE})) AS event_id,
         CAST(e.ts AS DATE) AS event_date
  FROM {EVENTS}
)"""

KPI_CTE = """kpis AS (
  SELECT event_date AS d,
         CAST(count(*) AS DOUBLE) AS events_count,
         CAST(count_if(event_type = 'purchase') AS DOUBLE) AS purchases,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN TRY_CAST(price AS DECIMAL(22,4))
                       ELSE 0 END) AS DOUBLE) AS revenue
  FROM fact_events GROUP BY event_date
),
kpis_cvr AS (
  SELECT *, CASE WHEN events_count = 0 THEN NULL ELSE purchases / events_count END AS cvr FROM kpis
),
kpi_rows AS (
  SELECT d AS anomaly_date, 'overall' AS entity_type, CAST(NULL AS VARCHAR) AS entity_id,
         'events_count' AS metric_name, events_count AS actual_value FROM kpis_cvr
  UNION ALL
  SELECT d, 'overall', CAST(NULL AS VARCHAR), 'revenue', revenue FROM kpis_cvr
  UNION ALL
  SELECT d, 'overall', CAST(NULL AS VARCHAR), 'cvr', cvr FROM kpis_cvr
)"""


def scored_cte(src: str = "kpi_rows") -> str:
    return f"""with_base AS (
  SELECT *,
    avg(actual_value) OVER (PARTITION BY entity_type, entity_id, metric_name ORDER BY anomaly_date
                            ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS baseline_value,
    stddev_samp(actual_value) OVER (PARTITION BY entity_type, entity_id, metric_name ORDER BY anomaly_date
                            ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS baseline_sd,
    lag(actual_value) OVER (PARTITION BY entity_type, entity_id, metric_name ORDER BY anomaly_date) AS prev_value
  FROM {src}
),
with_z AS (
  SELECT *,
    CASE WHEN baseline_sd IS NULL OR baseline_sd = 0 THEN NULL
         ELSE (actual_value - baseline_value) / baseline_sd END AS z_score,
    CASE WHEN prev_value IS NULL OR prev_value = 0 THEN NULL
         ELSE (actual_value - prev_value) / prev_value END AS pct_change
  FROM with_base
),
scored AS (
  SELECT anomaly_date, entity_type, entity_id, metric_name, actual_value, baseline_value,
    z_score, pct_change,
    CASE
      WHEN baseline_value IS NULL THEN 'N'
      WHEN abs(z_score) > 3 THEN 'Y'
      WHEN metric_name = 'events_count' AND abs(pct_change) > 0.60 THEN 'Y'
      WHEN metric_name = 'revenue' AND (pct_change > 0.60 OR pct_change < -0.40) THEN 'Y'
      WHEN metric_name = 'cvr' AND abs(pct_change) > 0.50 THEN 'Y'
      ELSE 'N' END AS anomaly_flag,
    CASE metric_name
      WHEN 'events_count' THEN 'z>|3| OR day_change>|60%|'
      WHEN 'revenue' THEN 'z>|3| OR +60% / -40% day_change'
      ELSE 'z>|3| OR day_change>|50%|' END AS notes
  FROM with_z
)"""


STATS_CTE = """stats AS (
  SELECT event_date, count(*) AS n_events, count_if(event_type = 'purchase') AS n_purchases,
         count_if(session_id IS NULL) AS n_null_session, max(event_ts) AS max_event_ts
  FROM fact_events GROUP BY event_date
),
latest AS (
  SELECT event_date, max(max_event_ts) OVER (ORDER BY event_date
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS latest_event_ts
  FROM stats
),
dups AS (
  SELECT event_date, count(*) AS dup_groups FROM (
    SELECT event_date FROM fact_events
    GROUP BY event_date, user_id, session_id, event_ts, event_type, product_id
    HAVING count(*) > 1) g
  GROUP BY event_date
),
dups_coarse AS (
  SELECT event_date, count(*) AS dup_groups FROM (
    SELECT event_date FROM fact_events GROUP BY event_date, user_id, event_type
    HAVING count(*) > 1) g
  GROUP BY event_date
),
cal AS (
  SELECT s.event_date AS check_date,
         s.n_events AS n0, s.n_purchases AS np0, s.n_null_session AS nn0,
         s.max_event_ts AS mx0, l.latest_event_ts AS latest0,
         COALESCE(d.dup_groups, 0) AS dup0, COALESCE(dc.dup_groups, 0) AS dupc0,
         COALESCE(y.n_events, 0) AS n1, COALESCE(y.n_purchases, 0) AS np1
  FROM stats s
  LEFT JOIN stats y ON y.event_date = s.event_date - 1
  LEFT JOIN latest l ON l.event_date = s.event_date
  LEFT JOIN dups d ON d.event_date = s.event_date
  LEFT JOIN dups_coarse dc ON dc.event_date = s.event_date
)"""

CHECK_COLS = ("check_date, check_name, table_name, severity, status, metric_value, "
              "expected_range, failure_details")


def rule_sql(name: str, sev: str, metric: str, cond: str, expected: str, failure: str,
             src: str = "cal") -> str:
    return f"""SELECT check_date, '{name}' AS check_name, 'core.fact_events' AS table_name,
    '{sev}' AS severity, CASE WHEN {cond.format(m='m')} THEN 'PASS' ELSE 'FAIL' END AS status,
    m AS metric_value, '{expected}' AS expected_range,
    CASE WHEN {cond.format(m='m')} THEN NULL ELSE '{failure}' END AS failure_details
  FROM (SELECT check_date, CAST({metric} AS DOUBLE) AS m FROM {src}) r"""


def warning(sql: str, cond: str) -> str:
    """A rule's SQL with rows that fail but meet ``cond`` (over m) as warnings."""
    return sql.replace("THEN 'PASS' ELSE 'FAIL' END", f"THEN 'PASS' WHEN {cond} THEN 'WARN' ELSE 'FAIL' END")


HOURS_TO_END = "date_diff('microsecond', {ts}, CAST(check_date + 1 AS TIMESTAMP)) / 3.6e9"

RULES = {
    "freshness": rule_sql("freshness_has_events_on_run_date", "P0", "COALESCE(n0, 0)", "{m} > 0",
                          "> 0 rows on run_date", "No events found for run_date"),
    "volume": rule_sql("volume_prev_day_events_min_1000", "P0", "n1", "{m} >= 1000", ">= 1000",
                       "Previous day events below 1000"),
    "volume_mix": rule_sql(f"volume_prev_day_events_min_{VOLUME_MIN_MIX}", "P0", "n1",
                           f"{{m}} >= {VOLUME_MIN_MIX}", f">= {VOLUME_MIN_MIX}",
                           f"Previous day events below {VOLUME_MIN_MIX}"),
    "volume_dirty": rule_sql(f"volume_prev_day_events_min_{VOLUME_MIN_DIRTY}", "P0", "n1",
                             f"{{m}} >= {VOLUME_MIN_DIRTY}", f">= {VOLUME_MIN_DIRTY}",
                             f"Previous day events below {VOLUME_MIN_DIRTY}"),
    "purchase_prev": rule_sql("purchase_events_vanish_prev_day", "P0", "np1", "{m} > 0", "> 0",
                              "No purchases on previous day"),
    "null_rate": rule_sql("null_rate_session_id_run_date", "P1",
                          "100.0 * CAST(nn0 AS DOUBLE) / NULLIF(CAST(n0 AS DOUBLE), 0)",
                          "{m} <= 1.0", "<= 1%", "session_id null% exceeded 1% on run_date"),
    "dup": rule_sql("dup_composite_key_groups_run_date", "P0", "dup0", "{m} = 0", "= 0 groups",
                    "Duplicate groups found on run_date"),
    "dup_coarse": rule_sql("dup_composite_key_groups_run_date", "P0", "dupc0", "{m} = 0",
                           "= 0 groups", "Duplicate groups found on run_date"),
    "purchase_run": rule_sql("purchase_events_on_run_date", "P0", "np0", "{m} > 0",
                             "> 0 purchases", "No purchases found on run_date"),
    "latest_in_day": rule_sql("freshness_latest_event_within_run_day", "P0",
                              HOURS_TO_END.format(ts="mx0"), "{m} <= 1.0",
                              "<= 1h before end of run_date",
                              "Latest event_ts more than 1h before end of run_date"),
    "latest_24h": rule_sql("freshness_latest_event_within_24h", "P0",
                           HOURS_TO_END.format(ts="latest0"), "{m} <= 24.0", "<= 24h",
                           "Latest event_ts older than 24h"),
}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _round(sql: str, cols: list[str], bigints: list[str] = ()) -> str:
    """Round double columns as the Spark side does; make integer counts BIGINT
    (DuckDB's ``count_if`` is HUGEINT, Spark's is bigint)."""
    rep = [f"round({c}, {DIGITS}) AS {c}" for c in cols]
    rep += [f"CAST({c} AS BIGINT) AS {c}" for c in bigints]
    if not rep:
        return sql
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM (\n{sql}\n) rounded_q"


DEFAULT_CHECKS = "\nUNION ALL\n".join(RULES[k] for k in ("freshness", "volume", "purchase_prev", "null_rate"))
CHECKS_CTE = f"checks AS (\n{DEFAULT_CHECKS}\n)"

# Incident catalogue rows needed by the default rules (kind, slug, summary,
# impacted, root cause type, details, steps, actions).
def _catalog_values() -> str:
    from tidewatch.operators.incidents import CATALOG

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    rows = [f"({q(k)}, {', '.join(q(x) for x in v)})" for k, v in CATALOG.items()]
    return ("catalog(rule_kind, slug, summary, impacted, root_cause_type, root_cause_details, "
            "resolution_steps, preventive_actions) AS (VALUES " + ", ".join(rows) + ")")


INCIDENT_CTES = f"""{_catalog_values()},
failing AS (
  SELECT c.*, regexp_replace(check_name, '_(min_)?[0-9]+(\\.[0-9]+)?h?$', '') AS rule_kind
  FROM checks c WHERE status <> 'PASS'
),
incidents AS (
  SELECT 'INC-' || strftime(f.check_date, '%Y-%m-%d') || '-'
           || COALESCE(k.slug, upper(replace(f.rule_kind, '_', '-'))) AS incident_id,
         CAST(f.check_date AS TIMESTAMP) AS opened_at, CAST(NULL AS TIMESTAMP) AS closed_at,
         f.severity, 'OPEN' AS status,
         COALESCE(k.summary, f.check_name) || ' on ' || strftime(f.check_date, '%Y-%m-%d') || '.' AS summary,
         f.check_name AS detected_by,
         concat_ws('; ', f.table_name, k.impacted) AS impacted_assets,
         k.root_cause_type, k.root_cause_details, k.resolution_steps, k.preventive_actions,
         'data-reliability' AS owner,
         f.check_date AS inc_day
  FROM failing f LEFT JOIN catalog k ON k.rule_kind = f.rule_kind
),
next_pass AS (
  SELECT c.check_date, c.check_name,
    (SELECT min(p.check_date) FROM checks p
      WHERE p.check_name = c.check_name AND p.status = 'PASS' AND p.check_date > c.check_date) AS next_pass
  FROM checks c WHERE c.status <> 'PASS'
),
status_log AS (
  SELECT i.incident_id, 'OPEN' AS status, i.opened_at AS changed_at, 'opened by failing check' AS note
  FROM incidents i
  UNION ALL
  SELECT i.incident_id, 'RESOLVED', CAST(n.next_pass AS TIMESTAMP),
         'check passed again on ' || strftime(n.next_pass, '%Y-%m-%d')
  FROM incidents i JOIN next_pass n ON n.check_name = i.detected_by AND n.check_date = i.inc_day
  WHERE n.next_pass IS NOT NULL
),
latest_status AS (
  SELECT incident_id, status, changed_at FROM (
    SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY changed_at DESC,
      CASE status WHEN 'OPEN' THEN 1 WHEN 'TRIAGING' THEN 2 WHEN 'MITIGATED' THEN 3
                  WHEN 'RESOLVED' THEN 4 END DESC) AS rn
    FROM status_log) t WHERE rn = 1
),
current_incidents AS (
  SELECT i.incident_id, i.opened_at,
         CASE WHEN s.status = 'RESOLVED' THEN s.changed_at ELSE i.closed_at END AS closed_at,
         i.severity, COALESCE(s.status, i.status) AS status, i.summary, i.detected_by,
         i.impacted_assets, i.root_cause_type, i.root_cause_details, i.resolution_steps,
         i.preventive_actions, i.owner, i.inc_day
  FROM incidents i LEFT JOIN latest_status s ON s.incident_id = i.incident_id
)"""

INCIDENT_COLS = ("incident_id, opened_at, closed_at, severity, status, summary, detected_by, "
                 "impacted_assets, root_cause_type, root_cause_details, resolution_steps, "
                 "preventive_actions, owner")

FACT_COLS = ("user_id, session_id, product_id, category_id, category_code, brand, event_type, "
             "event_ts, price, event_id, event_date")
ANOMALY_COLS = ("anomaly_date, entity_type, entity_id, metric_name, actual_value, baseline_value, "
                "z_score, pct_change, anomaly_flag, notes")
ANOMALY_DBL = ["actual_value", "baseline_value", "z_score", "pct_change"]

CLEAN_SELECT = """SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(user_session AS VARCHAR) AS session_id,
    CAST(product_id AS VARCHAR) AS product_id, CAST(category_id AS VARCHAR) AS category_id,
    NULLIF(trim(category_code), '') AS category_code, NULLIF(trim(brand), '') AS brand,
    lower(NULLIF(trim(event_type), '')) AS event_type,
    CASE WHEN event_time LIKE '%UTC' THEN TRY_CAST(replace(event_time, ' UTC', '') AS TIMESTAMP)
         ELSE TRY_CAST(event_time AS TIMESTAMP) END AS event_ts,
    TRY_CAST(price AS DOUBLE) AS price,
    md5(concat_ws('|', user_id, user_session, event_time, event_type, product_id, price)) AS event_id
  FROM raw_events"""

# Careless raw text: the same rules as in the Spark adapter.
DIRTY_CTE = f"""raw_events AS (
  SELECT CASE e.event_id % 13
           WHEN 1 THEN strftime(e.ts, '%Y/%-m/%-d %-H:%-M:%-S')
           WHEN 2 THEN strftime(e.ts, '%Y-%m-%dT%H:%M:%SZ')
           WHEN 3 THEN '  ' || strftime(e.ts, '%Y-%m-%d %H:%M:%S') || ' '
           WHEN 4 THEN strftime(e.ts, '%Y-%m-%d %H:%M:%S') || '+02'
           WHEN 5 THEN 'junk' WHEN 6 THEN '' WHEN 7 THEN NULL ELSE {RAW_TIME} END AS event_time,
         CASE WHEN e.event_type = 'purchase' AND day(e.ts) = 15 THEN 'view'
              WHEN e.event_id % 5 = 1 THEN upper(e.event_type)
              WHEN e.event_id % 5 = 2 THEN ' ' || e.event_type || ' '
              WHEN e.event_id % 45 = 3 THEN '  ' ELSE e.event_type END AS event_type,
         {PRODUCT} AS product_id, CAST(p.p_size AS VARCHAR) AS category_id,
         CASE e.event_id % 9 WHEN 1 THEN '' ELSE p.p_type END AS category_code,
         CASE e.event_id % 7 WHEN 1 THEN '  ' WHEN 2 THEN ' ' || p.p_brand || ' ' ELSE p.p_brand END AS brand,
         CASE e.event_id % 17 WHEN 1 THEN 'abc' WHEN 2 THEN '1_000.5' WHEN 3 THEN '' WHEN 4 THEN ' 12.5 '
              WHEN 5 THEN '1e3' ELSE {RAW_PRICE} END AS price,
         CAST(e.user_id AS VARCHAR) AS user_id, {SESSION} AS user_session
  FROM {EVENTS} JOIN (VALUES (1), (2)) c(copy) ON c.copy = 1 OR (e.event_id % 20 = 0 AND day(e.ts) % 2 = 0)
  WHERE day(e.ts) <> 7 AND NOT (day(e.ts) = 12 AND hour(e.ts) >= 20)
)"""
DIRTY_FACT = f"""fact_events AS (
  SELECT *, CAST(event_ts AS DATE) AS event_date FROM ({CLEAN_SELECT}) c WHERE event_ts IS NOT NULL
)"""
ALL_RULES = "\nUNION ALL\n".join(RULES[k] for k in (
    "freshness", "volume_dirty", "purchase_prev", "null_rate", "dup", "purchase_run", "latest_in_day", "latest_24h"))
# A store that holds run_date alone.
ONE_DAY_CTE = FACT_CTE.replace("fact_events AS (", "all_events AS (", 1) + f""",
fact_events AS (SELECT * FROM all_events WHERE event_date = {RD})"""

# Runs of failing days: a failing row and the pass that ends its run have as many passes before them.
CHECK_EPISODES = """SELECT check_name, min(check_date) FILTER (status <> 'PASS') AS first_day,
    max(check_date) FILTER (status <> 'PASS') AS last_day, count(*) FILTER (status <> 'PASS') AS failing_days,
    min(severity) FILTER (status <> 'PASS') AS severity, min(check_date) FILTER (status = 'PASS') AS closed_on
  FROM (SELECT c.*, (SELECT count(*) FROM checks p WHERE p.check_name = c.check_name AND p.status = 'PASS'
                     AND p.check_date < c.check_date) AS island FROM checks c) r
  GROUP BY check_name, island HAVING count(*) FILTER (status <> 'PASS') > 0"""


def flagged_runs(gap: int) -> str:
    """Flagged days by their run: a flagged day without a flagged one at most ``gap`` days before starts it."""
    same = "{0}.entity_type = s.entity_type AND {0}.entity_id IS NOT DISTINCT FROM s.entity_id AND {0}.metric_name = s.metric_name"
    return f"""flagged AS (
  SELECT s.*, count_if(starts) OVER (PARTITION BY entity_type, entity_id, metric_name ORDER BY anomaly_date) AS run
  FROM (SELECT s.*, NOT EXISTS (SELECT 1 FROM scored p WHERE {same.format('p')} AND p.anomaly_flag = 'Y'
               AND p.anomaly_date < s.anomaly_date AND p.anomaly_date >= s.anomaly_date - {gap}) AS starts
        FROM scored s WHERE anomaly_flag = 'Y') s
),
runs AS (
  SELECT entity_type, entity_id, metric_name, min(anomaly_date) AS first_day, max(anomaly_date) AS last_day,
         count(*) AS flagged_days, max(abs(z_score)) AS peak_z
  FROM flagged GROUP BY entity_type, entity_id, metric_name, run
),
episodes AS (
  SELECT s.*, (SELECT min(anomaly_date) FROM scored n WHERE {same.format('n')} AND n.anomaly_date > s.last_day) AS closed_on
  FROM runs s
)"""


# State of the replay's last facts, and the day that failed once and was repaired.
REPLAY_SQL = f"""SELECT {INCIDENT_COLS} FROM current_incidents
UNION ALL
SELECT incident_id, opened_at, opened_at AS closed_at, severity, 'RESOLVED' AS status, summary, detected_by, impacted_assets,
    root_cause_type, root_cause_details, resolution_steps, preventive_actions, owner
  FROM once_failing"""

HEALTH_SQL = """SELECT check_date, count(*) AS total_checks,
    count_if(status <> 'PASS' AND severity = 'P0') AS p0_issues,
    count_if(status <> 'PASS' AND severity = 'P1') AS p1_issues,
    count_if(status <> 'PASS' AND severity = 'P2') AS p2_issues,
    CAST(greatest(100 - 30 * count_if(status <> 'PASS' AND severity = 'P0')
                      - 10 * count_if(status <> 'PASS' AND severity = 'P1')
                      - 5 * count_if(status <> 'PASS' AND severity = 'P2'), 0) AS BIGINT) AS health_score
  FROM checks GROUP BY check_date"""

CHECKS_WITH_INC_SQL = f"""SELECT c.check_date, c.check_name, c.table_name, c.severity, c.status,
    c.metric_value, c.expected_range, c.failure_details,
    i.incident_id, i.status AS incident_status, i.summary AS incident_summary,
    i.root_cause_type AS incident_root_cause_type, i.root_cause_details AS incident_root_cause_details,
    i.opened_at AS incident_opened_at, i.owner AS incident_owner
  FROM checks c LEFT JOIN current_incidents i
    ON i.detected_by = c.check_name AND CAST(regexp_extract(i.incident_id, 'INC-(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1) AS DATE) = c.check_date
   AND c.status <> 'PASS'"""


def _replay_sql() -> str:
    early, again = RUN_DATE - dt.timedelta(days=3), RUN_DATE + dt.timedelta(days=1)

    def facts(*days: dt.date) -> str:
        listed = ", ".join(f"DATE '{d.isoformat()}'" for d in days)
        return (FACT_CTE.replace("fact_events AS (", "all_events AS (", 1)
                + f""", fact_events AS (SELECT * REPLACE (CASE WHEN event_type = 'purchase' AND event_date IN ({listed})
                       THEN 'view' ELSE event_type END AS event_type) FROM all_events)""")

    rules = "checks AS (" + " UNION ALL ".join(RULES[k] for k in ("purchase_run", "volume_mix", "volume_dirty")) + ")"
    limit = ("CASE WHEN k.slug IS NULL THEN '' ELSE upper(replace(regexp_extract(f.check_name, "
             "'_(min_)?[0-9]+(\\.[0-9]+)?h?$', 0), '_', '-')) END")
    named = INCIDENT_CTES.replace("upper(replace(f.rule_kind, '_', '-')))", f"upper(replace(f.check_name, '_', '-'))) || {limit}")
    first = _with(facts(early, RUN_DATE), STATS_CTE, rules, named) + "SELECT * FROM incidents"
    return (_with(facts(RUN_DATE, again), STATS_CTE, rules, named,
                  f"once_failing AS (SELECT * FROM ({first}) o WHERE incident_id NOT IN (SELECT incident_id FROM incidents))")
            + REPLAY_SQL)


def _anomaly_incidents_sql() -> str:
    return _with(DIRTY_CTE, DIRTY_FACT, KPI_CTE, scored_cte(), flagged_runs(1)) + """SELECT
    'INC-' || strftime(first_day, '%Y-%m-%d') || '-ANOMALY-' || upper(replace(metric_name, '_', '-')) AS incident_id,
    CAST(first_day AS TIMESTAMP) AS opened_at, CAST(closed_on AS TIMESTAMP) AS closed_at, 'P1' AS severity,
    CASE WHEN closed_on IS NULL THEN 'OPEN' ELSE 'RESOLVED' END AS status,
    'Unusual ' || metric_name || ' from ' || strftime(first_day, '%Y-%m-%d') || '.' AS summary,
    'anomaly/overall/' || metric_name AS detected_by, 'dq_anomalies' AS impacted_assets, 'KPI_SHIFT' AS root_cause_type,
    'KPI_SHIFT: the KPI left the range of its trailing days.' AS root_cause_details,
    'Compare the KPI with its baseline in dq_anomalies and the checks of the same days.' AS resolution_steps,
    'Watch the KPI in dq_anomalies from day to day.' AS preventive_actions, 'data-reliability' AS owner
  FROM episodes"""


_ENTITY = """fanned AS (
  SELECT event_date, event_type, price, 'overall' AS entity_type, CAST(NULL AS VARCHAR) AS entity_id FROM fact_events
  UNION ALL SELECT event_date, event_type, price, 'category', category_id FROM fact_events
  UNION ALL SELECT event_date, event_type, price, 'product', product_id FROM fact_events
),
ekpis AS (
  SELECT event_date AS d, entity_type, entity_id, CAST(count(*) AS DOUBLE) AS events_count,
         CAST(count_if(event_type = 'purchase') AS DOUBLE) AS purchases,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN TRY_CAST(price AS DECIMAL(22,4)) ELSE 0 END)
              AS DOUBLE) AS revenue
  FROM fanned GROUP BY event_date, entity_type, entity_id
),
{ZERO}erows AS (
  SELECT d AS anomaly_date, entity_type, entity_id, 'events_count' AS metric_name, events_count AS actual_value FROM ekpis
  UNION ALL SELECT d, entity_type, entity_id, 'revenue', revenue FROM ekpis
  UNION ALL SELECT d, entity_type, entity_id, 'cvr', CASE WHEN events_count = 0 THEN NULL
                   ELSE purchases / events_count END FROM ekpis
)"""


WARN_TREND = """SELECT check_date, severity, count_if(status = 'FAIL') AS fail_checks,
    count_if(status = 'WARN') AS warn_checks, count_if(status <> 'PASS') AS issue_checks,
    count(*) AS total_checks FROM checks GROUP BY check_date, severity"""

# Every calendar day between the first and the last event, events or not.
EVERY_DAY = """every_day AS (
  SELECT CAST(d AS DATE) AS check_date, s.n_events AS n0, s.n_purchases AS np0, s.n_null_session AS nn0, COALESCE(y.n_events, 0) AS n1
  FROM (SELECT unnest(generate_series((SELECT min(event_date) FROM stats), (SELECT max(event_date) FROM stats), INTERVAL 1 DAY)) AS d) c
  LEFT JOIN stats s ON s.event_date = CAST(d AS DATE) LEFT JOIN stats y ON y.event_date = CAST(d AS DATE) - 1
)"""
WARNING_RULES = [
    RULES["freshness"],
    warning(rule_sql(f"volume_prev_day_events_min_{WARN_BELOW}", "P0", "n1", f"{{m}} >= {WARN_BELOW}", f">= {WARN_BELOW}",
                     f"Previous day events below {WARN_BELOW}"), f"m >= {VOLUME_MIN_DIRTY}"),
    warning(RULES["null_rate"], f"m <= {WARN_NULL_PCT}"),
    RULES["purchase_run"].replace("CAST(np0 AS DOUBLE)", "CAST(COALESCE(np0, 0) AS DOUBLE)"),
]

# Rows of each day as multisets, by all their columns.
AUDIT_SQL = f"""loaded AS (
  SELECT * REPLACE (CASE WHEN day(event_date) = 7 AND price < 50 THEN 'other' ELSE brand END AS brand) FROM fact_events
  JOIN (VALUES (1), (2), (3)) c(copy) ON copy <= CASE day(event_date) WHEN 3 THEN 2 WHEN 4 THEN 3
    WHEN 5 THEN CASE WHEN price < 50 THEN 1 ELSE 0 END WHEN 6 THEN 0 WHEN 8 THEN CASE WHEN price < 50 THEN 0 ELSE 2 END ELSE 1 END
),
counted AS (
  SELECT {FACT_COLS}, count(*) FILTER (side = 1) AS x, count(*) FILTER (side = 2) AS y FROM (
    SELECT {FACT_COLS}, 1 AS side FROM fact_events WHERE day(event_date) <> 9
    UNION ALL SELECT {FACT_COLS}, 2 FROM loaded) r GROUP BY ALL
)
SELECT event_date, CASE WHEN sum(y) = 0 THEN 'missing' WHEN sum(x) = 0 THEN 'foreign' WHEN bool_and(x = y) THEN 'ok'
    WHEN bool_and(x > 0 AND y >= 2 * x AND y % greatest(x, 1) = 0) AND max(y // greatest(x, 1)) = min(y // greatest(x, 1)) THEN 'doubled'
    WHEN bool_and(y <= x) THEN 'partial' ELSE 'mixed' END AS state,
  CAST(sum(x) AS BIGINT) AS history_rows, CAST(sum(y) AS BIGINT) AS daily_rows,
  CAST(sum(greatest(x - y, 0)) AS BIGINT) AS missing_rows, CAST(sum(greatest(y - x, 0)) AS BIGINT) AS extra_rows,
  CAST(sum(CASE WHEN x = 0 THEN y ELSE 0 END) AS BIGINT) AS foreign_rows
FROM counted GROUP BY event_date"""
ENTITY_CTE = _ENTITY.replace("{ZERO}", "")
# Every calendar day between an entity's first and last one.
ZERO_CTE = _ENTITY.replace("{ZERO}", """days AS (
  SELECT entity_type, entity_id, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d
  FROM ekpis GROUP BY entity_type, entity_id
),
filled AS (
  SELECT c.d, c.entity_type, c.entity_id, COALESCE(k.events_count, 0) AS events_count, COALESCE(k.purchases, 0) AS purchases,
         COALESCE(k.revenue, 0) AS revenue
  FROM days c LEFT JOIN ekpis k ON k.d = c.d AND k.entity_type = c.entity_type AND k.entity_id IS NOT DISTINCT FROM c.entity_id
),
""").replace("ELSE purchases / events_count END FROM ekpis", "ELSE purchases / events_count END FROM filled").replace(
    "events_count AS actual_value FROM ekpis", "events_count AS actual_value FROM filled").replace(
    "'revenue', revenue FROM ekpis", "'revenue', revenue FROM filled")

ROBUST_SQL = """SELECT anomaly_date, entity_type, entity_id, metric_name, actual_value, baseline_value, baseline_mad, z_score, pct_change,
    CASE WHEN baseline_value IS NULL THEN 'N' WHEN abs(z_score) > 3.5 THEN 'Y'
      WHEN pct_change > CASE metric_name WHEN 'cvr' THEN 0.50 ELSE 0.60 END THEN 'Y'
      WHEN pct_change < CASE metric_name WHEN 'cvr' THEN -0.50 WHEN 'revenue' THEN -0.40 ELSE -0.60 END THEN 'Y'
      ELSE 'N' END AS anomaly_flag, 'robust z>|3.5| OR day_change' AS notes
  FROM (
    SELECT *, (actual_value - baseline_value) / nullif(1.4826::DOUBLE * baseline_mad, 0) AS z_score,
      (actual_value - prev) / nullif(prev, 0) AS pct_change
    FROM (SELECT *, list_aggregate(list_transform(vals, lambda v: abs(v - baseline_value)), 'median') AS baseline_mad
      FROM (SELECT *, list_aggregate(vals, 'median') AS baseline_value
        FROM (SELECT *, list_filter(list(actual_value) OVER w, lambda v: v IS NOT NULL) AS vals,
                     lag(actual_value) OVER (PARTITION BY entity_type, entity_id, metric_name ORDER BY anomaly_date) AS prev
              FROM erows WINDOW w AS (PARTITION BY entity_type, entity_id, metric_name ORDER BY anomaly_date
                                      ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)))))"""


def _sql() -> dict[str, str]:
    F_ = _with(FACT_CTE)
    FK = _with(FACT_CTE, KPI_CTE)
    FKS = _with(FACT_CTE, KPI_CTE, scored_cte())
    FS = _with(FACT_CTE, STATS_CTE)
    FC = _with(FACT_CTE, STATS_CTE, CHECKS_CTE)
    FCI = _with(FACT_CTE, STATS_CTE, CHECKS_CTE, INCIDENT_CTES)
    R_ = _with(RAW_CTE)
    fact_run_date = F_ + f"SELECT {FACT_COLS} FROM fact_events WHERE event_date = {RD}"
    spike = (f"CASE WHEN event_date = DATE '{SPIKE_DAY.isoformat()}' AND "
             f"CAST('0x' || substr(md5('{SPIKE_SEED}' || '|' || event_id), 1, 8) AS BIGINT) % 10000 "
             f"< {int(round(SPIKE_RATE * 10000))} THEN NULL ELSE session_id END")
    s: dict[str, str] = {
        "load_csv_events": R_ + "SELECT * FROM raw_events",
        "clean_events": R_ + f"SELECT *, CAST(event_ts AS DATE) AS event_date FROM ({CLEAN_SELECT}) c "
                              "WHERE event_ts IS NOT NULL",
        "dirty_clean_events": _with(DIRTY_CTE, DIRTY_FACT) + f"SELECT {FACT_COLS} FROM fact_events",
        "dirty_load_counts": _with(DIRTY_CTE, "typed AS (" + CLEAN_SELECT.replace("AS event_id", "AS event_id, price AS raw_price") + ")")
                             + "SELECT count(*) AS raw_rows, count_if(event_ts IS NULL) AS rejected_rows, "
                               "count_if(trim(raw_price) <> '' AND price IS NULL) AS unread_prices FROM typed",
        "dirty_dq_checks": _with(DIRTY_CTE, DIRTY_FACT, STATS_CTE) + f"SELECT {CHECK_COLS} FROM ({ALL_RULES}) r",
        "dirty_anomalies": _with(DIRTY_CTE, DIRTY_FACT, KPI_CTE, scored_cte()) + f"SELECT {ANOMALY_COLS} FROM scored",
        "blank_to_null": R_ + "SELECT md5(concat_ws('|', user_id, user_session, event_time, event_type, "
                              "product_id, price)) AS event_id, NULLIF(trim(brand), '') AS brand, "
                              "NULLIF(trim(category_code), '') AS category_code FROM raw_events",
        "normalize_event_type": R_ + "SELECT lower(NULLIF(trim(event_type), '')) AS event_type, "
                                     "count(*) AS rows FROM raw_events GROUP BY 1",
        "parse_event_ts": R_ + "SELECT event_time, CASE WHEN event_time LIKE '%UTC' THEN "
                               "TRY_CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) ELSE "
                               "TRY_CAST(event_time AS TIMESTAMP) END AS event_ts FROM raw_events",
        "safe_price_cast": R_ + "SELECT price AS price_text, TRY_CAST(price AS DOUBLE) AS price FROM raw_events",
        "event_id_md5": F_ + "SELECT event_id, user_id, session_id, event_ts FROM fact_events",
        "run_params": F_ + "SELECT DISTINCT event_date AS run_date, event_date - 1 AS prev_date FROM fact_events",
        "distinct_event_dates": F_ + "SELECT DISTINCT event_date AS d FROM fact_events",
        "events_on_run_date": fact_run_date,
        "guarded_ratio": F_ + "SELECT event_date, event_type, CAST(count_if(session_id IS NULL) AS DOUBLE) "
                              "/ NULLIF(CAST(count(*) AS DOUBLE), 0) AS null_share FROM fact_events "
                              "GROUP BY event_date, event_type",
        "replay_day_join": fact_run_date,
        "rows_loaded_for_day": F_ + f"SELECT {RD} AS run_date, count(*) AS rows_loaded_for_day "
                                    f"FROM fact_events WHERE event_date = {RD}",
        "ingest_day_idempotent": fact_run_date,
        "backfill_all_days": F_ + f"SELECT {FACT_COLS} FROM fact_events",
        "reset_then_ingest": fact_run_date,
        "reset_then_run_day": _with(ONE_DAY_CTE, STATS_CTE, CHECKS_CTE) + f"SELECT {CHECK_COLS} FROM checks",
        "reload_replaces_history": F_ + f"SELECT {FACT_COLS} FROM fact_events WHERE event_date >= {RD}",
        "store_incident_state": FCI + f"SELECT {INCIDENT_COLS} FROM current_incidents",
        "rerun_checks_idempotent": FC + f"SELECT {CHECK_COLS} FROM checks",
        "rerun_anomalies_idempotent": FKS + f"SELECT {ANOMALY_COLS} FROM scored",
        "replay_progress": F_ + "SELECT min(event_date) AS min_loaded_date, max(event_date) AS max_loaded_date, "
                                "count(*) AS total_rows_loaded FROM fact_events",
        "null_spike_masked_rate": F_ + f", masked AS (SELECT event_date, {spike} AS session_id FROM fact_events) "
                                       "SELECT event_date, count(*) AS n_events, count_if(session_id IS NULL) "
                                       "AS n_null_session, 100.0 * CAST(count_if(session_id IS NULL) AS DOUBLE) "
                                       "/ NULLIF(CAST(count(*) AS DOUBLE), 0) AS null_pct FROM masked "
                                       "GROUP BY event_date",
        "daily_kpis": FK + "SELECT d, events_count, purchases, revenue FROM kpis_cvr",
        "daily_cvr": FK + "SELECT d, purchases, events_count, cvr FROM kpis_cvr",
        "kpis_long": FK + "SELECT * FROM kpi_rows",
        "rolling_baseline_14": FKS + "SELECT anomaly_date, metric_name, actual_value, baseline_value, "
                                     "baseline_sd FROM with_base",
        "day_over_day_change": FKS + "SELECT anomaly_date, metric_name, actual_value, prev_value, "
                                     "pct_change FROM with_z",
        "rolling_median_14": FK + "SELECT anomaly_date, metric_name, actual_value, median(actual_value) "
                                  "OVER (PARTITION BY metric_name ORDER BY anomaly_date ROWS BETWEEN 14 "
                                  "PRECEDING AND 1 PRECEDING) AS baseline_median FROM kpi_rows",
        "anomaly_zscore": FKS + "SELECT anomaly_date, metric_name, z_score FROM scored",
        "anomaly_events_count": FKS + f"SELECT {ANOMALY_COLS} FROM scored WHERE metric_name = 'events_count'",
        "anomaly_revenue": FKS + f"SELECT {ANOMALY_COLS} FROM scored WHERE metric_name = 'revenue'",
        "anomaly_cvr": FKS + f"SELECT {ANOMALY_COLS} FROM scored WHERE metric_name = 'cvr'",
        "anomalies_for_run_date": FKS + f"SELECT {ANOMALY_COLS} FROM scored WHERE anomaly_date = {RD}",
        "anomalies_all_days": FKS + f"SELECT {ANOMALY_COLS} FROM scored",
        "anomalies_latest_day": FKS + f"SELECT {ANOMALY_COLS} FROM scored WHERE anomaly_date = "
                                      "(SELECT max(event_date) FROM fact_events)",
        "anomalies_by_entity": _with(FACT_CTE, ENTITY_CTE, scored_cte("erows")) + f"SELECT {ANOMALY_COLS} FROM scored",
        "rerun_entity_anomalies_idempotent": _with(FACT_CTE, ENTITY_CTE, scored_cte("erows")) + f"SELECT {ANOMALY_COLS} FROM scored",
        "anomalies_by_entity_zero_days": _with(FACT_CTE, ZERO_CTE, scored_cte("erows")) + f"SELECT {ANOMALY_COLS} FROM scored",
        "anomalies_robust": _with(FACT_CTE, ENTITY_CTE) + ROBUST_SQL,
        "anomaly_episodes": _with(FACT_CTE, ENTITY_CTE, scored_cte("erows"), flagged_runs(2)) + "SELECT * FROM episodes",
        "check_episodes": _with(DIRTY_CTE, DIRTY_FACT, STATS_CTE, "checks AS (" + " UNION ALL ".join(RULES[k] for k in (
            "freshness", "volume_dirty", "purchase_prev", "null_rate", "purchase_run", "dup")) + ")") + CHECK_EPISODES,
        "store_incident_replay": _replay_sql(),
        "late_data_anomalies": FKS + f"SELECT {ANOMALY_COLS} FROM scored",
        "late_data_checks": FS + " UNION ALL ".join(RULES[k] for k in (
            "freshness", "volume", "purchase_prev", "null_rate", "dup", "latest_24h")),
        "dirty_quarantine": _with(DIRTY_CTE) + """SELECT event_time, event_type, product_id, category_id, category_code, brand, price,
    user_id, user_session, CASE WHEN NULLIF(trim(event_time), '') IS NULL THEN 'no event time' ELSE 'unreadable event time' END AS reason
  FROM (SELECT * REPLACE (NULLIF(event_time, '') AS event_time, NULLIF(event_type, '') AS event_type, NULLIF(brand, '') AS brand,
          NULLIF(category_code, '') AS category_code, NULLIF(price, '') AS price) FROM raw_events) r
  WHERE event_time IS NULL OR event_time = 'junk'""",
        "store_manual_incidents": FCI + f"""SELECT {INCIDENT_COLS.replace("status,", "CASE status WHEN 'OPEN' THEN 'MITIGATED' ELSE status END AS status,")}
    FROM current_incidents UNION ALL SELECT '{MANUAL_ID}', {RD} + INTERVAL 9 HOUR, {RD} + INTERVAL 81 HOUR, 'P1', 'RESOLVED', 'Seen by hand.',
    NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
        "export_entity_anomalies_csv": _with(FACT_CTE, ENTITY_CTE, scored_cte("erows")) + f"SELECT {ANOMALY_COLS} FROM scored",
        "load_audit": _with(FACT_CTE) + ", " + AUDIT_SQL,
        "dirty_checks_every_day": _with(DIRTY_CTE, DIRTY_FACT, STATS_CTE, EVERY_DAY) + " UNION ALL ".join(
            r.replace("FROM cal", "FROM every_day") for r in WARNING_RULES),
        "dirty_warn_trend": _with(DIRTY_CTE, DIRTY_FACT, STATS_CTE, "checks AS (" + " UNION ALL ".join(WARNING_RULES) + ")") + WARN_TREND,
        "store_anomaly_incidents": _anomaly_incidents_sql(),
        "check_freshness": FS + RULES["freshness"],
        "check_volume_prev_day": FS + RULES["volume_mix"],
        "check_purchase_prev_day": FS + RULES["purchase_prev"],
        "check_null_rate": FS + RULES["null_rate"],
        "check_dup_composite_key": FS + RULES["dup"],
        "check_dup_coarse_key": FS + RULES["dup_coarse"],
        "check_purchase_run_date": FS + RULES["purchase_run"],
        "check_latest_event_in_day": FS + RULES["latest_in_day"],
        "check_latest_event_24h": FS + RULES["latest_24h"],
        "dq_checks_for_run_date": FC + f"SELECT {CHECK_COLS} FROM checks WHERE check_date = {RD}",
        "dq_checks_all_days": FC + f"SELECT {CHECK_COLS} FROM checks",
        "run_context": FS + "SELECT event_date AS run_date, max_event_ts FROM stats",
        "incidents_auto_open": FCI + f"SELECT {INCIDENT_COLS} FROM incidents",
        "incident_log_append": FCI + "SELECT incident_id, status, changed_at, note FROM status_log",
        "incident_current_state": FCI + f"SELECT {INCIDENT_COLS} FROM current_incidents",
        "incident_queue": FCI + f"SELECT {INCIDENT_COLS} FROM current_incidents WHERE status = 'OPEN'",
        "incident_related_failing_checks": FCI + """SELECT i.incident_id, c.check_date, c.check_name, c.severity,
    c.status, c.metric_value, c.expected_range, c.failure_details
  FROM incidents i JOIN checks c ON c.check_name = i.detected_by AND c.check_date = i.inc_day
  WHERE c.status <> 'PASS'""",
        "health_daily": FC + HEALTH_SQL,
        "checks_with_incidents": FCI + CHECKS_WITH_INC_SQL,
        "fail_warn_trend": FC + WARN_TREND,
        "check_detail_trend": FC + f"""SELECT check_date, check_name, severity, status, metric_value,
    expected_range, failure_details,
    metric_value - lag(metric_value) OVER (PARTITION BY check_name ORDER BY check_date) AS metric_change
  FROM checks WHERE check_name = '{DETAIL_CHECK}'""",
        "root_cause_counts": FCI + "SELECT root_cause_type, count(*) AS incident_count FROM current_incidents "
                                   "GROUP BY root_cause_type",
        "root_cause_pareto": FCI + """, counts AS (SELECT root_cause_type, count(*) AS incident_count
    FROM current_incidents GROUP BY root_cause_type)
  SELECT root_cause_type, incident_count,
    row_number() OVER (ORDER BY incident_count DESC, root_cause_type ASC) AS pareto_rank,
    CAST(sum(incident_count) OVER (ORDER BY incident_count DESC, root_cause_type ASC
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_count,
    100.0 * sum(incident_count) OVER (ORDER BY incident_count DESC, root_cause_type ASC
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(incident_count) OVER () AS cumulative_pct
  FROM counts""",
        "top_failing_checks": FC + f"""SELECT check_name,
    count(DISTINCT CASE WHEN status IN ('FAIL', 'WARN') THEN check_date END) AS failwarn_days,
    count_if(status IN ('FAIL', 'WARN')) AS failwarn_rows
  FROM checks GROUP BY check_name HAVING count_if(status IN ('FAIL', 'WARN')) > 0
  ORDER BY failwarn_days DESC, failwarn_rows DESC, check_name ASC LIMIT {TOP_N}""",
        "export_health_csv": FC + HEALTH_SQL,
        "export_checks_csv": FCI + CHECKS_WITH_INC_SQL,
        "export_incidents_csv": FCI + f"SELECT {INCIDENT_COLS} FROM current_incidents",
        "export_anomalies_csv": FKS + f"SELECT {ANOMALY_COLS} FROM scored",
    }
    doubles = {
        "metric": ["metric_value"],
        "anom": ANOMALY_DBL,
    }
    rounding = {
        "clean_events": ["price"], "safe_price_cast": ["price"], "guarded_ratio": ["null_share"],
        "events_on_run_date": ["price"], "replay_day_join": ["price"], "ingest_day_idempotent": ["price"],
        "backfill_all_days": ["price"], "reset_then_ingest": ["price"],
        "dirty_clean_events": ["price"], "reload_replaces_history": ["price"],
        "dirty_dq_checks": ["metric_value"], "reset_then_run_day": ["metric_value"], "dirty_anomalies": ANOMALY_DBL,
        "null_spike_masked_rate": ["null_pct"],
        "daily_kpis": ["events_count", "purchases", "revenue"],
        "daily_cvr": ["purchases", "events_count", "cvr"],
        "kpis_long": ["actual_value"],
        "rolling_baseline_14": ["actual_value", "baseline_value", "baseline_sd"],
        "day_over_day_change": ["actual_value", "prev_value", "pct_change"],
        "rolling_median_14": ["actual_value", "baseline_median"],
        "anomaly_zscore": ["z_score"],
        "check_detail_trend": ["metric_value", "metric_change"], "anomaly_episodes": ["peak_z"], "export_entity_anomalies_csv": ANOMALY_DBL, "rerun_entity_anomalies_idempotent": ANOMALY_DBL,
        "anomalies_robust": [*ANOMALY_DBL, "baseline_mad"], "check_episodes": [],
        "late_data_anomalies": ANOMALY_DBL, "late_data_checks": ["metric_value"], "dirty_checks_every_day": ["metric_value"],
        "root_cause_pareto": ["cumulative_pct"],
        "incident_related_failing_checks": ["metric_value"],
        "checks_with_incidents": ["metric_value"], "export_checks_csv": ["metric_value"],
    }
    for k in s:
        if k.startswith(("check_", "dq_checks", "rerun_checks")) and k not in rounding:
            rounding[k] = doubles["metric"]
        if k.startswith(("anomal", "rerun_anomalies", "export_anomalies")) and k not in rounding:
            rounding[k] = doubles["anom"]
    issues = ["p0_issues", "p1_issues", "p2_issues"]
    bigints = {
        "health_daily": issues, "export_health_csv": issues,
        "fail_warn_trend": ["fail_checks", "warn_checks", "issue_checks"],
        "dirty_warn_trend": ["fail_checks", "warn_checks", "issue_checks"],
        "null_spike_masked_rate": ["n_null_session"],
        "top_failing_checks": ["failwarn_rows"],
        "dirty_load_counts": ["rejected_rows", "unread_prices"],
    }
    return {k: _round(v, rounding.get(k, []), bigints.get(k, [])) for k, v in s.items()}


def oracle_sql() -> dict[str, str]:
    return _sql()
