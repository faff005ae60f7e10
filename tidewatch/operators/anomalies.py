"""KPI anomaly detection against a trailing baseline of 14 rows.

Daily KPIs (events_count, revenue, cvr) are aggregated once, unpivoted to one
row per (day, entity, metric) and scored by one window specification
``PARTITION BY entity_type, entity_id, metric_name ORDER BY day``:

- baseline: mean of the 14 preceding *rows* (today excluded),
- sd: sample standard deviation of the same rows,
- previous: the previous *row* (not the previous calendar day),
- z = (actual - baseline) / sd, NULL when sd is NULL or 0,
- pct = (actual - previous) / previous, NULL when previous is NULL or 0,
- flag: N without baseline, else Y when |z| > z_max or pct > up or pct < down.

The window input is one row per day per series, so its size follows the
number of days and entities, never the event volume; partitioning by series
spreads per-entity scoring over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.dates import DateLike, as_date
from tidewatch.operators.stats import (
    PURCHASE,
    is_purchase,
    lookback_start,
    revenue_decimal,
    revenue_rest,
    revenue_sum,
)

BASELINE_ROWS = 14
METRICS = ("events_count", "revenue", "cvr")

# Per-metric limits (z limit, day-change up limit, day-change
# down limit, all strict) and the note written with every row.
THRESHOLDS = {
    "events_count": (3.0, 0.60, -0.60, "z>|3| OR day_change>|60%|"),
    "revenue": (3.0, 0.60, -0.40, "z>|3| OR +60% / -40% day_change"),
    "cvr": (3.0, 0.50, -0.50, "z>|3| OR day_change>|50%|"),
}

SERIES = ("entity_type", "entity_id", "metric_name")


def _by_metric(idx: int, thresholds: dict) -> str:
    """SQL: the ``idx``-th threshold value of the row's metric."""
    def lit(v):
        return "'" + v.replace("'", "\\'") + "'" if isinstance(v, str) else f"{float(v)!r}D"
    whens = " ".join(f"WHEN '{m}' THEN {lit(v[idx])}" for m, v in thresholds.items())
    return f"CASE metric_name {whens} END"


def daily_kpis(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(d, *by, events_count, purchases, revenue, cvr)``, all doubles."""
    agg = fact.groupBy(F.col("event_date").alias("d"), *by).agg(
        F.expr("CAST(count(1) AS DOUBLE) AS events_count"),
        F.expr(f"CAST(count_if(event_type = '{PURCHASE}') AS DOUBLE) AS purchases"),
        revenue_sum().alias("revenue"),
    )
    return agg.selectExpr("*", "purchases / nullif(events_count, 0.0D) AS cvr")


def kpis_from_stats(stats: DataFrame) -> DataFrame:
    """The same KPIs from stored per-day stats (no fact scan)."""
    return stats.selectExpr(
        "event_date AS d",
        "CAST(n_events AS DOUBLE) AS events_count",
        "CAST(n_purchases AS DOUBLE) AS purchases",
        "CAST(revenue AS DOUBLE) AS revenue",
        "CAST(n_purchases AS DOUBLE) / nullif(CAST(n_events AS DOUBLE), 0.0D) AS cvr",
    )


def kpis_long(kpis: DataFrame, entity_type: str | None = "overall",
              entity_id: str | None = None,
              metrics: Sequence[str] = METRICS) -> DataFrame:
    """Wide KPIs → ``(anomaly_date, entity_type, entity_id, metric_name, actual_value)``.

    ``entity_type`` / ``entity_id`` are a literal type (``None``: take the
    columns of the same name) and an id column name (``None``: NULL).
    """
    et = f"'{entity_type}'" if entity_type is not None else "entity_type"
    eid = f"CAST({entity_id} AS STRING)" if entity_id is not None else "CAST(NULL AS STRING)"
    pairs = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in metrics)
    return kpis.selectExpr(
        "d AS anomaly_date", f"{et} AS entity_type", f"{eid} AS entity_id",
        f"stack({len(metrics)}, {pairs}) AS (metric_name, actual_value)",
    )


_SERIES_SQL = "PARTITION BY entity_type, entity_id, metric_name ORDER BY anomaly_date"


def baselines(long: DataFrame, baseline_rows: int = BASELINE_ROWS) -> DataFrame:
    """Add ``baseline_value``, ``baseline_sd`` and ``prev_value`` to each series row.

    All three share one partitioning and ordering, so Spark sorts once and
    evaluates them in a single Window operator.
    """
    frame = f"OVER ({_SERIES_SQL} ROWS BETWEEN {int(baseline_rows)} PRECEDING AND 1 PRECEDING)"
    return long.selectExpr(
        "*",
        f"avg(actual_value) {frame} AS baseline_value",
        f"stddev_samp(actual_value) {frame} AS baseline_sd",
        f"lag(actual_value) OVER ({_SERIES_SQL}) AS prev_value",
    )


def score(long: DataFrame, baseline_rows: int = BASELINE_ROWS,
          thresholds: dict | None = None) -> DataFrame:
    """Baseline, z-score, day change and flag for each row of each series."""
    return _flagged(baselines(long, baseline_rows), thresholds)


def score_kpis(kpis: DataFrame, entity_id: str = "entity_id", baseline_rows: int = BASELINE_ROWS,
               thresholds: dict | None = None) -> DataFrame:
    """``score`` of ``kpis_long``, from entity KPIs that are unpivoted after the window.

    The metrics of an entity have the same days, so one row per entity and day is shuffled
    and sorted instead of one per metric.
    """
    order = "OVER (PARTITION BY entity_type, entity_id ORDER BY anomaly_date"
    frame = f"{order} ROWS BETWEEN {int(baseline_rows)} PRECEDING AND 1 PRECEDING)"
    rows = kpis.selectExpr("d AS anomaly_date", "entity_type", f"CAST({entity_id} AS STRING) AS entity_id",
                           *[f"CAST({m} AS DOUBLE) AS {m}" for m in METRICS])
    rows = rows.selectExpr("anomaly_date", "entity_type", "entity_id", *[c for m in METRICS for c in (
        m, f"avg({m}) {frame} AS {m}_avg", f"stddev_samp({m}) {frame} AS {m}_sd", f"lag({m}) {order}) AS {m}_prev")])
    each = ", ".join(f"'{m}', {m}, {m}_avg, {m}_sd, {m}_prev" for m in METRICS)
    return _flagged(rows.selectExpr(
        "anomaly_date", "entity_type", "entity_id",
        f"stack({len(METRICS)}, {each}) AS (metric_name, actual_value, baseline_value, baseline_sd, prev_value)"), thresholds)


def _flagged(rows: DataFrame, thresholds: dict | None) -> DataFrame:
    """z-score, day change and flag of rows with their ``baselines``."""
    t = thresholds or THRESHOLDS
    z = "(actual_value - baseline_value) / nullif(baseline_sd, 0.0D)"
    pct = "(actual_value - prev_value) / nullif(prev_value, 0.0D)"
    flag = (f"CASE WHEN baseline_value IS NULL THEN 'N' "
            f"WHEN abs({z}) > {_by_metric(0, t)} THEN 'Y' "
            f"WHEN {pct} > {_by_metric(1, t)} THEN 'Y' "
            f"WHEN {pct} < {_by_metric(2, t)} THEN 'Y' ELSE 'N' END")
    return rows.selectExpr(
        "anomaly_date", "entity_type", "entity_id", "metric_name", "actual_value",
        "baseline_value", f"{z} AS z_score", f"{pct} AS pct_change",
        f"{flag} AS anomaly_flag", f"{_by_metric(3, t)} AS notes",
    )


def anomalies_all_days(fact: DataFrame, **kw) -> DataFrame:
    """Every metric row of every day (flag Y or N), entity ``overall``."""
    return score(kpis_long(daily_kpis(fact)), **kw)


def anomalies_for_run_date(fact: DataFrame, run_date: DateLike, bounded: bool = True,
                           **kw) -> DataFrame:
    """Rows of one day.

    Frames look back only, so days after run_date are never read; with
    ``bounded`` only the calendar window holding the last ``14 + 1`` event
    days is aggregated (exact: the window is widened until it holds them).
    """
    d = as_date(run_date)
    upto = fact.where(F.col("event_date") <= F.lit(d))
    if bounded:
        start = lookback_start(fact, d, kw.get("baseline_rows", BASELINE_ROWS) + 1)
        if start is not None:
            upto = upto.where(F.col("event_date") >= F.lit(start))
    return anomalies_all_days(upto, **kw).where(F.col("anomaly_date") == F.lit(d))


def anomalies_latest_day(fact: DataFrame, bounded: bool = True, **kw) -> DataFrame:
    """Rows of the newest loaded day.

    ``bounded``: the newest day is looked up first (one date back to the
    driver) and only its lookback window is scored; otherwise the filter is
    a scalar subquery over the scoring of every day.
    """
    if bounded:
        latest = fact.select(F.max("event_date")).first()[0]
        if latest is None:
            return anomalies_all_days(fact.where(F.lit(False)), **kw)  # no data: no rows
        return anomalies_for_run_date(fact, latest, **kw)
    latest_col = fact.select(F.max("event_date")).scalar()
    return anomalies_all_days(fact, **kw).where(F.col("anomaly_date") == latest_col)


# Entity levels scored besides ``overall``: (entity_type, id column).
ENTITY_LEVELS = (("category", "category_id"), ("product", "product_id"))


def entity_kpis(fact: DataFrame, levels: Sequence[tuple[str, str]] = ENTITY_LEVELS,
                include_overall: bool = True) -> DataFrame:
    """Daily KPIs of every entity: every event counts once per level it belongs to.

    Events are aggregated once by day and all level columns; ``inline`` fans out
    those groups, not the events.  Counts and the fixed-point part of revenue add
    up exactly; prices beyond fixed point are added as doubles.
    """
    ids = [c for _, c in levels]
    fine = fact.groupBy("event_date", *ids).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_purchase()).alias("p"),
        F.sum(revenue_decimal()).alias("exact"), F.sum(revenue_rest()).alias("rest"))
    tags = [F.struct(F.lit(t).alias("entity_type"), F.col(c).cast("string").alias("entity_id"))
            for t, c in levels]
    if include_overall:
        tags.insert(0, F.struct(F.lit("overall").alias("entity_type"),
                                F.lit(None).cast("string").alias("entity_id")))
    fanned = fine.select("event_date", "n", "p", "exact", "rest", F.inline(F.array(*tags)))
    kpis = fanned.groupBy(F.col("event_date").alias("d"), "entity_type", "entity_id").agg(
        F.expr("CAST(sum(n) AS DOUBLE) AS events_count"), F.expr("CAST(sum(p) AS DOUBLE) AS purchases"),
        F.expr("CAST(sum(exact) AS DOUBLE) + coalesce(sum(rest), 0D) AS revenue"))
    return kpis.selectExpr("*", "purchases / nullif(events_count, 0.0D) AS cvr")


def zero_filled(kpis: DataFrame, through: DateLike | None = None) -> DataFrame:
    """Entity KPIs with a zero row for every calendar day without events.

    From each series' first day to its last one (or ``through``).  A row hands out the
    days up to the series' next row, found by the window that scoring sorts for anyway:
    no calendar join.  The rows grow with series times days.
    """
    last = "date_add(d, 1)" if through is None else f"date_add(DATE '{as_date(through).isoformat()}', 1)"
    rows = kpis.selectExpr(
        "entity_type", "entity_id", "struct(d, events_count, purchases, revenue) AS own", "d",
        f"coalesce(lead(d) OVER (PARTITION BY entity_type, entity_id ORDER BY d), {last}) AS _next")
    empty = "0.0D AS events_count, 0.0D AS purchases, 0.0D AS revenue"
    rows = rows.selectExpr("entity_type", "entity_id", f"""inline(concat(array(own), if(datediff(_next, d) > 1,
        transform(sequence(date_add(d, 1), date_sub(_next, 1)), x -> struct(x AS d, {empty})), array())))""")
    return rows.selectExpr("*", "purchases / nullif(events_count, 0.0D) AS cvr")


def anomalies_by_entity(fact: DataFrame, levels: Sequence[tuple[str, str]] = ENTITY_LEVELS,
                        include_overall: bool = True, zero_days: bool = False, **kw) -> DataFrame:
    """Per-entity anomalies.  ``thresholds`` may be given for sparse series.

    Days without events of an entity are not rows of its series (as for the overall
    series) unless ``zero_days``: then they are zeros between its first and last day.
    """
    kpis = entity_kpis(fact, levels, include_overall)
    return score_kpis(zero_filled(kpis) if zero_days else kpis, **kw)


def rolling_median(long: DataFrame, baseline_rows: int = BASELINE_ROWS) -> DataFrame:
    """Median of the trailing rows (the declared "mean/median" baseline).

    ``percentile`` is exact and accepts a row frame (``median`` does not).
    """
    frame = Window.partitionBy(*SERIES).orderBy("anomaly_date").rowsBetween(-baseline_rows, -1)
    return long.select(
        "anomaly_date", "entity_type", "entity_id", "metric_name", "actual_value",
        F.percentile(F.col("actual_value"), F.lit(0.5)).over(frame).alias("baseline_median"),
    )


# Limit of the robust score, and the standard deviation of a normal distribution in median
# absolute deviations.
ROBUST_MAX = 3.5
_NORMAL_MAD = 1.4826


def _median_sql(values: str) -> str:
    """SQL: median of an array without nulls (NULL when empty)."""
    return (f"transform(array(array_sort({values})), s -> CASE WHEN size(s) > 0 THEN "
            "(s[(size(s) - 1) div 2] + s[size(s) div 2]) / 2 END)[0]")


def score_robust(long: DataFrame, baseline_rows: int = BASELINE_ROWS, z_max: float = ROBUST_MAX,
                 thresholds: dict | None = None) -> DataFrame:
    """Scores against median and median absolute deviation of the trailing rows.

    One outlier among the trailing rows moves neither, so it does not hide the next one.
    The second median is taken around the first, over the same rows: the frame is held as
    an array of at most ``baseline_rows`` values.  ``z_score`` is NULL when the deviation
    is 0; ``thresholds`` gives the day-change limits (its z limits are not used).
    """
    t = thresholds or THRESHOLDS
    frame = f"OVER ({_SERIES_SQL} ROWS BETWEEN {int(baseline_rows)} PRECEDING AND 1 PRECEDING)"
    rows = long.selectExpr("*", f"collect_list(actual_value) {frame} AS _values",
                           f"lag(actual_value) OVER ({_SERIES_SQL}) AS _prev")
    rows = rows.selectExpr("*", f"{_median_sql('_values')} AS baseline_value")
    rows = rows.selectExpr("*", f"{_median_sql('transform(_values, v -> abs(v - baseline_value))')} AS baseline_mad")
    rows = rows.selectExpr("*", f"(actual_value - baseline_value) / nullif({_NORMAL_MAD}D * baseline_mad, 0.0D) AS z_score",
                           "(actual_value - _prev) / nullif(_prev, 0.0D) AS pct_change")
    flag = (f"CASE WHEN baseline_value IS NULL THEN 'N' WHEN abs(z_score) > {float(z_max)!r}D THEN 'Y' "
            f"WHEN pct_change > {_by_metric(1, t)} THEN 'Y' WHEN pct_change < {_by_metric(2, t)} THEN 'Y' ELSE 'N' END")
    return rows.selectExpr("anomaly_date", *SERIES, "actual_value", "baseline_value", "baseline_mad", "z_score", "pct_change",
                           f"{flag} AS anomaly_flag", f"'robust z>|{float(z_max):g}| OR day_change' AS notes")
