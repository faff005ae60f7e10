"""Batch job entry point, for ``spark-submit``.

    spark-submit --py-files tidewatch.zip tidewatch/plans/job.py \
        --raw-csv <raw folder> --run-all --export
    python -m tidewatch.plans.job --run-date 2019-11-15 --database dq_prod

Options mirror a daily monitoring run: load raw files into the history
(once), ingest one day or every day, evaluate the rules and anomalies, open
incidents, optionally reset the daily table first, and export the dashboard
extracts.  All work runs on the cluster; the
driver only issues the steps.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidewatch.functions.dates import as_date
from tidewatch.operators import rules as R
from tidewatch.plans import daily
from tidewatch.session import work_path
from tidewatch.sources.tables import Store


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Daily data-quality and anomaly run")
    p.add_argument("--database", default="tidewatch", help="catalog database of the engine's tables")
    p.add_argument("--root", default=None, help="table folder (default: under spark.checkpoint.dir)")
    p.add_argument("--raw-csv", default=None, help="load raw event CSV into the history first")
    when = p.add_mutually_exclusive_group(required=True)
    when.add_argument("--run-date", help="run one day (yyyy-MM-dd)")
    when.add_argument("--run-all", action="store_true", help="run every day of the history")
    p.add_argument("--reset-replay", action="store_true", help="empty the daily table first")
    p.add_argument("--volume-min-rows", type=int, default=1000,
                   help="previous-day volume rule: minimum rows (default 1000)")
    p.add_argument("--null-max-pct", type=float, default=1.0,
                   help="session null-rate rule: maximum percent (default 1.0)")
    p.add_argument("--export", action="store_true", help="write the CSV extracts")
    p.add_argument("--out-dir", default=None, help="extract folder (default: under the work root)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> dict:
    args = parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # days and stamps must not follow the cluster's zone
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    store = Store(spark, root=args.root, database=args.database).init_tables()
    if args.raw_csv:
        daily.load_raw_csv(store, args.raw_csv)
    if args.reset_replay:
        daily.reset_replay(store)
    rules = R.default_rules(args.volume_min_rows, args.null_max_pct)
    if args.run_all:
        daily.backfill(store, rules)
    else:
        daily.run_day(store, as_date(args.run_date), rules)
    out: dict = {}
    if args.export:
        out = daily.export_reports(store, args.out_dir or work_path(spark, "exports", args.database))
    out["replay_rows"] = store.read("fact_events").count()  # rows now in the daily table
    return out


if __name__ == "__main__":
    main()
