"""A day's partitions of several tables, published as one step.

A run writes the day's new rows beside the tables, under ``<root>/_runs/<run>/<table>``,
and reads them back from there for its later steps.  Nothing a reader can see changes
until ``publish``: it writes one record of the run's folders (the commit: one file of a
small table) and then points the day's partition of each table at its folder, the run
context last.  Pointing is a catalog entry per table, no data moves.

A run that stops before the record leaves the old day everywhere.  One that stops after
it is completed by the next ``Store.init_tables`` from the record.  Folders that no
partition points at any more are removed by ``vacuum``; until then readers that planned
before a publication still find their files.
"""

from __future__ import annotations

import datetime as dt
import os
import time
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from tidewatch.sources.tables import Store

RECORD = "seq long, run string, place int, target string, day date, location string"


def _records_path(store: Store) -> str:
    return f"{store.root}/_publications"


def records(store: Store) -> DataFrame | None:
    """Everything published so far; none before the first publication."""
    if not store.exists(_records_path(store)):
        return None
    return store.spark.read.schema(RECORD).parquet(_records_path(store))


class DayRun:
    """New partitions of one day, staged and then published together."""

    def __init__(self, store: Store, day: dt.date):
        self.store, self.day = store, day
        self.name = f"{day.isoformat()}-{os.urandom(6).hex()}"
        self.staged: list[tuple[str, str]] = []

    def write(self, table: str, rows: DataFrame) -> DataFrame:
        """Stage the day's rows of ``table``; returns them as written."""
        part = self.store.partition_column(table)
        ordered = self.store.ordered(table, rows).where(F.col(part) == F.lit(self.day))
        location = f"{self.store.root}/_runs/{self.name}/{table}"
        ordered.drop(part).write.parquet(location)
        self.staged.append((table, location))
        back = self.store.spark.read.schema(ordered.drop(part).schema).parquet(location)
        return back.withColumn(part, F.lit(self.day))

    def with_day(self, table: str, staged: DataFrame) -> DataFrame:
        """``table`` as it will be: its other days and the staged one."""
        part = self.store.partition_column(table)
        return self.store.read(table).where(F.col(part) != F.lit(self.day)).unionByName(staged)

    def publish(self) -> None:
        """Make the staged partitions the day's, in the order they were staged."""
        seq = time.time_ns()
        rows = [(seq, self.name, i, t, self.day, loc) for i, (t, loc) in enumerate(self.staged)]
        spark = self.store.spark
        spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").parquet(_records_path(self.store))
        for _, _, _, table, day, location in rows:
            self.store.point_day(table, day, location)


def complete(store: Store, all_days: bool) -> None:
    """Point partitions where the records say: of every day, or of the last run only.

    All days: for tables registered anew, whose catalog entries are gone.
    """
    done = records(store)
    if done is None:
        return
    last = done.groupBy("target", "day").agg(F.max_by(F.struct("seq", "place", "location"), "seq").alias("r"))
    rows = last.select("r.*", "target", "day").orderBy("seq", "place").collect()  # one row per table and day
    if not all_days and rows:
        rows = [r for r in rows if r["seq"] == rows[-1]["seq"]]
    for r in rows:
        if store.exists(r["location"]):
            store.point_day(r["target"], r["day"], r["location"])


def vacuum(store: Store) -> list[str]:
    """Remove the folders of runs that a later run of the same day has replaced; returns them."""
    done = records(store)
    if done is None:
        return []
    newest = done.groupBy("target", "day").agg(F.max("seq").alias("seq"))
    old = done.join(newest, ["target", "day", "seq"], "left_anti")
    paths = sorted({r["location"] for r in old.select("location").collect()})
    return [p for p in paths if store.remove(p)]
