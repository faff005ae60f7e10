"""Catalog tables of the engine and the writes that keep reruns idempotent.

Tables are Parquet, registered in the session catalog with an explicit
location under the shared work folder (``spark.checkpoint.dir``):

============================  ===================  ==========================
table                         partitioned by       written by
============================  ===================  ==========================
fact_events_all (history)     event_date           load (static overwrite)
fact_events (daily replay)    event_date           ingest (published by day)
dq_day_stats                  event_date           per-day aggregates
dq_day_digest                 event_date           digest of the ingested rows
dq_check_results              check_date           rules
dq_anomalies                  anomaly_date         anomaly scoring
dq_run_context                run_date             last step of a run (marker)
dq_series_state               bucketed by series   new version, then location swap
dq_rejected_rows              –                    load (static overwrite)
dq_incidents                  –                    append of new ids only
dq_incident_status_log        –                    append
============================  ===================  ==========================

Rewriting one day writes a new version of its partitions beside the tables and
then points the tables at it (``sources.publish``); a daily run does so for all
its tables together.  A multi-day rewrite uses dynamic partition overwrite,
which replaces exactly the days present in the new data.  A task lost mid-write
is retried by Spark's commit protocol; a failed job leaves the previous
partition versions in place, and rerunning the same call converges.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas
from tidewatch.functions.dates import DateLike, as_date
from tidewatch.operators.series_state import KEY, SERIES_STATE
from tidewatch.session import work_path
from tidewatch.sources import publish

# table -> (schema, partition column or None)
TABLES: dict[str, tuple[T.StructType, str | None]] = {
    "fact_events_all": (schemas.FACT_EVENTS, "event_date"),
    "fact_events": (schemas.FACT_EVENTS, "event_date"),
    "dq_day_stats": (T.StructType(schemas.DAY_STATS.fields + [
        T.StructField("dup_groups", T.LongType(), True)]), "event_date"),
    "dq_day_digest": (schemas.DAY_DIGEST, "event_date"),
    "dq_check_results": (schemas.CHECK_RESULTS, "check_date"),
    "dq_anomalies": (schemas.ANOMALIES, "anomaly_date"),
    "dq_run_context": (schemas.RUN_CONTEXT, "run_date"),
    "dq_rejected_rows": (schemas.REJECTED_ROWS, None),
    "dq_incidents": (schemas.INCIDENTS, None),
    "dq_incident_status_log": (schemas.STORED_STATUS_LOG, None),
}

SERIES_TABLE = "dq_series_state"
STATE_BUCKETS = 32

# Tables with a handful of rows per day.
SMALL_PER_DAY = ("dq_day_stats", "dq_day_digest", "dq_check_results", "dq_anomalies", "dq_run_context")


_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """Partition overwrite mode for the writes inside the block.

    Catalog inserts take the mode from the session only (a writer option is
    ignored by ``insertInto``), so it is set around the write and restored.
    """
    old = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, old)


def _ddl_columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class Store:
    """The engine's tables in one catalog database under one root folder."""

    def __init__(self, spark: SparkSession, root: str | None = None, database: str | None = None,
                 state_buckets: int = STATE_BUCKETS):
        self.spark = spark
        self.state_buckets = state_buckets
        self.database = database or "tidewatch"
        self.root = (root or work_path(spark, "store", self.database)).rstrip("/")

    # -- naming --------------------------------------------------------------
    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    @classmethod
    def scratch(cls, spark: SparkSession, label: str) -> Store:
        """A store of its own (fresh database and folder) for one run."""
        db = f"tw_{label}_{os.urandom(4).hex()}"
        return cls(spark, database=db).init_tables()

    # -- DDL -----------------------------------------------------------------
    def init_tables(self) -> Store:
        """Create the database and every table if missing (safe to call again).

        When a table's folder already holds data from an earlier session, its
        partitions are registered again with ``RECOVER PARTITIONS``.
        """
        sql = self.spark.sql
        anew = False
        sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.root}/_db'")
        for table, (schema, part) in TABLES.items():
            exists = self.spark.catalog.tableExists(f"{self.database}.{table}")
            if exists:
                continue
            anew = True
            by = f"PARTITIONED BY ({part})" if part else ""
            sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({_ddl_columns(schema)}) "
                f"USING parquet {by} LOCATION '{self.root}/{table}'")
            if part:
                try:
                    sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")
                except Exception as e:  # noqa: BLE001 - a new table has no folder yet
                    if "FileNotFound" not in str(e) and "does not exist" not in str(e):
                        raise
        if not self.spark.catalog.tableExists(f"{self.database}.{SERIES_TABLE}"):
            # state is derived: a store opened anew starts without, and the first run that needs it makes it
            self._create_series_table(SERIES_TABLE, f"{self.root}/{SERIES_TABLE}/none")
        publish.complete(self, all_days=anew)
        return self

    def drop(self) -> None:
        """Drop the database and remove the store's folder (for stores made for one run)."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
        self.remove(self.root)

    # -- folders -------------------------------------------------------------
    def _folder(self, path: str):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def exists(self, path: str) -> bool:
        fs, at = self._folder(path)
        return fs.exists(at)

    def remove(self, path: str) -> bool:
        """Remove a folder of this store; False when it is not there."""
        if path != self.root and not path.startswith(f"{self.root}/"):
            raise ValueError(f"{path} is not a folder of this store")
        fs, at = self._folder(path)
        return fs.delete(at, True)

    def _create_series_table(self, name: str, location: str) -> None:
        by = ", ".join(KEY)
        self.spark.sql(f"CREATE TABLE {self.name(name)} ({_ddl_columns(SERIES_STATE)}) USING parquet "
                       f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.state_buckets} BUCKETS LOCATION '{location}'")

    # -- writes --------------------------------------------------------------
    @staticmethod
    def partition_column(table: str) -> str | None:
        return TABLES[table][1]

    def point_day(self, table: str, day: DateLike, location: str) -> None:
        """Make the folder ``location`` the day's partition."""
        spec = f"{TABLES[table][1]} = DATE '{as_date(day).isoformat()}'"
        self.spark.sql(f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{location}'")
        self.spark.sql(f"ALTER TABLE {self.name(table)} PARTITION ({spec}) SET LOCATION '{location}'")

    def ordered(self, table: str, df: DataFrame) -> DataFrame:
        schema, part = TABLES[table]
        # Catalog order: data columns, then the partition column (insertInto
        # matches by position).
        fields = [f for f in schema.fields if f.name != part] + [
            f for f in schema.fields if f.name == part]
        cols = []
        for f in fields:
            if f.name in df.columns:
                cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
            elif f.name == "created_at":
                cols.append(F.current_timestamp().alias("created_at"))
            else:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        return df.select(*cols)

    def overwrite_day(self, table: str, df: DataFrame, day: DateLike) -> None:
        """Replace one day partition with ``df``'s rows of that day, which may be none.

        The new version is staged and published (``sources.publish``), so ``df`` may read
        the day it replaces.
        """
        run = publish.DayRun(self, as_date(day))
        run.write(table, df)
        run.publish()

    def overwrite_days(self, table: str, df: DataFrame) -> None:
        """Replace every day present in ``df`` (dynamic partition overwrite).

        Monitoring tables hold a few rows per day, so they are clustered by
        day first (one file per day instead of one per task and day); the
        event tables are written as they come, so a large day stays spread
        over many tasks.
        """
        rows = self.ordered(table, df)
        _, part = TABLES[table]
        if table in SMALL_PER_DAY:
            rows = rows.repartition(part)
        with overwrite_mode(rows.sparkSession, "dynamic"):
            rows.write.insertInto(self.name(table), overwrite=True)

    def replace(self, table: str, df: DataFrame) -> None:
        """Make ``df`` the whole table: partitions it lacks are removed (static overwrite)."""
        rows = self.ordered(table, df)
        _, part = TABLES[table]
        if table in SMALL_PER_DAY:
            rows = rows.repartition(part)
        with overwrite_mode(self.spark, "static"):
            rows.write.insertInto(self.name(table), overwrite=True)

    def replace_series_state(self, state: DataFrame) -> None:
        """Write a new version of the bucketed state beside the old one, then point the table at it.

        Readers see the old version until the last step; a run that fails before leaves it.
        """
        version = os.urandom(6).hex()
        location, staged = f"{self.root}/{SERIES_TABLE}/{version}", f"{SERIES_TABLE}_{version}"
        self._create_series_table(staged, location)
        state.select(*SERIES_STATE.names).write.insertInto(self.name(staged))
        self.spark.sql(f"ALTER TABLE {self.name(SERIES_TABLE)} SET LOCATION '{location}'")
        self.spark.sql(f"DROP TABLE {self.name(staged)}")
        self.spark.catalog.refreshTable(self.name(SERIES_TABLE))

    def clear_days(self, table: str, days: Iterable[dt.date]) -> None:
        """Empty the partitions of some days; other days' files are not touched."""
        empty = self.spark.createDataFrame([], TABLES[table][0])
        for d in days:
            self.overwrite_day(table, empty, d)

    def append(self, table: str, df: DataFrame) -> None:
        self.ordered(table, df).write.insertInto(self.name(table), overwrite=False)

    def truncate(self, table: str) -> None:
        """Remove every row (external tables refuse ``TRUNCATE``): a static
        overwrite with no rows and no partition spec clears all partitions."""
        schema, _ = TABLES[table]
        empty = self.ordered(table, self.spark.createDataFrame([], schema))
        with overwrite_mode(self.spark, "static"):
            empty.write.insertInto(self.name(table), overwrite=True)


def export_csv(df: DataFrame, path: str, order_by: list, single_file: bool = True, parts: int = 0) -> str:
    """Sorted header CSV for dashboards.

    ``single_file`` funnels the rows through one task: only for the small
    report tables (one row per day and rule, or per incident).  ``parts`` writes
    that many ranges of the order instead, each in a file of its own, and
    ``<path>_manifest`` with the files in order: file, rows, and rows before it.
    NULL is written as an empty field, timestamps without a zone suffix.
    """
    if parts:
        _write_csv(df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by), path)
        files = df.sparkSession.read.option("header", True).csv(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.count(F.lit(1)).alias("rows"))
        before = F.coalesce(F.sum("rows").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        _write_csv(files.withColumn("rows_before", before).orderBy("file").coalesce(1), f"{path}_manifest")  # one row per file
        return path
    out = df.orderBy(*order_by)
    if single_file:
        out = out.coalesce(1)
    _write_csv(out, path)
    return path


def _write_csv(out: DataFrame, path: str) -> None:
    (out.write.mode("overwrite").option("header", True).option("emptyValue", "")
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .option("dateFormat", "yyyy-MM-dd").csv(path))


def read_csv_extract(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
            .schema(schema).csv(path))
