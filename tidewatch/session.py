"""Spark session defaults and the shared work folder.

Everything the engine writes (tables, CSV extracts, checkpoints) lives under
the folder the cluster names in ``spark.checkpoint.dir``.  On a cluster that
folder is shared storage; a machine-local temporary folder is only created for
local sessions (tests) where the setting is missing.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "tidewatch",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings every job here assumes.

    - session time zone UTC (event time is zone-less ``timestamp_ntz``),
    - AQE on, with size-driven partition coalescing and skew-join splitting,
    - no web UI, and no per-call Python call-site capture (a debugging aid
      that costs several JVM round trips for every Column function).
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # coalesce shuffle partitions by size (advisory 64 MB), not to keep the
        # default parallelism: fewer tiny tasks on a shared cluster
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "static")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def work_root(spark: SparkSession) -> str:
    """Root folder for engine output: the session's ``spark.checkpoint.dir``.

    Only a local session without the setting gets a fresh temporary folder
    (and has it set as its checkpoint dir); a cluster session without it is
    an error, because a machine-local folder would not survive executor loss.
    """
    try:
        root = spark.conf.get(_CHECKPOINT_KEY, None)
    except Exception:  # noqa: BLE001 - conf lookups differ across deployments
        root = None
    if not root:
        root = spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                f"{_CHECKPOINT_KEY} is not set; point it at shared storage "
                "(the engine keeps its tables and extracts there)"
            )
        root = tempfile.mkdtemp(prefix="tidewatch-")
        spark.sparkContext.setCheckpointDir(root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([work_root(spark), "tidewatch", *parts])


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder under the work root for one run's side output."""
    suffix = os.urandom(6).hex()
    return work_path(spark, "scratch", f"{label}-{suffix}")


def materialize(df):
    """Compute ``df`` once and cut its lineage (reliable checkpoint).

    The rows go to the session's checkpoint folder (shared storage on a
    cluster), so plans that read them several times scan the source once, and
    a lost executor does not force recomputation from the source.
    """
    work_root(df.sparkSession)
    return df.checkpoint(eager=True)
