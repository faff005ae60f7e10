"""Raw click-stream files (CSV with a header)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.schemas import EVENTS_RAW


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read raw event CSV, every column as text, matched by header name.

    No type inference: inference needs an extra pass over the whole file and
    would change the text the surrogate key is hashed from.  The header alone
    names the columns, in whatever order; all files of one read share that
    order (each file's header is checked against it).  A header that lacks a
    column is refused.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path)
    missing = [n for n in EVENTS_RAW.names if n not in raw.columns]
    if missing:
        raise ValueError(f"{path}: header lacks {', '.join(missing)}")
    return raw.select(*EVENTS_RAW.names)


def write_raw_csv(raw: DataFrame, path: str) -> None:
    """Write raw text rows as header CSV (one file per task, no single-writer funnel), blanks as they are."""
    (raw.write.mode("overwrite").option("header", True).option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
