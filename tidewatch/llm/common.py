"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

#: Blank bytes that part words (fixed by the query contracts).
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; null texts become empty.

    Selecting them first keeps extra input columns, also ones named like an
    operator's results, out of the way.
    """
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def fresh(docs: DataFrame, stem: str) -> str:
    """A column name that ``docs`` does not have."""
    have = {c.lower() for c in docs.columns}
    name = f"_{stem}"
    while name in have:
        name += "_"
    return name


def shielded(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` of ``docs`` with the columns that start with ``_`` out of its way.

    Steps that carry whole rows name their own columns so; the input's have other
    names meanwhile.
    """
    safe, back = [], {}
    for c in docs.columns:
        name = c
        if c.startswith("_"):
            name = f"kept{c}"
            while name in back or name in docs.columns:
                name += "_"
            back[name] = c
        safe.append(name)
    if not back:
        return step(docs)
    out = step(docs.toDF(*safe))
    return out.toDF(*[back.get(c, c) for c in out.columns])


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """Words of the lower-cased text, in order."""
    return F.filter(F.split(lower_ascii(text), BLANKS), lambda w: w != "")


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of a key written as text, modulo ``n`` (null keys: of the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table written to the shared work folder and read back.

    Cuts the lineage: what follows reads files that every executor sees, so a
    lost executor costs only the running stage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Folder of the shipped code per application; Spark serves the file from there until the driver ends.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_code(spark: SparkSession) -> None:
    """Give this package's code to the Python workers, once per application.

    Workers then import it also where the package is installed on the driver alone.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    folder = _shipped[sc.applicationId] = tempfile.TemporaryDirectory(prefix=f"{name}-code-")
    path = os.path.join(folder.name, f"{name}-code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, files in os.walk(top):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(at, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, top)))
    sc.addPyFile(path)
