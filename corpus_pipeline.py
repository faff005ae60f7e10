"""A training corpus in five stages, each reading what the one before kept.

quality classifier -> MinHash near-dedup -> secret scan -> source mixing ->
SentencePiece.  Every stage takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next stage's ``docs``; all but the last
return the columns of ``documents``, also those named like a stage's own.

Defined results: texts that are null or empty are scored like any other, are no near
copies, hold no secret and give no ids; rows without an id are never near copies; rows
that repeat id and text are one after near-dedup; empty tables pass through empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import minhash, mixing, pieces, quality, secrets
from tidewatch.llm.common import shielded, table, written

#: Documents scored below this are rejected.
QUALITY_CUT = 0.3
#: Near duplicates: shingles of five words, Jaccard similarity of 0.8 or more.
SHINGLE_WORDS, SIMILARITY = 5, 0.8


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject; it learns from all labels."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return shielded(docs, lambda rows: quality.score(rows, model, out="_score").filter(
        F.col("_score") >= QUALITY_CUT).select(*[F.col(f"`{c}`") for c in rows.columns]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return minhash.keep_one(docs, SHINGLE_WORDS, SIMILARITY)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets that look live replaced in their texts; values that many share stay."""
    return shielded(docs, lambda rows: secrets.redact(rows, only_live=True))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the tempered weights of their sources ask, each at least once."""
    return shielded(docs, lambda rows: mixing.mixed_rows(rows, budget=None))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every remaining document and the digest of what they decode to."""
    return pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True)


STAGES = [
    ("quality classifier", keep_quality),
    ("minhash near-dedup", drop_near_copies),
    ("secret scan", redact_secrets),
    ("source mixing", mix_sources),
    ("sentencepiece", to_pieces),
]

#: The classifier's fit and the merge rounds have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
