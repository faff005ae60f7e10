"""Registered queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    imatch,
    lm,
    merkle,
    minhash,
    mixing,
    neighbours,
    packing,
    pieces,
    quality,
    secrets,
    simhash,
    tokens,
    trie,
)
from .common import crc_mod, table


def op1_minhash_tensored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies: three-word shingles, Jaccard similarity of 0.85 or more."""
    return minhash.near_groups(table(spark, sf_dir, "documents"), k=3, similarity=0.85)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels of rows with crc32(doc_id) mod 5 other than 0."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.filter(crc_mod(F.col("doc_id"), 5) != 0))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op4_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base and attention-model scores; rows with crc32(doc_id) mod 7 = 2 are held out."""
    key = F.col("doc_id")
    scored = lm.score(table(spark, sf_dir, "documents"), crc_mod(key, 7) != 2, public_tokenizers.path("byte_bpe_50k.json"))
    return scored.select("doc_id", (crc_mod(key, 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op5_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of 2,048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn to tempered source weights, with a budget of the corpus's own size."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every vector whose id is divisible by 100."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, with likenesses."""
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts, digest of base spans, all spans."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op10_sentencepiece_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document and their decoded text, as digests."""
    return pieces.encode_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), digests=True)


def op11_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies: fingerprints of three-word shingles that differ in at most 3 bits."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and verification of every document."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_minhash_tensored, op2_quality_rules, op3_token_counts, op4_attention_scores, op5_packed_ids, op6_source_mixture,
    op7_projected_neighbours, op8_imatch_fingerprints, op9_secret_scan,
    op10_sentencepiece_roundtrip, op11_simhash_covering, op12_conversation_trie, op13_merkle_manifest,
)}
