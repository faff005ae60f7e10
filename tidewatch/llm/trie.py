"""Prefix trie of conversations by whole-sequence collapse.

Turns become digests, a conversation's turns one array, and conversations that are equal
as a whole one weighted sequence.  Sequences that are proper prefixes of others are
dropped by an anti-join: what is left are the leaves.  Every sequence then hands its
weight to its prefixes; a node is a prefix, known by the chained digest of its turns.

A node belongs to the sequence of its smallest conversation.  A sequence owns a suffix of
its path, so sums over subtrees need no walk down the tree: what a sequence owns is
summed from its end upwards and given to its prefixes.

Hot spots: copies of a conversation fold before they meet; parents are joined to their
children by parts (``SALTS``); the digest of a node's conversation ids is streamed over
sorted pieces of at most ``PIECE`` ids, so its memory does not grow with the node.  One
conversation's turns (28 bytes each) must fit a task.

Defined results: turns are taken in order of ``turn`` (null first), equal ones in order
of their digests; repeated rows are turns of their own; null roles and texts are empty;
rows without conv_id belong to no conversation; an empty table has no conversation and
no node.  ``c % 100`` is the remainder with the sign of c.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, ship_code, written

#: Parts of a parent's children.
SALTS = 1024
#: Bits of a conversation id that stay within a piece.
PIECE_BITS = 10
#: A conversation starts with up to HEAD - 1 turns of the first of its SPAN ids.
HEAD, SPAN = 6, 100


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as digest d and code points n of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    marked = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("has"), F.col("turn"),
        F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)).alias("d"),
        F.char_length(text).alias("n"))
    return marked.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("has", "turn", "d", "n"))).alias("turns")).select(
        "conv_id", F.expr("transform(turns, t -> struct(t.d as d, t.n as n))").alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations that start with the first turns of the first conversation of their span of ids."""
    base = F.col("conv_id") - F.col("conv_id") % SPAN
    heads = convs.filter(F.col("conv_id") % SPAN == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD - 1).alias("head"))
    own = convs.withColumn("base", base).withColumn("h", crc_mod(F.col("conv_id"), HEAD).cast("int"))
    return own.join(heads, "base", "left").select("conv_id", F.expr(
        "concat(coalesce(slice(head, 1, h), array()), slice(turns, h + 1, size(turns)))").alias("turns"))


def chained(convs: DataFrame) -> DataFrame:
    """(conv_id, node, path, sizes): path holds the keys of all prefixes, the empty one first; node is the last."""
    ship_code(convs.sparkSession)
    schema = "conv_id long, node binary, path array<binary>, sizes array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, sizes = [], []
            for row in batch.column("turns"):
                turns = row.as_py() or []
                key, path = b"", [b""]
                for t in turns:
                    key = hashlib.blake2b(key + t["d"], digest_size=16).digest()
                    path.append(key)
                paths.append(path)
                sizes.append([t["n"] for t in turns])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array([p[-1] for p in paths], pa.binary()),
                 pa.array(paths, pa.list_(pa.binary())), pa.array(sizes, pa.list_(pa.int64()))],
                names=["conv_id", "node", "path", "sizes"])

    return convs.mapInArrow(run, schema)


def end_digests(convs: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of the ids of the conversations that end in a node, ascending."""
    ship_code(convs.sparkSession)
    pieces = convs.groupBy("node", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    pieces = pieces.repartition("node").sortWithinPartitions("node", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None  # a node's pieces follow each other, across batches
        for batch in batches:
            done = []
            for at, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if state is None or at != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = at, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield _digest_rows(done)
        if state is not None:
            yield _digest_rows([(node, state.hexdigest())])

    return pieces.select("node", "ids").mapInArrow(run, "node binary, ends_sha256 string")


def _digest_rows(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
        names=["node", "ends_sha256"])


def _prefixes(seqs: DataFrame) -> DataFrame:
    """One row per prefix of each sequence."""
    return seqs.select("first_id", "weight", "leaf", F.expr(
        "inline(transform(path, (p, i) -> struct(i as depth, p as node, get(path, i - 1) as parent, "
        "coalesce(get(sizes, i - 1), 0L) as n)))"))


def nodes(convs: DataFrame) -> DataFrame:
    """The trie of ``chained`` conversations: per node conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    whole = written(convs, "trie-conversations")
    seqs = whole.groupBy("node").agg(
        F.min("conv_id").alias("first_id"), F.count(F.lit(1)).alias("weight"),
        F.first("path").alias("path"), F.first("sizes").alias("sizes"))
    seqs = written(seqs, "trie-sequences")

    # sequences that another one continues are no leaves
    continued = seqs.select(F.explode(F.expr("slice(path, 1, size(path) - 1)")).alias("node")).distinct()
    leaves = seqs.join(continued, "node", "left_anti").select("node", F.lit(1).alias("leaf"))
    seqs = seqs.join(leaves, "node", "left").select(
        "first_id", "weight", "path", "sizes", F.coalesce("leaf", F.lit(0)).alias("leaf"))
    seqs = written(seqs, "trie-weighted")

    tree = _prefixes(seqs).groupBy("node", "parent", "depth", "n").agg(
        F.min("first_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"))
    tree = written(tree.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS))), "trie-nodes")

    # what a sequence owns, summed from its end upwards, goes to its prefixes
    own = tree.select("node", F.col("conv_id").alias("first_id"), ((F.col("n_convs") - 1) * F.col("n")).alias("own"))
    upwards = Window.partitionBy("first_id").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    saved = _prefixes(seqs).select("first_id", "depth", "node").join(own, ["node", "first_id"], "left")
    saved = saved.select("node", F.sum(F.coalesce("own", F.lit(0))).over(upwards).alias("saved"))
    saved = saved.groupBy("node").agg(F.sum("saved").alias("saved_tokens"))

    # a parent meets its children by parts
    parts = tree.filter("depth > 0").groupBy("parent", "salt").agg(F.count(F.lit(1)).alias("c"))
    parts = parts.groupBy("parent").agg(F.sum("c").alias("n_children"), F.collect_list("salt").alias("salts"))
    parts = parts.withColumnRenamed("parent", "node")
    families = written(tree.join(parts, "node", "left"), "trie-families")
    above = families.filter("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.explode("salts").alias("salt"))

    out = families.join(above, ["parent", "salt"], "left").join(saved, "node").join(end_digests(whole), "node", "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie of rebuilt conversations; ``turns`` has conv_id, turn, role and text."""
    return nodes(chained(rebuilt(sequences(turns.select("conv_id", "turn", "role", "text")))))
