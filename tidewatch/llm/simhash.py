"""Near-duplicate documents by SimHash with a covering family of bit masks.

Fingerprints within ``radius`` bits of each other are found without false negatives.
Bit position j gets the vector a(j) = j mod n + 1 of F2^(radius + 1), where
n = 2^(radius + 1) - 1, and each non-zero v makes one table that keys on the bits with
<a(j), v> = 1.  The vectors of any ``radius`` positions span less than the whole space,
so some v is orthogonal to all of them: its table does not look at the bits in which two
near fingerprints differ, and they collide there.  (64 bits, radius 3: 15 tables of
about 34 bits.)

Equal fingerprints fold to one class first.  A bucket of two is a pair; a bucket of up to
SMALL is compared in one task; a larger one is dealt again by the same construction over
the bits its table ignores, which leaves about 14 free bits, so that no bucket can hold
more than about 2^16 fingerprints however many documents are near copies of each other.
A bucket emits a star per connected group, never its pairs; nothing is capped.

Defined results: null, empty and blank texts have fingerprint zero, linked like any
other; a text with fewer words than a shingle is one shingle; repeated rows and rows that
share an id each get a row, linked by their own fingerprint only; rows without an id
link others like any row, and get the smallest id reachable, or none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, ship_code, written
from .graph import components

RADIUS = 3
SHINGLE_WORDS = 3
#: Fixed value: seed of the shingle hash.
HASH_SEED = 42
#: Buckets of more fingerprints are dealt again over the bits their table ignores.
SMALL = 64
#: Bytes of a text that are cut into words at once.
_PIECE = 1 << 20
_BLANKS = b" \t\n\v\f\r"


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over bit ``positions``: any ``radius`` of them lie outside at least one mask."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << p for j, p in enumerate(positions) if ((j % n + 1) & v).bit_count() & 1) for v in range(1, n + 1)]


@lru_cache(maxsize=8)
def tables(radius: int) -> tuple[list[int], list[int]]:
    """Masks of the tables, and of the tables within each table (flat, in table order)."""
    first = covering_masks(list(range(64)), radius)
    second = [m | inner for m in first
              for inner in covering_masks([p for p in range(64) if not m >> p & 1], radius)]
    return first, second


# ---- fingerprints ------------------------------------------------------------------

def _word_runs(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a piece at a time."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        while end < len(text) and text[end] not in _BLANKS:
            end += 1
        yield text[at:end].split()
        at = end


def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """64 bits, each set when over half of the k-word shingles' hashes have it."""
    counts, total, kept = np.zeros(64, np.int64), 0, []
    for run in _word_runs((text or "").encode("utf-8", "replace").lower()):  # bytes: A-Z and the six blanks alone
        kept += run
        if len(kept) >= k:
            hashes = [xxhash.xxh64_intdigest(b" ".join(w), HASH_SEED) for w in zip(*[kept[i:] for i in range(k)], strict=False)]
            counts += _bit_counts(np.array(hashes, np.uint64))
            total += len(hashes)
            kept = kept[len(kept) - k + 1:]
    if not total and kept:
        counts, total = _bit_counts(np.array([xxhash.xxh64_intdigest(b" ".join(kept), HASH_SEED)], np.uint64)), 1
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    out = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[at:at + (1 << 15)].view(np.uint8), bitorder="little")
        out += bits.reshape(-1, 64).sum(axis=0, dtype=np.uint16)
    return out


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row; ``docs`` has doc_id and text."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t.as_py(), k) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(marks.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


# ---- links -------------------------------------------------------------------------

def _grouped(marks: np.ndarray, radius: int) -> np.ndarray:
    """For each of some distinct fingerprints (sorted), the first one that chains of near ones reach."""
    spread = int(np.bitwise_or.reduce(marks ^ marks[0]))
    free = [p for p in range(64) if spread >> p & 1]
    flips = [sum(1 << p for p in c) for d in range(1, radius + 1) for c in combinations(free, d)] \
        if len(marks) > 512 else []
    label = np.arange(len(marks))
    if flips:  # many: look each near value up
        found = []
        for f in flips:
            near = marks ^ np.uint64(f)
            at = np.minimum(np.searchsorted(marks, near), len(marks) - 1)
            hit = np.flatnonzero(marks[at] == near)
            if len(hit):
                found.append((hit, at[hit]))
    else:
        x, y = np.nonzero(np.bitwise_count(marks[:, None] ^ marks[None, :]) <= radius)
        found = [(x, y)]
    while True:
        before = label.copy()
        for x, y in found:
            np.minimum.at(label, x, label[y])
        label = label[label]
        if np.array_equal(label, before):
            return label


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) of fingerprints that share a bucket (array ``fps``): a star per connected group."""
    ship_code(buckets.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for fps in batch.column("fps"):
                marks = np.unique(np.asarray(fps.values).view(np.uint64))
                label = _grouped(marks, radius)
                other = label != np.arange(len(marks))
                a.append(marks[other])
                b.append(marks[label[other]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], names=["a", "b"])

    return buckets.select("fps").mapInArrow(run, "a long, b long")


def _sized(keys: DataFrame) -> DataFrame:
    """Buckets with more than one fingerprint: their size and two of their members."""
    return keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")


def _masks(masks: list[int]) -> Column:
    return F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in masks])


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints (column fp) exactly as all pairs within ``radius`` would."""
    first, second = tables(radius)
    n = len(first)
    near = f"bit_count(a ^ b) <= {radius}"
    keys = classes.select("fp", F.posexplode(_masks(first)).alias("t", "mask")).select(
        "fp", "t", F.xxhash64("t", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
    sizes = written(_sized(keys), "simhash-buckets")
    pairs = sizes.filter("n = 2").filter(near).select("a", "b")
    several = keys.join(sizes.filter("n > 2").select("key", "n"), "key")
    small = several.filter(f"n <= {SMALL}").groupBy("key").agg(F.collect_list("fp").alias("fps"))

    # hot buckets: again by tables over the bits that the table ignores
    deeper = several.filter(f"n > {SMALL}").select("fp", "t", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("w"))
    at = F.col("t") * n + F.col("w")
    deeper = deeper.select("fp", F.xxhash64(at, F.col("fp").bitwiseAND(F.get(_masks(second), at))).alias("key"))
    inner = _sized(deeper)
    found = [pairs, _bucket_links(small, radius)]
    if not sizes.filter(f"n > {SMALL}").isEmpty():
        inner = written(inner, "simhash-inner")
        found.append(inner.filter("n = 2").filter(near).select("a", "b"))
        found.append(_bucket_links(deeper.join(inner.filter("n > 2").select("key"), "key").groupBy("key").agg(
            F.collect_list("fp").alias("fps")), radius))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def near_groups(docs: DataFrame, k: int = SHINGLE_WORDS, radius: int = RADIUS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable by links)."""
    rows = written(fingerprints(id_text(docs, id_col, text_col), k), "simhash-rows")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-classes")
    group = written(components(links(classes, radius), "simhash-star"), "simhash-groups")
    named = classes.join(group, F.col("fp") == F.col("node"), "left").select(
        "fp", "id", F.coalesce("component", "fp").alias("part"))
    least = named.groupBy("part").agg(F.min("id").alias("component_id"))
    named = named.join(least, "part").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
