"""Packing token ids into fixed-length rows by best-fit decreasing.

Texts become SentencePiece ids; documents longer than a row are cut losslessly into
whole rows and a rest.  Segments are packed in blocks of bounded size, longest
first: a segment tree over remaining capacities gives the fullest row that still has
room.  Packing needs no shuffle: each task packs what it reads, block by block.

A packed row holds its ids as little-endian uint16, padded with PAD; the cumulative
segment lengths (the first is 0); and, per segment, its document, which piece of the
document it is and at which position its positions reset to 0.

Defined results: null and empty texts have no ids and so no segment; null ids are
kept with their segments; rows that repeat are packed each; of no rows the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, ship_code
from .pieces import piece_bpe
from .tokens import chunks

LENGTH = 2048
PAD = 0
#: Tokens packed together at most (one longer document may exceed it).
BLOCK_TOKENS = 2_000_000

_SCHEMA = ("ids binary, n_tokens int, cu_seqlens array<int>, doc_ids array<long>, pieces array<int>, "
           "position_resets array<int>")


class Capacity:
    """Segment tree over capacities 1..n: the smallest capacity, at least a given one, that some row has."""

    def __init__(self, n: int):
        self.size = 1
        while self.size <= n:
            self.size *= 2
        self.any = [0] * (2 * self.size)  # rows below each node

    def add(self, capacity: int, by: int) -> None:
        at = capacity + self.size
        while at:
            self.any[at] += by
            at //= 2

    def at_least(self, capacity: int) -> int | None:
        at = capacity + self.size
        if self.any[at]:
            return capacity
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of item numbers; no row's sizes sum to more than ``length``."""
    rows: list[list[int]] = []
    free: dict[int, list[int]] = {}
    tree = Capacity(length)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        room = tree.at_least(sizes[i])
        if room is None:
            row, room = len(rows), length
            rows.append([])
        else:
            row = free[room].pop()
            tree.add(room, -1)
        rows[row].append(i)
        left = room - sizes[i]
        if left:
            free.setdefault(left, []).append(row)
            tree.add(left, 1)
    return rows


def cut_long(n: int, length: int) -> list[tuple[int, int]]:
    """A document's segments: whole rows, then the rest."""
    return [(a, min(a + length, n)) for a in range(0, n, length)]


def _rows(docs: list[tuple[int | None, np.ndarray]], length: int) -> pa.RecordBatch:
    parts = [(doc, piece, ids[a:b]) for doc, ids in docs for piece, (a, b) in enumerate(cut_long(len(ids), length))]
    out: list[list] = [[] for _ in range(6)]
    for row in best_fit_decreasing([len(p[2]) for p in parts], length):
        ids = np.full(length, PAD, "<u2")
        ends = [0]
        for i in row:
            ids[ends[-1]:ends[-1] + len(parts[i][2])] = parts[i][2]
            ends.append(ends[-1] + len(parts[i][2]))
        for column, value in zip(out, (ids.tobytes(), ends[-1], ends, [parts[i][0] for i in row],
                                       [parts[i][1] for i in row], ends[:-1]), strict=True):
            column.append(value)
    kinds = (pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
        names=["ids", "n_tokens", "cu_seqlens", "doc_ids", "pieces", "position_resets"])


def pack(docs: DataFrame, model: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per packed row.  ``model`` (fewer than 65,536 ids) is a path every worker can open."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(model)
        block, size = [], 0
        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            at = 0
            for run_ in chunks(texts):
                for ids in bpe.id_arrays(run_):
                    if len(ids):
                        block.append((keys[at], ids))
                        size += len(ids)
                    at += 1
                    if size >= BLOCK_TOKENS:
                        yield _rows(block, length)
                        block, size = [], 0
        if block:
            yield _rows(block, length)

    return id_text(docs, id_col, text_col).mapInArrow(run, _SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Packed rows as a Parquet table: the id matrix row by row, with its segment columns."""
    packed.write.mode("overwrite").parquet(path)


def unpacked(rows: list) -> dict:
    """Ids of each document from collected packed rows (tests and small reads)."""
    parts: dict = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u2")
        for doc, piece, a, b in zip(r["doc_ids"], r["pieces"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False):
            parts.setdefault(doc, []).append((piece, ids[a:b].tolist()))
    return {d: [x for _, ids in sorted(p, key=lambda x: x[0]) for x in ids] for d, p in parts.items()}
