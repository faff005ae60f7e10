"""Approximate nearest neighbours by low-dimensional stable projections and kd-trees.

Vectors are projected to M Gaussian (2-stable) directions.  The top of one kd-tree
over the projections, fitted on a bounded sample, deals all vectors into cells; a
kd-tree is built in each cell.  A query first searches its own cell, then every
cell that its k-th distance so far leaves open.  Tree leaves are taken by their projected distance;
their points are verified with the original vectors.  The search stops when a
point as near as the k-th so far would project beyond the current leaf with a
chance of at most 1 - STOP: the squared ratio of projected to true distance follows a
chi-square law with M degrees of freedom.

Defined results: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part; nor do rows without id.  Of rows that
share an id the smallest vector counts.  Equal vectors are searched once: only the
k + 1 smallest ids of each can be among any k nearest.  Ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_code, written

#: Projected dimensions (even: the chi-square law then has a closed form).
M = 8
#: Chance that a true neighbour projects inside the searched radius.
STOP = 0.98
#: Vectors per cell aimed at, per tree leaf, and of the sample that cells are fitted on.
CELL_ROWS, LEAF_ROWS, SAMPLE_ROWS = 8192, 64, 20_000
#: Queries that one task searches in a cell.
QUERY_BLOCK = 4096
SEED = 5


def chi_square_radius(stop: float = STOP, m: int = M) -> float:
    """r with P(chi-square of m degrees <= r * r) = stop."""
    def cdf(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))

    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < stop else (low, mid)
    return math.sqrt(high)


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(dim, M))


def usable(vec: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


class Cells:
    """Top of the kd-tree: splits of projected space into cells, with their boxes."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.splits: list[tuple[int, float, int, int]] = []  # axis, value, left, right (negative: -1 - cell)
        self.low, self.high = [], []
        self.root = self._split(sample, max(1, cells), np.full(M, -np.inf), np.full(M, np.inf))
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _split(self, x: np.ndarray, cells: int, low: np.ndarray, high: np.ndarray) -> int:
        spread = x.max(0) - x.min(0) if len(x) else np.zeros(M)
        if cells <= 1 or len(x) < 2 or spread.max() <= 0:
            self.low.append(low)
            self.high.append(high)
            return -len(self.low)
        axis = int(spread.argmax())
        value = float(np.median(x[:, axis]))
        if value >= x[:, axis].max():
            value = float(x[x[:, axis] < value, axis].max())
        at = len(self.splits)
        self.splits.append((axis, value, 0, 0))
        left, right = x[:, axis] <= value, x[:, axis] > value
        up, down = high.copy(), low.copy()
        up[axis], down[axis] = value, value
        a = self._split(x[left], cells // 2, low, up)
        b = self._split(x[right], cells - cells // 2, down, high)
        self.splits[at] = (axis, value, a, b)
        return at

    def of(self, x: np.ndarray) -> np.ndarray:
        """Cell of each projected row."""
        out = np.zeros(len(x), np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
            elif len(rows):
                axis, value, a, b = self.splits[node]
                left = x[rows, axis] <= value
                todo += [(a, rows[left]), (b, rows[~left])]
        return out

    def reached(self, q: np.ndarray, radius: float) -> np.ndarray:
        """Cells whose box comes within ``radius`` of ``q``."""
        gap = np.maximum(0, np.maximum(self.low - q, q - self.high))
        return np.flatnonzero((gap ** 2).sum(1) < radius * radius)


class Tree:
    """kd-tree of a cell's projections, kept as its leaves and their boxes."""

    def __init__(self, proj: np.ndarray):
        self.rows, self.low, self.high = [], [], []
        todo = [np.arange(len(proj))]
        while todo:
            rows = todo.pop()
            x = proj[rows]
            low, high = x.min(0), x.max(0)
            axis = int((high - low).argmax())
            if len(rows) <= LEAF_ROWS or high[axis] == low[axis]:
                self.rows.append(rows)
                self.low.append(low)
                self.high.append(high)
                continue
            order = rows[np.argsort(x[:, axis], kind="stable")]
            todo += [order[: len(order) // 2], order[len(order) // 2:]]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def search(self, q: np.ndarray, p: np.ndarray, vecs: np.ndarray, proj: np.ndarray, k: int, factor: float,
               start: float) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest verified rows and their distances; ``start`` bounds the k-th from before."""
        gap = np.maximum(0, np.maximum(self.low - p, p - self.high))
        gap = np.sqrt((gap ** 2).sum(1))
        best_rows, best = np.zeros(0, np.int64), np.zeros(0)
        limit = start
        for leaf in np.argsort(gap, kind="stable"):
            if gap[leaf] >= limit * factor:
                break
            rows = self.rows[leaf]
            near = np.sqrt(((proj[rows] - p) ** 2).sum(1)) < limit * factor
            rows = rows[near] if np.isfinite(limit) else rows
            if not len(rows):
                continue
            d = np.sqrt(((vecs[rows] - q) ** 2).sum(1))
            best_rows, best = np.r_[best_rows, rows], np.r_[best, d]
            if len(best) > k:
                keep = np.argsort(best, kind="stable")[:k]
                best_rows, best = best_rows[keep], best[keep]
            if len(best) == k:
                limit = min(limit, float(best.max()))
        return best_rows, best


_HITS = "query_id long, ids array<long>, score double"


def _searcher(w: np.ndarray, k: int, factor: float):
    """Searches a block of queries in one cell."""
    def run(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(points) and len(queries):
            vecs = np.stack(points["vec"].to_numpy()).astype(np.float64)
            proj = vecs @ w
            tree = Tree(proj)
            qs = np.stack(queries["vec"].to_numpy()).astype(np.float64)
            ids = points["ids"].to_list()
            for qid, q, p, start in zip(queries["query_id"], qs, qs @ w, queries["reach"], strict=True):
                rows, d = tree.search(q, p, vecs, proj, k + 1, factor, start)
                found += [(qid, ids[r], x) for r, x in zip(rows.tolist(), d.tolist(), strict=True)]
        return pd.DataFrame(found, columns=["query_id", "ids", "score"])

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
            vec_col: str = "embedding", stop: float = STOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found to each query row, Euclidean, in doubles."""
    spark = vectors.sparkSession
    ship_code(spark)
    rows = vectors.withColumn("_query", F.coalesce(is_query, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"), F.col("_query").alias("query"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    dims = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if dims is None:
        return empty
    rows = rows.filter(F.size("vec") == dims["dim"]).groupBy("vec_id").agg(
        F.min("vec").alias("vec"), F.bool_or("query").alias("query"))
    rows = written(rows, "nn-rows")
    first = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    classes = rows.select("vec", "vec_id", first.alias("n")).filter(F.col("n") <= k + 1)
    classes = classes.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    w = directions(dims["dim"])
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vec").toPandas()
    cells = Cells(np.unique(np.stack(sample["vec"].to_numpy()), axis=0) @ w, -(-n // CELL_ROWS))
    shape = ", ".join(["ids array<long>", "vec array<double>"])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = b.column("vec")
            x = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(vec), -1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells.of(x @ w))], names=[*b.schema.names, "cell"])

    points = written(classes.select("ids", "vec").mapInArrow(dealt, f"{shape}, cell long"), "nn-cells")
    queries = rows.filter("query").select(F.col("vec_id").alias("query_id"), "vec")
    queries = written(queries.mapInArrow(dealt, "query_id long, vec array<double>, cell long"), "nn-queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    # queries come in blocks, so that no task holds all of them; each block sees every cell it needs
    spread = points.withColumn("part", F.explode(F.array(*[F.lit(i) for i in range(blocks)]))) if blocks > 1 \
        else points.withColumn("part", F.lit(0))
    factor = chi_square_radius(stop)
    search = _searcher(w, k, factor)

    def found(asked: DataFrame) -> DataFrame:
        asked = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
        return spread.groupBy("cell", "part").cogroup(asked.groupBy("cell", "part")).applyInPandas(search, _HITS)

    own = written(found(queries.withColumn("reach", F.lit(float("inf")))), "nn-own")
    kth = own.select("query_id", "score", F.row_number().over(
        Window.partitionBy("query_id").orderBy("score")).alias("n")).filter(F.col("n") == k + 1)
    open_ = queries.join(kth.select("query_id", F.col("score").alias("reach")), "query_id", "left").select(
        "query_id", "vec", F.col("cell").alias("home"), F.coalesce("reach", F.lit(float("inf"))).alias("reach"))

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for q, v, home, reach in zip(b["query_id"], b["vec"], b["home"], b["reach"], strict=True):
                out += [(q, v, reach, c) for c in cells.reached(np.asarray(v) @ w, reach * factor).tolist() if c != home]
            yield pd.DataFrame(out, columns=["query_id", "vec", "reach", "cell"])

    more = found(open_.mapInPandas(routed, "query_id long, vec array<double>, reach double, cell long"))
    hits = own.unionByName(more).select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
