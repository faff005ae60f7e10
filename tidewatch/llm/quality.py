"""Document quality by a sparse rule ensemble.

1. Statistics of each whole text (byte classes, word and line repetition).
2. Boosted shallow trees over the statistics of labelled documents; every path
   from a root is a conjunctive rule ("a <= x and b > y").
3. Lasso logistic weights for the rules and the (scaled) statistics; most become zero.
4. The remaining rules are compiled into one Spark column expression.

Fitting uses a bounded sample of labelled rows (``max_rows``, by hash of the id); one
task fits on its numbers, and only the rules come to the driver.  Scoring is map-only.

Defined results: null and empty texts have all statistics at zero and get the
score of those; ids that repeat among the labels count once, by their mean label
(a half counts as 1); null labels are ignored; without usable labels every score
is 0.5; rows that repeat each get a row; null ids are kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_text, ship_code

#: Labelled rows that a fit may use at most.
MAX_ROWS = 20_000

STATS = (
    "log_chars", "word_len", "upper", "digit", "mark", "symbol", "bang", "bar", "stop", "comma", "blank",
    "newline", "high_bytes", "new_words", "new_lines", "short_words", "long_words", "top_word", "longest", "line_len",
)
_SCHEMA = T.StructType([T.StructField(s, T.DoubleType(), False) for s in STATS])


def _class(chars: str) -> np.ndarray:
    hit = np.zeros(256)
    hit[list(chars.encode())] = 1
    return hit


_CLASSES = np.stack([
    _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789"), _class("\"'()[]{}:;/\\_-"), _class("#$%&*@^~+=<>"),
    _class("!?"), _class("|"), _class("."), _class(","), _class(" \t\r\x0b\x0c"), _class("\n"),
    np.r_[np.zeros(128), np.ones(128)],
], axis=1)


def text_stats(text: str | None) -> tuple[float, ...]:
    """STATS of one text."""
    raw = (text or "").encode("utf-8", "replace")
    if not raw:
        return (0.0,) * len(STATS)
    n = len(raw)
    upper, digit, mark, symbol, bang, bar, stop, comma, blank, newline, high = (
        np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES / n)
    words = raw.lower().split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    k = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    return (
        float(np.log1p(n)), float(lengths.mean()), upper, digit, mark, symbol, bang, bar, stop, comma, blank, newline,
        high, len(seen) / k, len(set(lines)) / max(len(lines), 1), float((lengths <= 3).mean()),
        float((lengths > 12).mean()), max(seen.values(), default=0) / k, float(np.log1p(lengths.max())),
        float(np.log1p(n / max(len(lines), 1))),
    )


@F.pandas_udf(_SCHEMA)
def _stats_udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([text_stats(t) for t in texts], columns=list(STATS), dtype="float64")


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_stats``."""
    ship_code(docs.sparkSession)
    return docs.withColumn("_stats", _stats_udf(F.col(text_col)))


# ---- fitting (one task, on at most MAX_ROWS rows of numbers)


def _grow(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, feats: np.ndarray, depth: int,
          path: tuple, paths: list, value: np.ndarray, least: int, n_bins: int, rate: float) -> None:
    """One regression tree on binned statistics; appends each node's path, adds leaf values to ``value``."""
    g, h = grad[rows], hess[rows]
    best = (1e-6, -1, -1)
    if depth and len(rows) >= 2 * least:
        total_g, total_h = g.sum(), h.sum()
        base = total_g ** 2 / (total_h + 1)
        for f in feats:
            b = bins[rows, f]
            gl = np.cumsum(np.bincount(b, g, n_bins))[:-1]
            hl = np.cumsum(np.bincount(b, h, n_bins))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=n_bins))[:-1]
            gain = gl ** 2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1) - base
            gain[(nl < least) | (len(rows) - nl < least)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), int(f), k)
    if best[1] < 0:
        value[rows] += rate * g.sum() / (h.sum() + 1)
        return
    _, f, k = best
    left = bins[rows, f] <= k
    for side, part in (("<=", rows[left]), (">", rows[~left])):
        deeper = (*path, (f, side, k))
        paths.append(deeper)
        _grow(bins, grad, hess, part, feats, depth - 1, deeper, paths, value, least, n_bins, rate)


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, bins: int = 32, most: int = 400,
              penalty: float = 1e-3, steps: int = 200, seed: int = 7) -> dict:
    """Rules, their lasso logistic weights and the linear part, as plain numbers."""
    n, d = x.shape
    prior = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    empty = {"bias": float(np.log(prior / (1 - prior))), "rules": [], "linear": []}
    if n < 20 or y.min() == y.max():
        return empty if n else {**empty, "bias": 0.0}
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(d)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(d)], axis=1)
    margin, paths = np.full(n, empty["bias"]), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(rng.random(n) < 0.7)
        feats = rng.permutation(d)[: max(3, d * 2 // 3)]
        grown = np.zeros(n)
        own: list = []
        _grow(binned, y - p, p * (1 - p), rows, feats, depth, (), own, grown, max(5, n // 400), bins + 1, 0.3)
        paths += own
        # documents outside the bag follow the same paths in the next tree's gradient
        margin += grown
    rules, columns, seen = [], [], set()
    for path in paths:
        box: dict = {}
        for f, side, k in path:
            low, high = box.get(f, (-1, bins + 1))
            box[f] = (max(low, k), high) if side == ">" else (low, min(high, k))
        hit = np.ones(n, bool)
        for f, (low, high) in box.items():
            hit &= (binned[:, f] > low) & (binned[:, f] <= high)
        key = hit.tobytes()
        if 0 < hit.sum() < n and key not in seen and len(rules) < most:
            seen.add(key)
            rules.append([(f, None if low < 0 else float(cuts[f][low]), None if high >= len(cuts[f]) else float(cuts[f][high]))
                          for f, (low, high) in sorted(box.items())])
            columns.append(hit)
    low, high = np.quantile(x, [0.025, 0.975], axis=0)
    wide = high > low
    lin = (np.clip(x, low, high) - low) / np.where(wide, high - low, 1) * wide
    # one matrix in single precision, standardised in place a column at a time
    a = np.empty((n, len(columns) + d), np.float32, order="F")
    mean, scale = np.zeros(a.shape[1]), np.zeros(a.shape[1])
    for j in range(a.shape[1]):
        own = columns[j].astype(np.float64) if j < len(columns) else lin[:, j - len(columns)]
        mean[j], scale[j] = own.mean(), max(own.std(), 0.05)
        a[:, j] = (own - mean[j]) / scale[j]
    del columns, lin
    # accelerated proximal gradient (FISTA) for mean log loss + penalty * |w|
    w, v, b, vb, t = np.zeros(a.shape[1]), np.zeros(a.shape[1]), empty["bias"], empty["bias"], 1.0
    u = rng.normal(size=a.shape[1]).astype(np.float32)
    for _ in range(12):
        u = a.T @ (a @ u)
        u /= np.linalg.norm(u)
    lip = 0.25 * (np.linalg.norm(a @ u) ** 2 / n + 1)
    for _ in range(steps):
        r = 1 / (1 + np.exp(-((a @ v.astype(np.float32)).astype(np.float64) + vb))) - y
        new = v - (a.T @ r.astype(np.float32)).astype(np.float64) / n / lip
        new = np.sign(new) * np.maximum(np.abs(new) - penalty / lip, 0)
        nb = vb - r.mean() / lip
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = new, nb, nt
    w = w / scale
    bias = float(b - w @ mean)
    k = len(rules)
    return {
        "bias": bias, "rules": [(r, float(c)) for r, c in zip(rules, w[:k], strict=True) if c],
        "linear": [(f, float(low[f]), float(high[f]), float(w[k + f])) for f in range(d) if w[k + f] and wide[f]],
    }


def compile_rules(model: dict, stats: str = "_stats") -> Column:
    """The model's probability as a column expression over the statistics."""
    s = lambda f: f"{stats}.{STATS[f]}"
    terms = [repr(model["bias"]) + "D"]
    for rule, weight in model["rules"]:
        parts = [*(f"{s(f)} > {low!r}D" for f, low, _ in rule if low is not None),
                 *(f"{s(f)} <= {high!r}D" for f, _, high in rule if high is not None)]
        terms.append(f"if({' and '.join(parts) or 'true'}, {weight!r}D, 0D)")
    for f, low, high, weight in model["linear"]:
        terms.append(f"{weight / (high - low)!r}D * (least(greatest({s(f)}, {low!r}D), {high!r}D) - {low!r}D)")
    # sums of bounded length: one flat sum of all terms would nest as deep as it is long
    while len(terms) > 1:
        terms = ["(" + " + ".join(terms[i:i + 8]) + ")" for i in range(0, len(terms), 8)]
    return 1 / (1 + F.exp(-F.expr(terms[0])))


def score_numpy(model: dict, x: np.ndarray) -> np.ndarray:
    """What the compiled expression gives, for tests."""
    z = np.full(len(x), model["bias"])
    for rule, weight in model["rules"]:
        hit = np.ones(len(x), bool)
        for f, low, high in rule:
            hit &= (x[:, f] > low) if low is not None else True
            hit &= (x[:, f] <= high) if high is not None else True
        z += weight * hit
    for f, low, high, weight in model["linear"]:
        z += weight / (high - low) * (np.clip(x[:, f], low, high) - low)
    return 1 / (1 + np.exp(-z))


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The model of all rows of a task, as JSON (which keeps doubles exactly)."""
    frames = list(batches) or [pd.DataFrame(columns=["doc_id", "y", *STATS])]
    got = pd.concat(frames).sort_values("doc_id")
    yield pd.DataFrame({"model": [json.dumps(fit_rules(got[list(STATS)].to_numpy(np.float64), got["y"].to_numpy(np.float64)))]})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_ROWS) -> dict:
    """Fit on at most ``max_rows`` labelled documents, chosen by hash of the id."""
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).filter(
        "doc_id is not null and y is not null")
    marked = marked.groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    marked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = id_text(docs, id_col, text_col).join(F.broadcast(marked), "doc_id")
    # an id that repeats among the documents counts once
    got = with_stats(rows).select("doc_id", "y", "_stats.*").dropDuplicates(["doc_id"])
    fitted = got.repartition(1).mapInPandas(_fit, "model string").first()
    return json.loads(fitted["model"]) if fitted else fit_rules(np.zeros((0, len(STATS))), np.zeros(0))


def score(docs: DataFrame, model: dict, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 as column ``out``."""
    return with_stats(docs, text_col).withColumn(out, compile_rules(model)).drop("_stats")
