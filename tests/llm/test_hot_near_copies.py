"""MinHash near-dedup on large groups of near copies: linear pairs, exact components, no text lost."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidewatch.llm import minhash


def _cluster(n: int, edits: int, seed: int = 3, words: int = 150) -> list[tuple[int, str]]:
    """Near copies of one base with ``edits`` changed words each: all share keys, only some are links."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for j in rng.sample(range(words), edits):
            text[j] = f"e{i}x{j}"
        out.append((i, " ".join(text)))
    return out


def _brute(rows, k, percent):
    sets = [minhash.shingles(t, k) for _, t in rows]
    inter = minhash._common([s.view(np.uint64) for s in sets])
    size = np.array([len(s) for s in sets])
    link = 100 * inter >= percent * (size[:, None] + size - inter)
    np.fill_diagonal(link, True)
    label = np.arange(len(rows))
    while True:
        new = np.array([label[link[i]].min() for i in range(len(rows))])
        new = new[new]
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("edits", [3, 4, 6])
def test_pairs_grow_no_faster_than_rows(spark, monkeypatch, edits):
    counts = []
    real = minhash._verified

    def counted(pairs, *args):
        pairs = pairs.cache()
        counts[-1] += pairs.count()
        return real(pairs, *args)

    monkeypatch.setattr(minhash, "_verified", counted)
    for n in (150, 600):
        rows = _cluster(n, edits)
        counts.append(0)
        got = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 0.85).collect()
        want = _brute(rows, 3, 85)
        assert {r["doc_id"]: r["component_id"] for r in got} == {i: int(want[i]) for i in range(n)}
    assert counts[1] <= 6 * max(counts[0], 100)


def test_blocks_of_a_large_hub_meet_each_other(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rows = _cluster(120, 4)
    got = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 0.85).collect()
    want = _brute(rows, 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: int(want[i]) for i in range(120)}


def test_samples_of_long_texts_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SAMPLE", 64)  # sets are larger than their samples
    rows = _cluster(80, 3)
    got = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 0.85).collect()
    want = _brute(rows, 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: int(want[i]) for i in range(80)}


def test_keep_one_judges_texts_of_a_shared_id(spark):
    rng = random.Random(1)
    a, b = (" ".join(f"{p}{rng.randrange(9999)}" for _ in range(60)) for p in "ab")
    rows = [(1, a, "x"), (1, b, "y"), (2, a, "z"), (2, a, "z"), (None, a, "n"), (None, a, "n"), (5, None, "e"), (6, "", "e"), (1, b, "y")]
    got = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, _id string").repartition(3))
    assert got.columns == ["doc_id", "text", "_id"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [
        (1, a, "x"), (1, b, "y"), (None, a, "n"), (None, a, "n"), (5, None, "e"), (6, "", "e")]))
