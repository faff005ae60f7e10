"""Pairs of the merge table are found by hash, also where keys share a place."""

from __future__ import annotations

import numpy as np
import pytest

from tidewatch.llm import merges


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_pairs_are_found_without_a_search(n, monkeypatch):
    rng = np.random.default_rng(n)
    key = rng.choice(300 * 300, n, replace=False)
    left, right = key // 300, key % 300
    table = merges.PairTable(left, right, key % 300, np.arange(n), 300)
    entry = {pair: e for e, pair in enumerate(sorted(zip(left.tolist(), right.tolist(), strict=True)))}
    asked = np.r_[key, rng.integers(0, 300 * 300, 20_000)]
    monkeypatch.setattr(np, "searchsorted", lambda *a, **k: pytest.fail("a search per pair"))
    got = table.find((asked // 300).astype(np.int32), (asked % 300).astype(np.int32))
    assert got.tolist() == [entry.get((k // 300, k % 300), table.miss) for k in asked.tolist()]
    assert len(table.find(np.zeros(0, np.int32), np.zeros(0, np.int32))) == 0


def test_full_neighbourhoods_are_walked_through(monkeypatch):
    monkeypatch.setattr(merges.PairTable, "_place", lambda self, key: np.full(len(key), len(self.place_key) - 2))
    left, right = np.array([3, 1, 2, 1]), np.array([1, 1, 0, 3])
    table = merges.PairTable(left, right, np.array([4, 5, 6, 7]), np.arange(4), 8)
    assert table.find(left, right).tolist() == [3, 0, 2, 1]
    assert table.find(np.array([0, 5]), np.array([0, 5])).tolist() == [table.miss] * 2


def test_of_a_repeated_pair_the_first_counts():
    table = merges.PairTable(np.array([1, 1]), np.array([2, 2]), np.array([3, 4]), np.arange(2), 8)
    assert table.out[table.find(np.array([1]), np.array([2]))].tolist() == [3]
