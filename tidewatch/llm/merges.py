"""Byte-pair merges over many words at once, as rounds on flat numpy arrays.

All words of a batch lie in one symbol array.  A round finds each word's best
(lowest-rank) adjacent pair by a segmented minimum, merges all its occurrences from
the left, and closes the gaps; words without a pair leave.  Only pairs next to a
merge are looked up again.

Merging all occurrences at once equals merging one by one unless the new symbol can
at once take part in a pair ranked no later than its own.  Of several such hits in
a word (known from the table beforehand) a round takes only the leftmost; a long word
that has them is finished one merge at a time with a heap.
"""

from __future__ import annotations

import heapq

import numpy as np

_NONE = np.iinfo(np.int32).max
#: Words of more symbols than this are not left to rounds of one merge each.
_LONG = 256


class PairTable:
    """Ranked pairs (left, right) -> merged symbol."""

    def __init__(self, left: np.ndarray, right: np.ndarray, out: np.ndarray, rank: np.ndarray, n_symbols: int):
        self.n = int(n_symbols) + 1
        key = left.astype(np.int64) * self.n + right
        order = np.argsort(key, kind="stable")
        self.keys = key[order]
        self.out = np.append(out[order], -1).astype(np.int32)
        self.rank = np.append(rank[order], _NONE).astype(np.int32)
        # earliest rank at which a symbol takes part in a pair
        first = np.full(self.n, _NONE, np.int64)
        np.minimum.at(first, left, rank)
        np.minimum.at(first, right, rank)
        self.slow = np.append(first[out[order]] <= rank[order], False)
        self.miss = len(self.keys)
        # places by hash, at least four per key; a taken place sends a key on to the next one
        self.bits = max(self.miss * 4 - 1, 1).bit_length()
        self.place_key = np.full(1 << self.bits, -1, np.int64)
        self.place_entry = np.full(1 << self.bits, self.miss, np.int32)
        todo = np.flatnonzero(np.r_[True, self.keys[1:] != self.keys[:-1]][:self.miss])
        at = self._place(self.keys[todo])
        while len(todo):
            free, chosen = np.unique(at, return_index=True)
            chosen = chosen[self.place_key[free] < 0]
            self.place_key[at[chosen]], self.place_entry[at[chosen]] = self.keys[todo[chosen]], todo[chosen]
            rest = np.ones(len(todo), bool)
            rest[chosen] = False
            todo, at = todo[rest], self._after(at[rest])

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _after(self, place: np.ndarray) -> np.ndarray:
        return (place + 1) & (len(self.place_key) - 1)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Entry of each pair, ``miss`` where there is none."""
        key = left.astype(np.int64) * self.n + right
        at = self._place(key)
        there = self.place_key[at]
        hit = there == key
        entry = np.where(hit, self.place_entry[at], np.int32(self.miss))
        more = np.flatnonzero(~hit & (there >= 0))
        at = at[more]
        while len(more):  # another key has the place: look in the next one, up to a free one
            at = self._after(at)
            there = self.place_key[at]
            hit = there == key[more]
            entry[more[hit]] = self.place_entry[at[hit]]
            on = ~hit & (there >= 0)
            more, at = more[on], at[on]
        return entry


def _one_by_one(sym: list[int], table: PairTable) -> list[int]:
    """Exact sequential merges of one word: best rank first, then leftmost."""
    n = len(sym)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int, int]] = []

    def push(lefts: list[int], rights: list[int]) -> None:
        if not lefts:
            return
        a = np.array([sym[i] for i in lefts], np.int64)
        b = np.array([sym[j] for j in rights], np.int64)
        for i, j, e in zip(lefts, rights, table.find(a, b).tolist(), strict=True):
            if e != table.miss:
                heapq.heappush(heap, (int(table.rank[e]), i, sym[i], sym[j], e))

    push(list(range(n - 1)), list(range(1, n)))
    while heap:
        _, i, a, b, e = heapq.heappop(heap)
        j = right[i]
        if not alive[i] or sym[i] != a or j >= n or sym[j] != b:
            continue
        sym[i], alive[j] = int(table.out[e]), False
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        pairs = [(left[i], i)] * (left[i] >= 0) + [(i, right[i])] * (right[i] < n)
        push([p for p, _ in pairs], [q for _, q in pairs])
    return [s for s, ok in zip(sym, alive, strict=True) if ok]


def merge_words(sym: np.ndarray, starts: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merged symbols of all words, flat, and the words' offsets (one more than words).

    ``starts`` are offsets into ``sym`` with the total length last; words may be empty.
    """
    n_words = len(starts) - 1
    lengths = np.diff(starts)
    word = np.repeat(np.arange(n_words, dtype=np.int32), lengths)
    sym = sym.astype(np.int32)
    final_sym, final_word = [], []
    entry = np.full(len(sym), table.miss, np.int32)
    if len(sym) > 1:
        entry[:-1] = table.find(sym[:-1], sym[1:])
        entry[:-1][word[:-1] != word[1:]] = table.miss
    while len(sym):
        rank = table.rank[entry]
        heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.r_[heads, len(sym)]))
        hit = (rank == best) & (best != _NONE)
        leave = best == _NONE
        keep = ~leave
        slow = hit & table.slow[entry]
        if slow.any():
            # only the leftmost of several such hits is sure; long words go on alone
            at = np.flatnonzero(slow)
            again = np.r_[False, word[at[1:]] == word[at[:-1]]]
            hit[at[again]] = False
            several = np.unique(word[at[again]])
            size = np.searchsorted(word, several + 1) - np.searchsorted(word, several)
            for w in several[size > _LONG].tolist():
                a, b = np.searchsorted(word, [w, w + 1])
                merged = _one_by_one(sym[a:b].tolist(), table)
                final_sym.append(np.array(merged, np.int32))
                final_word.append(np.full(len(merged), w, np.int32))
                keep[a:b] = False
        if leave.any():
            final_sym.append(sym[leave])
            final_word.append(word[leave])
        if not keep.all():
            sym, word, entry, hit = sym[keep], word[keep], entry[keep], hit[keep]
            if not len(sym):
                break
        at = np.flatnonzero(hit)
        # in a run of overlapping hits take every second, from the left
        run = np.r_[True, np.diff(at) != 1]
        first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - first) % 2 == 0]
        sym[at] = table.out[entry[at]]
        stay = np.ones(len(sym), bool)
        stay[at + 1] = False
        moved = np.cumsum(stay) - 1
        sym, word, entry, at = sym[stay], word[stay], entry[stay], moved[at]
        near = np.zeros(len(sym), bool)
        near[at] = near[at[at > 0] - 1] = True
        look = np.flatnonzero(near)
        nxt = np.minimum(look + 1, len(sym) - 1)
        fresh = table.find(sym[look], sym[nxt])
        fresh[(word[look] != word[nxt]) | (nxt == look)] = table.miss
        entry[look] = fresh
    if not final_sym:
        return np.zeros(0, np.int32), np.zeros(n_words + 1, np.int64)
    sym, word = np.concatenate(final_sym), np.concatenate(final_word)
    order = np.argsort(word, kind="stable")
    counts = np.bincount(word, minlength=n_words)
    return sym[order], np.r_[0, np.cumsum(counts)]
