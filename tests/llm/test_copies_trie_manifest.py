"""Covering SimHash, conversation trie and Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
import xxhash

from tidewatch.llm import graph, merkle, simhash, trie
from tidewatch.llm.oracle import ORACLES
from tidewatch.llm.queries import QUERIES

SF_SMALL, SF_ORACLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, fp string, fps string, g string, leaf string, "
        "idx int, path string, component_id string, n string, key string, word string, id string, node string, bent string")


def _doc(doc_id, text, lang="en", source="s", n_chars=1):
    return doc_id, text, lang, source, n_chars, *["x"] * 4, 7, *["y"] * 8


def _counted(rows):
    return Counter(tuple(r) for r in rows)


# ---- covering SimHash ---------------------------------------------------------------

def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(marks, radius):
    """Label of each distinct mark: the smallest mark reachable."""
    marks = sorted(set(marks))
    seen = {}
    for m in marks:
        if m in seen:
            continue
        todo, seen[m] = [m], m
        while todo:
            x = todo.pop()
            for y in marks:
                if y not in seen and (x ^ y).bit_count() <= radius:
                    seen[y] = m
                    todo.append(y)
    return seen


def _texts():
    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(400)]
    near = [" ".join(base[:k] + ["other"] + base[k + 1:]) for k in (3, 200, 390)]
    return [None, "", " \n\t", "A", "a", "É b", "b É", "x\x1cy z", "one two", "One  TWO", " ".join(base), " ".join(base).upper(), *near,
            "日本語 テキスト 😀 a", " ".join(f"q{i}" for i in range(20_000)), "aa " * 5000,
            *[" ".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(20)]]


def test_covering_masks_reach_every_pair():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(list(range(64)), radius)
        for flips in combinations(range(64), radius):
            bits = sum(1 << b for b in flips)
            assert any(not m & bits for m in masks)
    first, second = simhash.tables(3)
    assert len(first) == 15 and len(second) == 225
    assert all(s & f == f for i, f in enumerate(first) for s in second[15 * i:15 * i + 15])
    assert max(64 - s.bit_count() for s in second) <= 16  # a bucket of the inner tables is bounded


def test_fingerprints_match_their_definition(monkeypatch):
    monkeypatch.setattr(simhash, "_PIECE", 50)  # long texts a piece at a time
    for t in _texts():
        assert simhash.fingerprint(t) == _fingerprint(t)


def test_near_groups_match_brute_force(spark):
    rows = [_doc(i, t) for i, t in enumerate(_texts())]
    rows += [rows[4], _doc(3, "another text of id three"), _doc(None, "a"), _doc(None, "alone without id")]
    got = simhash.near_groups(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    marks = [_fingerprint(r[1]) for r in rows]
    label = _components(marks, 3)
    least = {}
    for r, m in zip(rows, marks, strict=True):
        if r[0] is not None:
            least[label[m]] = min(least.get(label[m], r[0]), r[0])
    assert _counted(got) == Counter((r[0], f"{m:016x}", least.get(label[m])) for r, m in zip(rows, marks, strict=True))
    assert simhash.near_groups(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("small", [64, 3])
def test_links_connect_like_all_pairs(spark, monkeypatch, small):
    """Chains, loose values and a hot cluster, with buckets compared at once and dealt again."""
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(8)
    marks = {rng.getrandbits(64) for _ in range(300)}
    for start in (0, (1 << 64) - 1, rng.getrandbits(64)):
        at = start
        for _ in range(30):  # chains by steps of up to four bits: some steps part them
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                at ^= 1 << b
            marks.add(at)
    hot = rng.getrandbits(64)
    free = rng.sample(range(64), 14)
    marks |= {hot ^ sum(1 << b for b in free if rng.random() < 0.5) for _ in range(500)}
    signed = [(m - (1 << 64) if m >> 63 else m,) for m in marks]
    links = simhash.links(spark.createDataFrame(signed, "fp long"))
    rows = links.collect()
    assert all((r.a & (1 << 64) - 1) in marks and (r.b & (1 << 64) - 1) in marks for r in rows)
    assert len(rows) <= 15 * 225 * len(marks)
    group = {r.node & (1 << 64) - 1: r.component for r in graph.components(links).collect()}
    want = _components(marks, 3)
    parts, named = defaultdict(set), defaultdict(set)
    for m in marks:
        parts[want[m]].add(m)
        named[group.get(m, m if m < 1 << 63 else m - (1 << 64))].add(m)
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, named.values()))


def test_many_near_values_in_one_bucket():
    """Lookups of near values and the matrix of a small bucket agree; links stay fewer than members."""
    rng = np.random.default_rng(3)
    marks = np.unique(rng.integers(0, 1 << 14, 700).astype(np.uint64))
    label = simhash._grouped(marks, 3)
    want = _components([int(m) for m in marks], 3)
    assert [int(marks[k]) for k in label] == [want[int(m)] for m in marks]


# ---- conversations -------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, node string, depth int, path string, d string, n string, base string, h int"


def _turn(c, turn, role, text):
    return c, turn, role, text, *["z"] * 1, 1, *["z"] * 4, 2


def _conversations():
    rng = random.Random(4)
    out = []
    for c in [0, 100, 200, *range(1, 60), *range(101, 130), 305, 307, -5, -100, -105, 5_000_000_000]:
        for t in range(rng.randrange(1, 5) if c % 100 else 7):
            out.append(_turn(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "long " * 40, "", None, "é😀"])))
    for c in range(400, 470):  # copies
        out += [_turn(c, t, "user", f"same {t}") for t in range(3)]
    out += [out[5], out[5], _turn(7, None, "user", "no turn"), _turn(7, None, "user", "no turn either"),
            _turn(None, 0, "user", "no conversation"), _turn(None, None, None, None), _turn(3000, 0, "user", "deep")]
    out += [_turn(9000, t, "user", "x" * t) for t in range(300)]
    return out


def _trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            d = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs[c].append(((turn is not None, turn or 0, d), (role, text)))
    convs = {c: [t for _, t in sorted(v)] for c, v in convs.items()}
    paths = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        paths[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
        ends[p].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, ms in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(ms) - 1) * len(p[-1][1]) if p else 0
    return Counter((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, ms in members.items())


@pytest.mark.parametrize("salts,bits", [(1024, 10), (3, 2)])
def test_trie_matches_brute_force(spark, monkeypatch, salts, bits):
    monkeypatch.setattr(trie, "SALTS", salts)
    monkeypatch.setattr(trie, "PIECE_BITS", bits)
    rows = _conversations()
    got = trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(5))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert _counted(got.collect()) == _trie(rows)
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_trie_of_the_given_table(spark):
    rows = spark.read.parquet(f"{SF_ORACLE}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert _counted(QUERIES["op12_conversation_trie"](spark, SF_ORACLE).collect()) == _trie(rows)


# ---- Merkle manifest -----------------------------------------------------------------

def _h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _leaf(doc_id, source, lang, n_chars, text):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def _levels(nodes):
    out = [list(nodes)]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def _path(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((level[i - 1] if i % 2 else "", level[i + 1] if i % 2 == 0 and i + 1 < len(level) else ""))
        i //= 2
    return out


def _manifest(rows):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf, bent = _leaf(doc_id, source, lang, n_chars, text), None
        if doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
            bent = _leaf(doc_id, source, lang, n_chars + 1, text)
        groups[(lang is not None, (lang or "").encode())].append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, bent))
    names = sorted(groups)
    trees = {g: _levels([r[2] for r in sorted(groups[g], key=lambda r: r[0])]) for g in names}
    top = _levels([trees[g][-1][0] for g in names])
    out = Counter()
    for k, g in enumerate(names):
        for i, (_, doc_id, leaf, bent) in enumerate(sorted(groups[g], key=lambda r: r[0])):
            path = _path(trees[g], i) + _path(top, k)
            folded = bent or leaf
            for before, after in path:
                folded = _h(before + folded + after)
            out[(doc_id, leaf, trees[g][-1][0], top[-1][0], _h("".join(a + b for a, b in path)), folded, folded == top[-1][0])] += 1
    return out


def _documents():
    rng = random.Random(9)
    out = [_doc(i, f"text {i}", rng.choice(["en", "en", "de", "fr", "", None, "日本"]), rng.choice([None, "s1", ""]),
                rng.choice([None, 0, 5, (1 << 63) - 1])) for i in range(150)]
    out += [_doc(i, None) for i in (-1, -64, -65, -7000, 1 << 40, (1 << 63) - 1, -(1 << 63))]
    out += [out[3]] * 5 + [_doc(500, f"shared id {i}") for i in range(30)] + [_doc(500, "shared id 7")] * 9
    out += [_doc(None, f"no id {i % 9}", rng.choice(["en", None])) for i in range(40)]
    out += [_doc(7000, "alone in its language", "zz"), _doc(7001, "a " * 40_000), _doc(7002, ""), _doc(7003, "one", "y1"), _doc(7004, "two", "y1")]
    return out


@pytest.mark.parametrize("fan,digits", [(10, 4), (4, 1)])
def test_manifest_matches_brute_force(spark, monkeypatch, fan, digits):
    monkeypatch.setattr(merkle, "FAN_BITS", fan)
    monkeypatch.setattr(merkle, "TIE_DIGITS", digits)
    rows = _documents()
    got = merkle.manifest(spark.createDataFrame(rows, DOCS).repartition(5))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert _counted(got.collect()) == _manifest(rows)


@pytest.mark.parametrize("rows", [[], [_doc(1, "one")], [_doc(None, None, None, None, None)], [_doc(1, "one")] * 3,
                                  [_doc(1, "one"), _doc(2, "two", None)]])
def test_manifest_of_few_rows(spark, rows):
    assert _counted(merkle.manifest(spark.createDataFrame(rows, DOCS)).collect()) == _manifest(rows)


def test_manifest_of_the_given_table(spark):
    rows = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    got = QUERIES["op13_merkle_manifest"](spark, SF_ORACLE).collect()
    assert _counted(got) == _manifest(rows)
    assert 0 < sum(not r.verified for r in got) < len(got) / 4


def test_many_equal_rows_are_dealt_out(spark):
    rows = [_doc(1, "copy")] * 3000 + [_doc(i, "other") for i in range(2, 50)]
    assert _counted(merkle.manifest(spark.createDataFrame(rows, DOCS).repartition(4)).collect()) == _manifest(rows)


@pytest.mark.parametrize("name", ["op12_conversation_trie", "op13_merkle_manifest"])
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(columns) == sorted(got.columns)
    assert _counted(got.select(*columns).collect()) == Counter(want.fetchall())
