"""Training-data operators against libraries, brute force and round trips on small inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm import attention, graph, imatch, lm, minhash, mixing, neighbours, packing, pieces, quality, secrets, tokens
from tidewatch.llm.oracle import ORACLES
from tidewatch.llm.queries import QUERIES

SF_ORACLE = "/root/testdata/sf0.01"
BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score string, kept int, key string, "
          "spans string, hash string, block int, n_tokens string, about string, component_id string, copies string")
ODD = [None, "", " ", "\n\t ", "a", "É é ▁ ▁▁x", "日本語 テキスト 😀😀", "<|endoftext|> x<|endoftext|>", "a\x1cb\x85c　d​e", "\x00\x01",
       "    " * 9, "don't I'll 'S x's 12²³ ---==", "ab" * 900]

def _words(seed: int, n: int, prefix: str = "w") -> list[str]:
    rng = random.Random(seed)
    return [f"{prefix}{rng.randrange(4000)}" for _ in range(n)]


def _texts() -> list[str | None]:
    base = _words(1, 300)
    near = [" ".join(base[:k] + [f"new{k}"] + base[k + 1:]) for k in (10, 150, 290)]
    long = " ".join(_words(3, 30_000))
    return [*ODD, " ".join(base), " ".join(base), *near, long, long + " end", *[" ".join(_words(s, 60)) for s in range(20, 40)]]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(_texts())]
    out.append(out[20])  # a repeated row
    out.append((None, "no id here at all", None, None, None))
    out.append((None, None, None, None, None))
    return [(*r, "x", 1, "k", "s", "h", 2, "n", "a", "c", "z") for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _labels(spark, marks):
    return spark.createDataFrame(marks, "doc_id long, quality int, toxic int, text string")


def _cuts(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def _groups(pairs, k, percent):
    """Brute force: id -> (set size, smallest reachable id)."""
    sets = {i: _cuts(t, k) for i, t in pairs}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a < b and n and 100 * n >= percent * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {i: new if g == old else g for i, g in group.items()}
    return {i: (len(sets[i]), group[i]) for i in sets}


def test_minhash_groups_equal_brute_force(docs, rows):
    want = _groups({(r[0], r[1]) for r in rows if r[0] is not None}, 3, 85)
    got = minhash.near_groups(docs, 3, 0.85).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["component_id"] == r["doc_id"])
    kept = [r["doc_id"] for r in minhash.keep_one(docs, 3, 0.85).collect()]
    assert sorted(x for x in kept if x is not None) == sorted({g for _, g in want.values()}) and kept.count(None) == 2


def test_minhash_chain_of_near_copies(spark):
    """Links are found between texts that the hub is not linked with."""
    base = _words(9, 120)
    chain = [" ".join([f"c{j}" for j in range(i)] + base[i:]) for i in range(0, 40, 4)]
    df = spark.createDataFrame(list(enumerate(chain)), "doc_id long, text string")
    want = _groups(list(enumerate(chain)), 3, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_groups(df, 3, 0.85).collect()} == want


def test_minhash_links_every_text_of_a_shared_id(spark):
    """Chains of near copies; every id has a second text that is like no other."""
    rows = []
    for c in range(25):
        base = _words(900 + c, 120)
        rows += [(100 * c + i, " ".join([f"c{c}x{j}" for j in range(6 * i)] + base[6 * i:])) for i in range(14)]
    rows += [(i, " ".join(_words(5_000 + i, 90, "z"))) for i, _ in rows]
    got = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 0.85).collect()
    assert len(got) == len(rows)
    assert all(r["component_id"] == r["doc_id"] // 100 * 100 for r in got)


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(50)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(45)]
    group = {x: x for p in links for x in p}
    for _ in range(100):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    loops = {a for a, b in links if a == b}
    assert {r["node"]: r["component"] for r in got} == {k: v for k, v in group.items() if k not in loops or v != k or k in {
        x for p in links if p[0] != p[1] for x in p}}


def test_half_keys_follow_the_threshold():
    assert minhash.half_keys(0.85) == 9 and minhash.half_keys(0.8) >= 10
    assert 2 * (1 - 0.8 ** 2) ** minhash.half_keys(0.8) <= minhash.MISS


def test_quality_separates_and_compiles(spark):
    rng = random.Random(2)
    marks, data = [], []
    for i in range(400):
        good = i % 3 > 0
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(20, 60))]
        text = " ".join(w if good else w + rng.choice(["###", "$$$", "!!"]) for w in words)
        data.append((i, text, str(i)))
        marks.append((i, int(good), 0, "x"))
    data += [(400, None, ""), (401, "", ""), (None, "some text", "")]
    marks += [(0, None, 0, ""), (5, 1, 0, ""), (None, 1, 0, "")]
    df = spark.createDataFrame(data, "doc_id long, text string, score string")
    train = _labels(spark, marks).filter("doc_id % 5 <> 0")
    model = quality.train(df, train)
    got = {r["doc_id"]: r["p"] for r in quality.score(df, model, out="p").collect()}
    held = [i for i in range(0, 400, 5)]
    assert np.mean([(got[i] >= 0.5) == (i % 3 > 0) for i in held]) >= 0.95
    x = np.array([quality.text_stats(t) for _, t, _ in data])
    assert np.allclose([got[d[0]] for d in data], quality.score_numpy(model, x), atol=1e-9)
    assert model["rules"] and got[400] == got[401]
    bare = quality.train(df, train.limit(0))
    assert {r["p"] for r in quality.score(df, bare, out="p").collect()} == {0.5}


def test_token_counts_equal_library(docs, rows):
    lib = Tokenizer.from_file(BYTE)
    want = Counter((r[0], len((r[1] or "").encode()), len(lib.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    got = tokens.count_tokens(docs, BYTE).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)


def test_pieces_equal_library(docs, rows):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = Counter()
    for r in rows:
        ids = lib.encode(r[1] or "")
        want[r[0], len(ids), ",".join(map(str, ids)), lib.decode(ids)] += 1
    got = pieces.encode_decode(docs, PIECE).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids"], r["decoded"]) for r in got) == want
    own = pieces.piece_bpe(PIECE)
    assert all(own.decode(own.encode(t)) == lib.decode(lib.encode(t)) for t in ODD if t)


def test_merges_of_random_texts_equal_libraries():
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab \n\t'ste▁é日😀01<>|  ") for _ in range(rng.randrange(1, 60))) for _ in range(1500)]
    lib = Tokenizer.from_file(BYTE)
    assert tokens.byte_bpe(BYTE).counts(texts) == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert [x.tolist() for x in pieces.piece_bpe(PIECE).id_arrays(texts)] == sp.encode(texts)


def test_lm_base_equals_brute_force(docs, rows):
    got = lm.score(docs, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2, BYTE).collect()
    cut = [((r[0]), (r[1] or "").encode().lower().split() + [b""]) for r in rows]
    train = Counter(w for i, c in cut for w in c if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2)
    n, v = sum(train.values()), len(train)
    want = Counter((i, len(c), sum(train[w] > 0 for w in c), n, round(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in c), 4))
                   for i, c in cut)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_attention_gradients_and_normalisation():
    rng = np.random.default_rng(0)
    w = {k: x.astype(np.float64) for k, x in attention.fresh(np.log(np.ones(6) / 6)).items()}
    w["far"] = rng.normal(size=w["far"].shape)
    read, goal = attention.windows([rng.integers(0, 6, n) for n in (37, 5, 16)], 6)
    assert (goal >= 0).sum() == 58
    _, g = attention.gradients(w, read, goal)
    for k in w:
        at = tuple(rng.integers(0, s) for s in w[k].shape)
        w[k][at] += 1e-5
        up = attention.gradients(w, read, goal)[0]
        w[k][at] -= 2e-5
        down = attention.gradients(w, read, goal)[0]
        w[k][at] += 1e-5
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-6
    # the classes' probabilities sum to 1, and a symbol never sees itself or later ones
    total = sum(np.exp(attention.log_probs(w, read[:1], np.full((1, attention.STRIDE), c))) for c in range(6))
    assert np.allclose(total, 1, atol=1e-6)
    later = read.copy()
    later[:, -1] = (later[:, -1] + 1) % 6
    assert np.allclose(attention.log_probs(w, read, goal)[:, :-1], attention.log_probs(w, later, goal)[:, :-1])


def test_attention_learns():
    rng = np.random.default_rng(1)
    seqs = [np.tile(rng.permutation(8), 12) for _ in range(60)]  # a period that only attention can use
    read, goal = attention.windows(seqs, 8)
    w = attention.fresh(np.log(np.ones(8) / 8))
    before = attention.log_probs(w, read, goal).sum()
    attention.train(w, [(read, goal)] * 30, size=64)
    assert attention.log_probs(w, read, goal).sum() > 0.7 * before


def test_attention_fit_takes_every_training_row_in_any_layout(spark):
    free = [r["id"] for r in spark.range(400).filter("pmod(xxhash64('fit', id), 16) <> 0").collect()]
    turns = [(i, "ab cd ef gh " * 20) for i in free[:60]]  # no id of one hash class, however few rows a task has
    for n in (1, 24):
        got = lm.score(spark.createDataFrame(turns, "doc_id long, text string").repartition(n), F.lit(True), BYTE).collect()
        assert sum(r["score"] for r in got) > -0.3 * sum(r["n_tokens"] for r in got)
    data = [(i, " ".join(_words(i, 40))) for i in range(150)]
    one, many = (sorted((str(r["doc_id"]), r["score"]) for r in lm.score(
        spark.createDataFrame(data, "doc_id long, text string").repartition(n), F.lit(True), BYTE).collect()) for n in (1, 24))
    assert [k for k, _ in one] == [k for k, _ in many]
    assert np.allclose([s for _, s in one], [s for _, s in many], rtol=1e-5)


def test_attention_rounds_grow_with_the_corpus():
    of = lambda n: lm._plan(np.array([n * attention.STRIDE, 0.0]))
    assert of(1) == (1, 1, lm.MOST_PASSES) and of(lm.TASK_WINDOWS)[:2] == (1, 1)
    for tasks in (10, 1_000, 100_000):
        rounds, each, passes = of(tasks * lm.TASK_WINDOWS)
        assert tasks <= rounds * each < tasks + rounds and rounds > math.log2(tasks) and passes == 1


def test_attention_tells_rare_symbols_apart_by_context():
    rng = np.random.default_rng(2)
    n = lm.SINGLE + lm.TAIL * 4
    by_id = np.r_[np.sort(rng.integers(5, 900, n))[::-1], 0, 0, 0, 40]
    classes = lm.Classes(by_id)
    assert classes.symbols == n + 2 and len(classes.inside.groups) == lm.TAIL
    assert len({*classes.place.tolist()}) == n + 2 and attention.CONTEXT > attention.STRIDE
    w = attention.fresh(classes.log_share, classes.symbols)
    w = {k: x.astype(np.float64) for k, x in w.items()}
    read, goal = attention.windows([rng.integers(0, classes.symbols, k) for k in (70, 200)], classes.symbols)
    _, g = attention.gradients(w, read, goal, classes.inside)
    for k in w:
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in w[k].shape)
            w[k][at] += 1e-5
            up = attention.gradients(w, read, goal, classes.inside)[0]
            w[k][at] -= 2e-5
            down = attention.gradients(w, read, goal, classes.inside)[0]
            w[k][at] += 1e-5
            assert abs((up - down) / 2e-5 - g[k][at]) < 1e-6
    every = [np.exp(attention.log_probs(w, read[:1], np.full((1, attention.STRIDE), c), classes.inside)) for c in range(classes.symbols)]
    assert np.allclose(sum(every), 1, atol=1e-6)
    # two symbols of one class, each after its own first symbol
    c, lo, hi = classes.inside.groups[0]
    seqs = [np.array([a, b] * 30) for a, b in ((0, lo), (1, lo + 1))] * 20
    read, goal = attention.windows(seqs, classes.symbols)
    w = attention.fresh(classes.log_share, classes.symbols)
    attention.train(w, [(read, goal)] * 60, size=64, inside=classes.inside)
    first = attention.log_probs(w, read[:1], np.tile([0, lo], attention.STRIDE // 2)[None], classes.inside)[0, 1::2]
    other = attention.log_probs(w, read[:1], np.tile([0, lo + 1], attention.STRIDE // 2)[None], classes.inside)[0, 1::2]
    assert (first > other + 2).all()


def test_attention_beats_the_word_base_on_held_out_rows(spark):
    got = QUERIES["op4_attention_scores"](spark, SF_ORACLE).groupBy("held_out").agg(
        F.sum("base_score").alias("base"), F.sum("score").alias("score")).collect()
    assert len(got) == 2 and all(r["score"] > r["base"] for r in got)


def test_packing_round_trip(docs, rows):
    packed = packing.pack(docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), PIECE, length=256).collect()
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = packing.unpacked(packed)
    for r in rows:
        if r[0] is not None:
            assert got.get(r[0], []) == lib.encode(r[1] or "")
    for r in packed:
        assert len(r["ids"]) == 512 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] <= 256
        assert r["position_resets"] == r["cu_seqlens"][:-1]


def test_best_fit_equals_plain_search():
    rng = random.Random(3)
    for _ in range(50):
        sizes = [rng.randrange(1, 65) for _ in range(rng.randrange(1, 80))]
        free, plain = [], []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fit = min((f for f in free if f >= sizes[i]), default=None)
            if fit is not None:
                free.remove(fit)
            free.append((fit or 64) - sizes[i])
            plain.append(i)
        rows = packing.best_fit_decreasing(sizes, 64)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        assert sorted(64 - sum(sizes[i] for i in r) for r in rows) == sorted(free)


def _skewed(spark):
    rng = random.Random(8)
    data = []
    for i in range(600):
        source = "big" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        data.append((i, " ".join(_words(i, rng.randrange(0, 60))) if i % 50 else None, "en", source))
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string"), data


def test_mixture_equals_duckdb(spark):
    df, data = _skewed(spark)
    got = mixing.mix(df).toPandas()
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", data)
    want = con.sql(ORACLES["op6_source_mixture"]).df()
    cols = sorted(want.columns)
    both = [x[cols].astype(object).where(x[cols].notna(), None).astype(str).sort_values(cols).to_numpy().tolist() for x in (got, want)]
    assert both[0] == both[1] and len(got) > 100


def test_mixture_meets_entropy_and_repeats(spark):
    df, _ = _skewed(spark)
    shares = mixing.source_shares(mixing._sized(df, "doc_id", "source", "text").select(
        F.col("_source").alias("source"), F.col("_n").alias("n_tokens")))
    p = np.array([r["p"] for r in shares.collect()])

    def entropy(a):
        w = p ** a / (p ** a).sum()
        return -(w * np.log(w)).sum()

    a = mixing.exponent(shares, 0.95, None, 1.0)
    assert entropy(a) >= 0.95 * np.log(len(p)) > entropy(a + 1.01 / mixing.GRID) or a == 1
    b = mixing.exponent(shares, 1.0, 1.2, 1.0)
    w = p ** b / (p ** b).sum()
    assert (w / p).max() <= 1.2
    every = mixing.mixed_rows(df, budget=None).groupBy("doc_id").count().collect()
    assert len(every) >= 580


def test_neighbours_recall_ties_and_invalid(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[700:760] = x[300]  # ties
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    data += [(2000, None), (2100, [0.0] * 16), (2200, [float("nan")] * 16), (2300, [None] * 16), (2400, [1.0] * 3), (None, [1.0] * 16)]
    data.append(data[5])
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("query", F.lit(1))
    got = neighbours.nearest(df, F.col("vec_id") % 100 == 0).collect()
    y, hits = x.astype(np.float64), 0
    by: dict = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(by) == list(range(0, 1500, 100))
    for q, found in by.items():
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(len(d)), d))[:10]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert np.allclose([s for _, _, s in found], d[[i for _, i, _ in found]], rtol=1e-12)
        hits += len(set(want) & {i for _, i, _ in found})
    assert hits / 150 >= 0.9
    assert [i for _, i, _ in by[300]] == list(range(700, 710))
    few = neighbours.nearest(df.filter("vec_id < 3"), F.col("vec_id") % 100 == 0).collect()
    assert [r["vec_id"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2] or len(few) == 2
    assert neighbours.nearest(df.limit(0), F.lit(True)).collect() == []


def test_imatch_equals_brute_force(spark):
    data = [(i, t) for i, t in enumerate(_texts()) if t is None or len(t) < 3000] + [(None, "no id"), (3, "again 3")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("block", F.lit("x")).withColumn("code", F.lit(0))
    got = imatch.fingerprints(df, low=1 / 50, high=1 / 2).collect()
    order = sorted(((i, t or "") for i, t in data), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    cut = lambda t: {w for w in re.split(r"[\x20\x09-\x0D]+", t.lower()) if w}
    h = lambda b: xxhash.xxh64_intdigest(b, 42)
    df_ = Counter(w for _, t in order for w in cut(t))
    n = len(order)
    band = {w for w, c in df_.items() if n / 50 <= c <= max(n / 2, 1)}

    def finger(t):
        terms = [h(w.encode()) for w in cut(t) & band]
        return frozenset(terms) if terms else t

    want, seen = {}, Counter()
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % n][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        want.setdefault((i, len(t), hashlib.sha256(edited.encode()).hexdigest()), []).append((finger(t), finger(edited), finger(nxt)))
    prints: dict = {}
    for r in got:
        own, edited, nxt = want[r["doc_id"], r["n_chars"], r["edited_sha256"]][0]
        seen[r["doc_id"], r["n_chars"], r["edited_sha256"]] += 1
        assert prints.setdefault(own, r["fingerprint"]) == r["fingerprint"]
        assert prints.setdefault(edited, r["edited_fingerprint"]) == r["edited_fingerprint"]
        assert (r["near_edited"] == 1.0) >= (own == edited) and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if own == nxt:
            assert r["near_next"] == 1.0
    assert seen == Counter({k: len(v) for k, v in want.items()})


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
                    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
CRED = "ghp_" + "Ab1" * 12


def _secret_rows():
    hexes = "0123456789abcdef" * 2
    texts = [None, "", f"é😀 token = \"{hexes}\" and PassWord:'short' x", "AKIA" + "Z9" * 8 + " AKIAAKIA12", f"{hexes}{hexes} abc",
             f"secret=token: {hexes}", f"mine {CRED}x", f"shared {CRED}", "api_key=abcdefghijkl;api-key=abcdefghijklm", "token=secret: abcdefghijklmnop",
             ("token=abcdefghijklm " * 500), f"shared {CRED}"]
    return [(i, t, "en", f"src{i}", 0, "s") for i, t in enumerate(texts)] + [(None, f"token={hexes}", None, None, None, None), (7, f"shared {CRED}", "en", "src99", 0, "s")]


def test_secrets_equal_brute_force(spark):
    data = _secret_rows()
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, spans string")
    got = secrets.find_secrets(df).collect()
    want = Counter()
    names = ("assign", "access", "hex")
    for i, t, *_ in data:
        t = t or ""
        s = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
        s += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        s += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        text = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(s))
        want[i, *(sum(x[1] == k for x in s) for k in range(3)), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == want
    added = {r["doc_id"] for r in got if "cred" in r["spans"]}
    assert added == {6}  # one owner; the other string has three
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint, spans varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?, ?)", data)
    cols = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    sql = con.sql("select " + ", ".join(cols) + " from (" + ORACLES["op9_secret_scan"] + ")").fetchall()
    assert Counter(sql) == Counter(tuple(r[c] for c in cols) for r in got)


def test_redaction(spark):
    data = _secret_rows()
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, spans string")
    out = secrets.redact(df)
    assert out.columns == df.columns
    got = [(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()]
    assert len(got) == len(data)
    by = dict((i, (t, n)) for i, t, n in got if i not in (7, None))
    assert by[0] == (None, 0) and by[1] == ("", 0)
    assert by[2][0] == "é😀 token = \"<SECRET>\" and PassWord:'short' x" and by[2][1] == len(by[2][0])
    assert by[6][0] == "mine <SECRET>" and by[11][0] == f"shared {CRED}"
    assert by[10][0] == "token=<SECRET> " * 500


def test_empty_tables(spark, none):
    assert minhash.near_groups(none).collect() == [] and minhash.keep_one(none).collect() == []
    assert tokens.count_tokens(none, BYTE).collect() == [] and pieces.encode_decode(none, PIECE).collect() == []
    assert lm.score(none, F.lit(True), BYTE).collect() == [] and packing.pack(none, PIECE).collect() == []
    assert mixing.mix(none).collect() == [] and mixing.mixed_rows(none, budget=None).collect() == []
    assert imatch.fingerprints(none).collect() == []
    assert secrets.find_secrets(none).collect() == [] and secrets.redact(none).collect() == []
    assert quality.score(none.drop("score"), quality.train(none, _labels(spark, []))).collect() == []


def test_odd_rows_keep_every_row(docs, rows):
    assert len(imatch.fingerprints(docs).collect()) == len(rows)
    assert len(secrets.find_secrets(docs).collect()) == len(rows)
    assert secrets.redact(docs).columns == docs.columns
    mixed = mixing.mixed_rows(docs, budget=None)
    assert mixed.columns == docs.columns and mixed.count() >= len(rows) - 4
