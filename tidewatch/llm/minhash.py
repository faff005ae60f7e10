"""Near-duplicate documents by MinHash with tensored banding.

Table keys are made from two small collections of half keys: every document has
``m`` half keys u and ``m`` half keys v, each of two minhashes, and all m * m pairs
(u_i, v_j) are its keys.  Only 4 * m minhashes are computed for m * m tables of four.
``m`` is chosen so that a pair at the threshold is missed with a chance under MISS.

Candidates never are all pairs of a bucket:

1. Texts with equal shingle sets are one class from the start.
2. Half keys that only one class has are dropped before keys are made (a key is
   shared only if both halves are).
3. In each bucket every class meets the bucket's hub, its most connected class; the
   pairs are verified on the full shingle sets and links make components.
4. Classes of different components that still share a bucket meet in blocks of about
   2 * BLOCK of them, dealt by the bucket's hub, where samples of their sets (the SAMPLE smallest
   shingle hashes; whole sets, if they are no larger) are intersected by matrix products.
   Only pairs within reach of the threshold leave a block (a pair at the threshold fails
   this with a chance under 1e-6), and of a block with many of them only the edges of a
   spanning forest.  Links are verified and components contracted; if a block held edges
   back, the classes that are still apart meet once more and none is held back.

No bucket is capped.  Verification reads whole texts.  What stays quadratic is the work
(not the rows) of step 4 within a group of classes that share keys and are no links: it
is spread over blocks.

Defined results: ids that are null link with nothing and are kept; texts without
words (also null ones) have an empty set and link with nothing; rows that share an
id are one document, linked if any of their texts is (``keep_one`` takes each of their
texts on its own); repeated rows each get a row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, id_text, ship_code, written
from .graph import components

#: Chance of missing a pair that lies exactly at the threshold.
MISS = 3e-5
#: Minhashes in a half key.
HALF = 2
SEED = 20_011
#: Smallest shingle hashes of a set that tell remaining pairs apart.
SAMPLE = 512
#: Classes around a hub that meet at once, twice over.
BLOCK = 512
#: Pairs a class may bring out of a block; a block with more gives a spanning forest.
PAIRS_PER_CLASS = 1
_WORDS_REMEMBERED = 500_000


def half_keys(similarity: float, miss: float = MISS) -> int:
    """Half keys per collection: at least one u and one v must agree."""
    return max(2, math.ceil(math.log(miss / 2) / math.log(1 - similarity ** HALF)))


def least_agreeing(similarity: float, n: int, miss: float = 1e-6) -> int:
    """Fewer agreeing minhashes of ``n`` than this have a chance under ``miss`` at the threshold."""
    total, k = 0.0, 0
    while k <= n:
        total += math.comb(n, k) * similarity ** k * (1 - similarity) ** (n - k)
        if total > miss:
            return k
        k += 1
    return n


_hashes: dict[bytes, int] = {}


def _mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles; all words as one when fewer."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and the six blanks alone
    if not words:
        return np.zeros(0, np.uint64)
    if len(_hashes) > _WORDS_REMEMBERED:
        _hashes.clear()
    for w in words:
        if w not in _hashes:
            _hashes[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    out = np.full(n, min(len(h), k), np.uint64)
    for i in range(min(len(h), k)):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(out)


@lru_cache(maxsize=8)
def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return (rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def minhashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """``n`` minhashes (32 bits each) of a non-empty set."""
    a, b = _factors(n)
    best = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, (1 << 18) // n)
    for at in range(0, len(hashes), step):  # long texts in blocks
        x = hashes[at:at + step, None] * a + b
        x ^= x >> np.uint64(29)
        best = np.minimum(best, (x * np.uint64(0xBF58476D1CE4E5B9)).min(axis=0))
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signature(hashes: np.ndarray) -> bytes | None:
    """Digest of a set; none for the empty set."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


_SKETCH = "doc_id long, mark binary, n_shingles long, signature binary, minhash array<int>"


def sketches(docs: DataFrame, k: int, n: int) -> DataFrame:
    """(doc_id, mark of the text, n_shingles, signature of the set, minhashes) of every row."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, signs, hashes = [], [], []
            for text in batch.column("text"):
                s = shingles(text.as_py(), k)
                sizes.append(len(s))
                signs.append(_signature(s))
                hashes.append(minhashes(s, n) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array(signs, pa.binary()),
                 pa.array(hashes, pa.list_(pa.int32()))], names=["doc_id", "mark", "n_shingles", "signature", "minhash"])

    return docs.select("doc_id", "text", _mark(F.col("text")).alias("mark")).mapInArrow(run, _SKETCH)


def _mark(text: Column) -> Column:
    """Digest of a text as it is; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose full shingle sets have 100 * intersection >= percent * union."""
    known = classes.select("cid", "id", "signature")
    for side in "ab":
        pairs = pairs.join(known.select(F.col("cid").alias(side), F.col("id").alias(f"id_{side}"),
                                        F.col("signature").alias(f"sign_{side}")), side)
    # rows that share an id: the text whose set the class has is the one compared
    for side in "ab":
        pairs = pairs.join(docs.select(F.col("doc_id").alias(f"id_{side}"), F.col("text").alias(f"text_{side}")), f"id_{side}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # pairs come grouped by b: its set is made once
        text_b, set_b, own_b = None, np.zeros(0, np.uint64), None
        for batch in batches:
            keep = []
            for x, y, sign_a, sign_b in zip(*[batch.column(c) for c in ("text_a", "text_b", "sign_a", "sign_b")], strict=True):
                x, y = x.as_py(), y.as_py()
                if y != text_b:
                    text_b, set_b = y, shingles(y, k)
                    own_b = _signature(set_b)
                set_a = shingles(x, k)
                if own_b != sign_b.as_py() or _signature(set_a) != sign_a.as_py():
                    keep.append(False)
                    continue
                common = len(np.intersect1d(set_a, set_b, assume_unique=True))
                union = len(set_a) + len(set_b) - common
                keep.append(union > 0 and 100 * common >= percent * union)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "sign_a", "sign_b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def _agreeing(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, v: s + v)


def _sizes_fit(x: str, y: str, percent: int) -> Column:
    n, m = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _possible(x: str, y: str, percent: int, least: int) -> Column:
    """Sizes allow the threshold and enough minhashes agree."""
    return _sizes_fit(x, y, percent) & (_agreeing(F.col(f"{x}.minhash"), F.col(f"{y}.minhash")) >= least)


def _halves(first: int, end: int) -> Column:
    """Half keys number ``first`` to ``end`` - 1."""
    return F.expr(f"transform(sequence({first}, {end - 1}), i -> xxhash64(i, slice(minhash, i * {HALF} + 1, {HALF})))")


# ---- classes that share a bucket and no link yet ---------------------------------------

def samples(docs: DataFrame, k: int) -> DataFrame:
    """(id, signature, sample): the SAMPLE smallest shingle hashes of every row's set, by their upper halves."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs, least = [], []
            for text in batch.column("text"):
                s = shingles(text.as_py(), k)
                signs.append(_signature(s))
                least.append((s[:SAMPLE] >> np.uint64(32)).astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signs, pa.binary()), pa.array(least, pa.binary())],
                names=["id", "signature", "sample"])

    return docs.select("doc_id", "text").mapInArrow(run, "id long, signature binary, sample binary")


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, as products of slices of their incidence matrix."""
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    values = values[counts > 1]  # what one set has alone is in no intersection
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, len(values), 4096):
        part = values[at:at + 4096]
        has = np.zeros((len(sets), len(part)), np.float32)
        for i, own in enumerate(sets):
            own = own[(own >= part[0]) & (own <= part[-1])]
            to = np.searchsorted(part, own)
            has[i, to[part[to] == own]] = 1
        out += has @ has.T
    return out


@lru_cache(maxsize=4096)
def _least_share(similarity: float, n: int) -> float:
    """Share of a sample of ``n`` of a union that a pair at the threshold has in common but for a chance under 1e-6."""
    return least_agreeing(similarity, n) / n if n else 0.0


def _block_pairs(rows: dict[str, list], similarity: float, percent: int, thin: bool) -> tuple[list[tuple[int, int]], bool]:
    """Pairs of different parts that share a key and are within reach of the threshold; whether some were held back."""
    n = len(rows["cid"])
    part, size, side = (np.array(rows[c]) for c in ("part", "n_shingles", "side"))
    us, vs = np.array(rows["us"]), np.array(rows["vs"])
    may = np.triu(part[:, None] != part[None, :], 1)
    may &= np.minimum(size[:, None], size) * 100 >= np.maximum(size[:, None], size) * percent
    if side.min() != side.max():  # two slots of a large set: pairs across them only
        may &= side[:, None] != side
    for halves in (us, vs):
        shared = np.zeros_like(may)
        for h in halves.T:
            shared |= h[:, None] == h
        may &= shared
    x, y = np.nonzero(may)
    if not len(x):
        return [], False
    used = np.unique(np.concatenate([x, y]))
    sets = [np.frombuffer(rows["sample"][i], np.uint32) for i in used]
    inter = _common(sets)[np.searchsorted(used, x), np.searchsorted(used, y)]
    # both samples are whole up to the smaller of their ends
    whole = size[used] == [len(t) for t in sets]
    ends = np.where(whole, np.iinfo(np.uint32).max, [t[-1] for t in sets])
    keep = np.zeros(len(x), bool)
    for i, (p, q) in enumerate(zip(np.searchsorted(used, x), np.searchsorted(used, y), strict=True)):
        if whole[p] and whole[q]:
            keep[i] = 100 * inter[i] >= percent * (size[used[p]] + size[used[q]] - inter[i])
        else:
            end = min(ends[p], ends[q])
            union = np.searchsorted(sets[p], end, "right") + np.searchsorted(sets[q], end, "right") - inter[i]
            keep[i] = inter[i] >= _least_share(similarity, int(union)) * union
    x, y = x[keep], y[keep]
    many = thin and len(x) > PAIRS_PER_CLASS * n
    if many:  # the edges of a spanning forest
        root = list(range(n))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        edges = []
        for i, j in zip(x.tolist(), y.tolist(), strict=True):
            p, q = top(i), top(j)
            if p != q:
                root[p] = q
                edges.append((i, j))
        held = len(edges) < len(x)
        return [(rows["cid"][i], rows["cid"][j]) for i, j in edges], held
    return [(rows["cid"][i], rows["cid"][j]) for i, j in zip(x.tolist(), y.tolist(), strict=True)], False


_ROW = ("cid", "part", "n_shingles", "side", "us", "vs", "sample")


def _meetings(entries: DataFrame, similarity: float, percent: int, thin: bool) -> DataFrame:
    """(a, b, held) of pairs of classes; rows without a pair say that a block held edges back.

    ``entries`` has a hub, and of each class of its buckets cid, part, n_shingles, us, vs, sample.
    """
    counts = entries.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("slots"))
    dealt = entries.join(counts, "hub").withColumn("slot", F.pmod(F.xxhash64("cid"), "slots").cast("int"))
    # a slot meets itself and every other slot of its hub
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, slots - 1)"))).select(
        "hub", F.least("slot", "other").alias("lo"), F.greatest("slot", "other").alias("hi"), F.col("slot").alias("side"),
        *[c for c in _ROW if c != "side"])
    dealt = dealt.repartition("hub", "lo", "hi").sortWithinPartitions("hub", "lo", "hi", "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, {c: [] for c in _ROW}

        def done(out: list) -> None:
            if len(rows["cid"]) > 1:
                pairs, held = _block_pairs(rows, similarity, percent, thin)
                out += [(a, b, False) for a, b in pairs] + [(None, None, True)] * held

        for batch in batches:
            out: list = []
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("hub", "lo", "hi")], strict=True))
            cells = {c: batch.column(c).to_pylist() for c in _ROW}
            for i, key in enumerate(keys):
                if key != at:
                    done(out)
                    at, rows = key, {c: [] for c in _ROW}
                for c in _ROW:
                    rows[c].append(cells[c][i])
            yield _pair_rows(out)
        out = []
        done(out)
        yield _pair_rows(out)

    return dealt.mapInArrow(run, "a long, b long, held boolean")


def _pair_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["a", "b", "held"])


def _parts(entries: DataFrame, group: DataFrame) -> DataFrame:
    """``entries`` of classes with ``part``: their component so far."""
    return entries.join(group.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn(
        "part", F.coalesce("component", "cid")).drop("component")


def _class_groups(sketch: DataFrame, texts: DataFrame, k: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Classes (cid, id, signature, ...) of rows with an id and words, and the links (a, b) between them."""
    percent = round(similarity * 100)
    m = half_keys(similarity)
    least = least_agreeing(similarity, 2 * m * HALF)
    named = sketch.filter("doc_id is not null and signature is not null")
    # equal sets: one class, known by its signature (cid) and named by its smallest id; its row stands for all
    classes = named.groupBy("signature").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("minhash").alias("minhash"))
    classes = written(classes.withColumn("cid", F.xxhash64("signature")), "minhash-classes")

    # half keys that several classes have; a key needs two such halves
    half = classes.select("cid", F.posexplode(_halves(0, 2 * m)).alias("i", "h"))
    seen = half.groupBy("i", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = half.join(seen, ["i", "h"]).groupBy("cid").agg(
        F.collect_list(F.when(F.col("i") < m, F.col("h"))).alias("u"),
        F.collect_list(F.when(F.col("i") >= m, F.col("h"))).alias("v"), F.sum("n").alias("reach"))
    keys = own.filter("size(u) > 0 and size(v) > 0").select("cid", "reach", "v", F.explode("u").alias("x"))
    keys = keys.select("cid", "reach", "x", F.explode("v").alias("y")).select("cid", "reach", F.xxhash64("x", "y").alias("key"))

    # the hub of a bucket: the class that shares most half keys with others; buckets with one hub are one set of classes
    bucket = Window.partitionBy("key")  # 24 bytes a class, no order within: a large bucket spills
    hubs = keys.select("cid", F.max(F.struct("reach", "cid")).over(bucket)["cid"].alias("hub"), F.count(F.lit(1)).over(bucket).alias("n"))
    hubs = written(hubs.filter("n > 1").select("hub", "cid").distinct(), "minhash-hubs")
    pairs = hubs.filter("cid <> hub").select(F.col("cid").alias("a"), F.col("hub").alias("b"))
    x, y = classes.select("cid", "n_shingles", "minhash").alias("x"), classes.select("cid", "n_shingles", "minhash").alias("y")
    pairs = pairs.join(x, F.col("a") == F.col("x.cid")).join(y, F.col("b") == F.col("y.cid")).filter(
        _possible("x", "y", percent, least)).select("a", "b")
    links = written(_verified(pairs, classes, texts, k, percent), "minhash-links")

    # classes of different components that still share a bucket
    facts = None
    for thin in (True, False):
        group = written(components(links, "minhash-star"), "minhash-stars")
        left = _parts(hubs, group)
        mixed = left.groupBy("hub").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p < q").select("hub")
        left = written(left.join(mixed, "hub"), "minhash-mixed")
        if facts is None:  # the classes of the second round are among the first round's
            some = classes.join(left.select("cid").distinct(), "cid", "left_semi")
            wide = samples(texts.join(some.select(F.col("id").alias("doc_id")).distinct(), "doc_id"), k)
            # rows that share an id: the class's own text is the one whose set it has
            facts = some.join(wide, ["id", "signature"]).select(
                "cid", "n_shingles", "sample", *[_halves(at, at + m).alias(c) for c, at in (("us", 0), ("vs", m))])
            facts = written(facts.dropDuplicates(["cid"]), "minhash-samples")
        met = written(_meetings(left.join(facts, "cid"), similarity, percent, thin), "minhash-met")
        more = met.filter("not held").select("a", "b").distinct()
        links = written(links.unionByName(_verified(more, classes, texts, k, percent)), "minhash-all-links")
        if met.filter("held").isEmpty():
            break
    return classes, links


def near_groups(docs: DataFrame, k: int = 5, similarity: float = 0.8,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by links), kept."""
    rows = id_text(docs, id_col, text_col)
    sketch = written(sketches(rows, k, 2 * half_keys(similarity) * HALF), "minhash-sketches")
    classes, links = _class_groups(sketch, rows.filter("doc_id is not null"), k, similarity)

    # rows that share an id tie their classes together
    owned = sketch.filter("doc_id is not null and signature is not null").select(
        "doc_id", F.xxhash64("signature").alias("cid")).distinct()
    several = owned.groupBy("doc_id").agg(F.min("cid").alias("b"), F.max("cid").alias("c")).filter("b < c").select("doc_id", "b")
    shared = owned.join(several, "doc_id").filter("cid <> b").select(F.col("cid").alias("a"), "b").distinct()
    named = _parts(classes.select("cid", "id"), written(components(links.unionByName(shared), "minhash-all"), "minhash-groups"))
    least = named.groupBy("part").agg(F.min("id").alias("component"))
    named = named.join(least, "part").select("cid", "component")

    out = sketch.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.xxhash64("signature")).alias("cid"),
                        F.col("signature").isNull().alias("bare"))
    out = out.withColumn("cid", F.when(~F.col("bare"), F.col("cid"))).join(named, "cid", "left")
    whole = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", whole.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, k: int = 5, similarity: float = 0.8,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: the smallest id's (of its texts, the one of the smallest digest).

    Texts that share an id are judged each on its own.  Rows that repeat id and text are
    one; rows without an id are kept, and so is every text without words.
    """
    rows = id_text(docs, id_col, text_col)
    sketch = written(sketches(rows, k, 2 * half_keys(similarity) * HALF), "minhash-sketches")
    classes, links = _class_groups(sketch, rows.filter("doc_id is not null"), k, similarity)
    group = written(components(links, "minhash-all"), "minhash-groups")
    parts = _parts(classes.select("cid"), group)
    named = sketch.filter("doc_id is not null and signature is not null").select(
        "doc_id", "mark", F.xxhash64("signature").alias("cid")).join(parts, "cid").select("part", "doc_id", "mark")
    named = written(named, "minhash-named")
    first = named.groupBy("part").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    gone = named.join(first, "part").filter("doc_id <> first.doc_id or mark <> first.mark").select("doc_id", "mark").distinct()

    own_id, own_mark = fresh(docs, "id"), fresh(docs, "mark")
    marked = docs.withColumns({own_id: F.col(f"`{id_col}`").cast("long"), own_mark: _mark(F.col(f"`{text_col}`"))})
    marked = marked.join(gone.select(F.col("doc_id").alias(own_id), F.col("mark").alias(own_mark)), [own_id, own_mark], "left_anti")
    total, distinct = sketch.filter("doc_id is not null").agg(F.count(F.lit(1)), F.count_distinct("doc_id", "mark")).first()
    if total > distinct:
        marked = marked.filter(F.col(own_id).isNull()).unionByName(
            marked.filter(F.col(own_id).isNotNull()).dropDuplicates([own_id, own_mark]))
    return marked.select(*[F.col(f"`{c}`") for c in docs.columns])
