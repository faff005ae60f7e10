"""Merkle manifest of a data set: leaf digests, subtree roots, proofs and their check.

Leaf coordinates come from bitmaps, not from sorting rows.  The ids of a group (``lang``)
are merged into words of 64 bits, of which only the occupied ones are kept; popcounts of
the words make a directory (``offsets``): each level sums at most 2^FAN_BITS entries of
the one below, as many levels as the range of ids needs.  An id's coordinate is the
directory's count before its word plus the bits before it in the word.

Levels are reduced by slot arrays: the nodes of 2^FAN_BITS consecutive coordinates meet
in one row, which computes FAN_BITS levels at once and keeps them for the proofs.  Proofs
are handed down from the top rows.  No task holds more than one such row of a group.

Defined results: rows without an id come first in their group; rows that share an id are
ordered by their leaf digests, equal rows follow each other; a group may be null, which
is its own group and comes first; null fields are marked; an empty table has no rows.
An id that is null is never tampered with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Bits of a coordinate that one row of slots, or one entry of a directory, spans.
FAN_BITS = 10
WORD_BITS = 6
#: Hex digits of a leaf that part rows that share an id.
TIE_DIGITS = 4
#: Columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 7


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _field(value: Column) -> Column:
    """A field as its byte count and text; null is marked."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, g, leaf, bent): g names the group, bent is the leaf with n_chars raised by one where tampered."""
    doc_id = F.col("doc_id").cast("long")
    fields = {c: F.col(c) for c in FIELDS} | {"doc_id": doc_id, "n_chars": F.col("n_chars").cast("long")}
    more = fields | {"n_chars": fields["n_chars"].cast("decimal(20,0)") + 1}
    hit = F.crc32(doc_id.cast("string").cast("binary")) % TAMPERED == 0
    return docs.select(
        doc_id.alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("g"),
        _digest(F.concat(*[_field(fields[c]) for c in FIELDS])).alias("leaf"),
        F.when(hit & F.col("n_chars").isNotNull(), _digest(F.concat(*[_field(more[c]) for c in FIELDS]))).alias("bent"))


# ---- coordinates -------------------------------------------------------------------

def offsets(entries: DataFrame, by: Sequence[str], key: str, span: tuple[int, int]) -> DataFrame:
    """``entries`` (by, key unique within by, n, ...) with ``base``: the sum of n over smaller keys.

    ``span`` is the smallest and the largest key.  Windows hold at most 2^FAN_BITS entries.
    """
    if span[1] - span[0] < 1 << FAN_BITS:
        return entries.withColumn("base", _before(Window.partitionBy(*by).orderBy(key)))
    up = F.shiftright(key, FAN_BITS)
    entries = entries.withColumn(f"{key}_up", up)
    within = Window.partitionBy(*by, f"{key}_up").orderBy(key)
    above = entries.groupBy(*by, f"{key}_up").agg(F.sum("n").alias("n"))
    above = offsets(above, by, f"{key}_up", (span[0] >> FAN_BITS, span[1] >> FAN_BITS)).select(*by, f"{key}_up", F.col("base").alias("base_up"))
    return entries.withColumn("base", _before(within)).join(above, [*by, f"{key}_up"]).withColumn(
        "base", F.col("base") + F.col("base_up")).drop("base_up", f"{key}_up")


def _before(window: Window) -> Column:
    return F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")


def bitmap(ids: DataFrame) -> DataFrame:
    """(g, word, mask, n, extra): the ids' words; extra lists what ids with several rows count beyond one."""
    place = F.col("doc_id").bitwiseAND((1 << WORD_BITS) - 1).cast("int")
    return ids.groupBy("g", F.shiftright("doc_id", WORD_BITS).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(doc_id & {(1 << WORD_BITS) - 1} as int))")).alias("mask"),
        F.sum("c").alias("n"),
        F.collect_list(F.when(F.col("c") > 1, F.struct(place.alias("place"), (F.col("c") - 1).alias("more")))).alias("extra"))


def _ties(rows: DataFrame) -> DataFrame:
    """Classes (g, doc_id, leaf, bent, m, shift) of rows that share an id: m equal rows, shift rows before them."""
    by = ["g", "doc_id"]
    classes = rows.groupBy(*by, "leaf", "bent").agg(F.count(F.lit(1)).alias("n"))
    classes = classes.withColumn("part", F.substring("leaf", 1, TIE_DIGITS))
    parts = classes.groupBy(*by, "part").agg(F.sum("n").alias("n"))
    parts = parts.select(*by, "part", _before(Window.partitionBy(*by).orderBy("part")).alias("first"))
    inner = classes.withColumn("shift", _before(Window.partitionBy(*by, "part").orderBy("leaf"))).alias("x")
    same = F.col("x.g").eqNullSafe(F.col("y.g")) & F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.part") == F.col("y.part"))
    return inner.join(parts.alias("y"), same).select(
        "x.g", "x.doc_id", "x.leaf", "x.bent", F.col("x.n").alias("m"), (F.col("x.shift") + F.col("y.first")).alias("shift"))


def placed(rows: DataFrame) -> DataFrame:
    """``leaves`` with idx, their coordinate in the group, and depth, the levels above the group's leaves."""
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
    groups = written(groups, "merkle-groups")
    ids = written(rows.filter("doc_id is not null").groupBy("g", "doc_id").agg(F.count(F.lit(1)).alias("c")), "merkle-ids")
    low, high, most = ids.agg(F.min("doc_id"), F.max("doc_id"), F.max("c")).first()
    span = ((low or 0) >> WORD_BITS, (high or 0) >> WORD_BITS)
    words = offsets(bitmap(ids), ["g"], "word", span)

    single = rows.filter("doc_id is not null").withColumns({"m": F.lit(1).cast("long"), "shift": F.lit(0).cast("long")})
    if (most or 0) > 1:
        shared = ids.filter("c > 1").select("g", "doc_id")
        tied = _ties(rows.join(shared, ["g", "doc_id"], "left_semi"))
        single = single.join(shared, ["g", "doc_id"], "left_anti").unionByName(tied)
    single = single.withColumn("word", F.shiftright("doc_id", WORD_BITS)).join(words, ["g", "word"])
    place = f"cast(doc_id & {(1 << WORD_BITS) - 1} as int)"
    rank = F.expr(f"base + bit_count(mask & ~shiftleft(-1L, {place})) + shift + "
                  f"aggregate(extra, 0L, (s, e) -> s + if(e.place < {place}, e.more, 0L))")
    out = single.select("g", "doc_id", "leaf", "bent", "m", rank.alias("at"), F.lit(1).alias("named"))
    nameless = rows.filter("doc_id is null")
    if not groups.filter("nulls > 0").isEmpty():
        out = out.unionByName(_ties(nameless).select(
            "g", "doc_id", "leaf", "bent", "m", F.col("shift").alias("at"), F.lit(0).alias("named")))
    out = out.join(groups, "g").select(
        "g", "doc_id", "leaf", "bent", "m", (F.col("at") + F.col("named") * F.col("nulls")).alias("at"), _depth("rows").alias("depth"))
    return _copies(out, (most or 0) > 1 or not groups.filter("nulls > 1").isEmpty())


def _depth(n: str) -> Column:
    """Levels above ``n`` nodes: ceil(log2 n)."""
    return F.expr(f"if({n} > 1, length(bin({n} - 1)), 0)")


def _copies(rows: DataFrame, several: bool) -> DataFrame:
    """m rows at consecutive coordinates for each; many copies are dealt out in blocks."""
    if not several:
        return rows.withColumnRenamed("at", "idx").drop("m")
    size = 1 << FAN_BITS
    more = rows.filter("m > 1").select("*", F.explode(F.expr(f"sequence(0L, shiftright(m - 1, {FAN_BITS}))")).alias("b"))
    more = more.repartition("g", "leaf", "b").select(
        "g", "doc_id", "leaf", "bent", "depth", "at", F.explode(F.expr(f"sequence(b * {size}, least(m, (b + 1) * {size}) - 1)")).alias("k"))
    more = more.withColumn("idx", F.col("at") + F.col("k")).drop("at", "k")
    return rows.filter("m = 1").withColumnRenamed("at", "idx").drop("m").unionByName(more)


# ---- levels and proofs -------------------------------------------------------------

def _blocks(nodes: DataFrame, stage: int, carried: Sequence[str]) -> DataFrame:
    """(g, block, depth, slots, levels): nodes (g, idx, leaf, depth, ...) in rows of slots, with all their levels."""
    slots = nodes.groupBy("g", F.shiftright("idx", FAN_BITS).alias("block"), "depth").agg(F.array_sort(F.collect_list(
        F.struct(F.col("idx").bitwiseAND((1 << FAN_BITS) - 1).alias("slot"), "leaf", *carried))).alias("slots"))
    steps = f"least({FAN_BITS}, depth - {FAN_BITS * stage})"
    last = "element_at(done, -1)"
    return slots.withColumn("steps", F.expr(steps)).withColumn("levels", F.expr(f"""
        aggregate(if(steps > 0, sequence(1, steps), cast(array() as array<int>)), array(slots.leaf), (done, k) ->
          concat(done, array(transform(sequence(0, (size({last}) - 1) div 2), j ->
            sha2(concat({last}[2 * j], coalesce(get({last}, 2 * j + 1), '')), 256)))))"""))


#: A node's siblings within its row of slots, lowest level first: l before it, r after it, empty where there is none.
_SIBLINGS = """transform(if(steps > 0, sequence(0, steps - 1), cast(array() as array<int>)), k ->
    if(shiftright(s.slot, k) % 2 = 1,
       struct(levels[k][cast(shiftright(s.slot, k) as int) - 1] as l, '' as r),
       struct('' as l, coalesce(get(levels[k], cast(shiftright(s.slot, k) as int) + 1), '') as r)))"""


def _reduced(nodes: DataFrame, depth: int, label: str, carried: Sequence[str]) -> list[DataFrame]:
    """Written rows of slots, stage by stage, until every group has one node."""
    stages = []
    while True:
        k = len(stages)
        stages.append(written(_blocks(nodes, k, carried if k == 0 else ()), f"merkle-{label}-{k}"))
        if depth <= FAN_BITS * (k + 1):
            return stages
        nodes = stages[-1].filter(f"depth > {FAN_BITS * (k + 1)}").select(
            "g", F.col("block").alias("idx"), F.expr("element_at(levels, -1)[0]").alias("leaf"), "depth")


def _top(stages: list[DataFrame]) -> DataFrame:
    """(g, top): the last node of every group."""
    out = None
    for k, blocks in enumerate(stages):
        here = blocks.filter(f"depth <= {FAN_BITS * (k + 1)}").select("g", F.expr("element_at(levels, -1)[0]").alias("top"))
        out = here if out is None else out.unionByName(here)
    return out


def _proofs(stages: list[DataFrame], ends: DataFrame, carried: Sequence[str]) -> DataFrame:
    """(g, idx, leaf, path, carried...) of the first nodes, from the last stage down; ``ends`` (g, above) closes each path."""
    above = None
    for k in range(len(stages) - 1, -1, -1):
        done = stages[k].filter(f"depth <= {FAN_BITS * (k + 1)}").join(ends, "g")
        blocks = done if above is None else done.unionByName(stages[k].filter(f"depth > {FAN_BITS * (k + 1)}").join(
            above.select("g", F.col("idx").alias("block"), F.col("path").alias("above")), ["g", "block"]))
        more = "".join(f", s.{c} as {c}" for c in (carried if k == 0 else ()))
        above = blocks.select("g", F.expr(
            f"inline(transform(slots, s -> struct(shiftleft(block, {FAN_BITS}) + s.slot as idx, s.leaf as leaf, "
            f"concat({_SIBLINGS}, above) as path{more})))"))
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    rows = written(leaves(docs), "merkle-leaves")
    nodes = placed(rows)
    deepest = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    stages = _reduced(nodes, max(deepest - 1, 0).bit_length(), "rows", ("bent", "doc_id"))

    # the groups' roots make a tree of their own
    tops = written(_top(stages), "merkle-tops")
    first = F.substring("g", 1, 3)
    parts = tops.groupBy(first.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("part", _before(Window.orderBy("part")).alias("first"))
    count = tops.count()
    ranked = tops.withColumns({"part": first, "n": F.lit(1).cast("long")})
    ranked = ranked.withColumn("in_part", _before(Window.partitionBy("part").orderBy("g"))).join(parts, "part").select(
        F.lit("").alias("g"), F.col("g").alias("name"), (F.col("first") + F.col("in_part")).alias("idx"),
        F.col("top").alias("leaf"), F.lit(max(count - 1, 0).bit_length()).alias("depth"))
    upper = _reduced(ranked, max(count - 1, 0).bit_length(), "groups", ("name",))
    roots = _top(upper)
    nothing = F.expr("cast(array() as array<struct<l:string,r:string>>)")
    ends = _proofs(upper, roots.select("g", nothing.alias("above")), ("name",)).join(
        roots.select("g", F.col("top").alias("root")), "g").select(
        F.col("name").alias("g"), F.col("leaf").alias("subroot"), F.col("path").alias("above"), "root")
    ends = written(ends, "merkle-ends")

    out = _proofs(stages, ends.select("g", "above"), ("bent", "doc_id")).join(ends.select("g", "subroot", "root"), "g")
    folded = F.expr("aggregate(path, coalesce(bent, leaf), (acc, e) -> sha2(concat(e.l, acc, e.r), 256))")
    out = out.select("doc_id", "leaf", "subroot", "root",
                     _digest(F.expr("array_join(transform(path, e -> concat(e.l, e.r)), '')")).alias("proof_sha256"),
                     folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
