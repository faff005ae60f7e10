"""Temperature mixing of sources (DataFrame functions only).

Source ``s`` holds the token share ``p_s``.  Its weight is ``p_s ** a`` over the sum
of all: ``a = 1`` keeps the natural mix, smaller exponents favour small sources,
``a = 0`` weighs all alike.  The exponent is the largest that meets a target
entropy (a share of the highest possible), found by bisection on a fixed grid;
where small sources would then repeat more often than a limit, it is raised to the
smallest exponent that keeps the limit.

The weights are realised as token quotas.  A source's documents are dealt into
about sqrt(n) blocks by a hash of id and text; each pass (epoch) over a source visits its blocks in
another hashed order.  Whole epochs repeat every document; the last, partial epoch
takes whole blocks, then documents of one cut block, as far as the quota goes.  So
no step orders a whole source: windows hold the blocks of a source or the
documents of a block.

Defined results: a null source is one source of its own, reported as null; null texts have no
tokens; documents without tokens cost nothing and are taken with the block that
they are in; rows that repeat are separate documents, dealt by their texts if
they share an id or have none; of no rows the result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

#: Exponents are multiples of 1 / GRID.
GRID = 10_000
#: Target entropy as a share of ln(number of sources).
ENTROPY = 0.95
#: No document is used more often than this on average of its source.
MAX_REPEATS = 4.0
SEED = "mix-1"
#: Exponents tried by one aggregate over the sources.
_TRIES = 16


def word_tokens(text: Column) -> Column:
    """Tokens of a text, counted as words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_shares(sized: DataFrame) -> DataFrame:
    """(source, n_docs, tokens, p, total) from rows of ``source`` and ``n_tokens``."""
    by = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    total = by.agg(F.sum("tokens").alias("total"))
    return by.crossJoin(F.broadcast(total)).withColumn(
        "p", F.when(F.col("total") > 0, F.col("tokens") / F.col("total")).otherwise(0.0))


def _bisect(ok, low: int, high: int) -> int:
    """Smallest grid exponent in [low, high] for which ``ok`` holds; it holds from there on."""
    while low < high:
        step = max(1, (high - low) // _TRIES)
        tries = list(range(low, high, step))
        good = [t for t, yes in zip(tries, ok(tries), strict=True) if yes]
        if good:
            high = good[0]
            low = max([low, *[t + 1 for t in tries if t < high]])
        else:
            low = tries[-1] + 1
    return low


def exponent(shares: DataFrame, entropy: float | None = ENTROPY, max_repeats: float | None = MAX_REPEATS,
             budget: float | None = 1.0) -> float:
    """The exponent for ``shares`` (of ``source_shares``).

    ``budget`` is in multiples of the corpus tokens; None asks for the smallest
    budget that takes every source at least once.  Each try is an aggregate over
    the sources; only its figures come to the driver.
    """
    live = shares.filter("p > 0")

    def entropy_low(tries: list[int]) -> list[bool]:
        # H(a) = ln Z - a * sum(p^a ln p) / Z; holds once the entropy falls below the target
        cols = [F.count(F.lit(1)).alias("s")]
        for t in tries:
            w = F.pow("p", F.lit(t / GRID))
            cols += [F.sum(w).alias(f"z{t}"), F.sum(w * F.log("p")).alias(f"l{t}")]
        r = live.agg(*cols).select(*[
            (F.log(f"z{t}") - F.lit(t / GRID) * F.col(f"l{t}") / F.col(f"z{t}")
             < F.lit(entropy) * F.log("s")).alias(f"x{t}") for t in tries]).first()
        return [bool(x) for x in r]

    def repeats_ok(tries: list[int]) -> list[bool]:
        cols = []
        for t in tries:
            w = F.pow("p", F.lit(t / GRID))
            cols += [F.sum(w).alias(f"z{t}"), F.max(w / F.col("p")).alias(f"m{t}"), F.max(F.col("p") / w).alias(f"c{t}")]
        r = live.agg(*cols).select(*[
            ((F.col(f"c{t}") * F.col(f"m{t}") if budget is None else F.lit(budget) * F.col(f"m{t}") / F.col(f"z{t}"))
             <= F.lit(max_repeats)).alias(f"x{t}") for t in tries]).first()
        return [bool(x) for x in r]

    a = GRID
    if entropy is not None:
        a = max(0, _bisect(entropy_low, 0, GRID + 1) - 1)
    if max_repeats is not None:
        a = max(a, _bisect(repeats_ok, 0, GRID))
    return a / GRID


def quotas(shares: DataFrame, a: float, budget: float | None) -> DataFrame:
    """(source, n_docs, weight, quota, full, rest): the tokens to take, as whole epochs and a rest."""
    w = F.when(F.col("p") > 0, F.pow("p", F.lit(a))).otherwise(0.0)
    sums = shares.agg(F.sum(w).alias("z"), F.max(F.when(F.col("p") > 0, F.col("p") / w)).alias("cover"))
    out = shares.crossJoin(F.broadcast(sums)).withColumn(
        "weight", F.when(F.col("z") > 0, w / F.col("z")).otherwise(0.0))
    if budget is None:  # the source with the largest p / weight is taken exactly once
        quota = F.greatest(F.col("tokens"), F.floor(F.col("total") * F.col("cover") * w))
    else:
        quota = F.floor(F.col("total") * F.lit(budget) * F.col("weight"))
    out = out.withColumn("quota", F.coalesce(quota.cast("long"), F.lit(0).cast("long")))
    full = F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(F.lit(0).cast("long"))
    return out.withColumn("full", full).withColumn("rest", F.expr("quota - full * tokens")).select(
        "source", "n_docs", "weight", "quota", "full", "rest")


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(SEED), *[F.coalesce(x.cast("string"), F.lit("")) for x in parts]))


def _sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """``docs`` with _id, _source (never null), _n (tokens) and _hash (of the text)."""
    return docs.withColumns({
        "_id": F.col(id_col), "_n": word_tokens(F.col(text_col)),
        "_hash": F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))),
        "_source": F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))})


def _dealt(rows: DataFrame, entropy: float | None, max_repeats: float | None, budget: float | None) -> DataFrame:
    """``rows`` (of ``_sized``) as often as the weights ask, with _epoch, _block and _at (order in the block)."""
    sizes = written(rows.select(F.col("_id"), F.col("_source").alias("source"), F.col("_n").alias("n_tokens"), "_hash"),
                    "mix-sizes")
    shares = written(source_shares(sizes), "mix-shares")
    few = shares.count()
    a = exponent(shares, entropy, max_repeats, budget) if few else 1.0
    plan = quotas(shares, a, budget)
    parts = shares.select(F.col("source").alias("_source"), F.ceil(F.sqrt("n_docs")).cast("long").alias("_parts"))
    # joined before blocks are known: a source may hold a third of all rows, so not by shuffle unless sources are many
    parts = F.broadcast(parts) if few <= FEW_SOURCES else parts
    spot = F.conv(F.substring(_hash(F.lit("block"), F.col("_id"), F.col("_hash")), 1, 12), 16, 10).cast("long")

    def placed(x: DataFrame) -> DataFrame:
        return x.join(parts, "_source").withColumn("_block", F.pmod(spot, F.col("_parts"))).drop("_parts")

    blocks = placed(sizes.withColumnsRenamed({"source": "_source", "n_tokens": "_n"})).groupBy(
        F.col("_source").alias("source"), F.col("_block").alias("block")).agg(F.sum("_n").alias("block_tokens"))
    blocks = blocks.join(plan, "source")
    last = Window.partitionBy("source").orderBy(_hash(F.col("full"), F.col("source"), F.col("block")), "block")
    before = F.sum("block_tokens").over(last.rowsBetween(Window.unboundedPreceding, 0)) - F.col("block_tokens")
    blocks = blocks.select(F.col("source").alias("_source"), F.col("block").alias("_block"),
                           F.col("full").alias("_full"), (F.col("rest") - before).alias("_left"))
    inner = Window.partitionBy("_source", "_block").orderBy(
        _hash(F.col("_source"), F.col("_id"), F.col("_hash")), "_id", "_hash")
    out = placed(rows).join(blocks, ["_source", "_block"]).withColumns({
        "_at": F.row_number().over(inner),
        "_upto": F.sum("_n").over(inner.rowsBetween(Window.unboundedPreceding, 0))})
    out = out.withColumn("_copies", F.col("_full") + F.when(F.col("_upto") <= F.col("_left"), 1).otherwise(0))
    return out.filter("_copies > 0").withColumn("_epoch", F.explode(F.expr("sequence(0L, _copies - 1)")))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        entropy: float | None = ENTROPY, max_repeats: float | None = MAX_REPEATS,
        budget: float | None = 1.0) -> DataFrame:
    """One row per use of a document: doc_id, source, n_tokens, epoch, block, block_order, doc_order.

    Reading a source's rows by epoch, block_order and doc_order gives its stream.
    """
    rows = _sized(docs, id_col, source_col, text_col).select("_id", "_source", "_n", "_hash")
    return _dealt(rows, entropy, max_repeats, budget).select(
        F.col("_id").alias("doc_id"),
        F.when(F.col("_source") != "", F.expr("substring(_source, 2)")).alias("source"), F.col("_n").alias("n_tokens"),
        F.col("_epoch").cast("int").alias("epoch"), F.col("_block").cast("int").alias("block"),
        _hash(F.col("_epoch"), F.col("_source"), F.col("_block")).alias("block_order"), F.col("_at").alias("doc_order"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
               entropy: float | None = ENTROPY, max_repeats: float | None = MAX_REPEATS,
               budget: float | None = 1.0) -> DataFrame:
    """The input's own rows and columns, each as often as ``mix`` takes it."""
    rows = _dealt(_sized(docs, id_col, source_col, text_col), entropy, max_repeats, budget)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


#: A table of sources up to this many rows is broadcast; a larger one is joined by shuffle.
FEW_SOURCES = 10_000
