"""I-Match document fingerprints with randomised lexicons (DataFrame functions only).

The lexicon keeps terms whose inverse document frequency lies in a band: terms of
at least ``low`` and at most ``high`` of all documents.  A document's distinct
lexicon terms are sorted, and several random subsets of the lexicon are hashed
apart; the fingerprint is the row of those hashes.  Two texts are alike by the
share of subsets, with terms in either text, whose hashes agree.  Subsets keep a
half down to a 128th of the lexicon, so small changes leave some of them as
they were.

The lexicon is broadcast: by counting, at most (mean distinct terms of a
document) / ``low`` terms can reach the band's lower end, whatever the corpus
size, so its size is bounded by the parameter.

Defined results: null texts are empty; a text without lexicon terms gets a
fingerprint of its own text's hash, alike (1.0) only to an equal text.  Rows are
ordered by doc_id (nulls first), then text; rows that repeat follow each other.
The next document of the last row is the first; a single row is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, id_text, written

#: Band of document frequency, as shares of all documents.
LOW, HIGH = 1 / 500, 1 / 4
#: Each random lexicon keeps one term in so many.
KEEP = (2, 2, 2, 2, 8, 8, 8, 8, 32, 32, 32, 32, 128, 128, 128, 128)
#: Rows aimed at in a block, the blocks aimed at where that makes too many, and hashed cuts a block.
BLOCK_ROWS, MAX_BLOCKS, FINE = 1000, 16_384, 8
#: First characters of a text that cuts between rows of one id, or of none, tell apart; cuts looked at together.
KEY_CHARS, WIDE = 64, 128

_EMPTY = "0" * 8
_SIDE = 1 << 16  # marks terms of the edited text
_ROW_MARK = 0  # stands in the lexicon so that a text without terms keeps a row


def term_hashes(text: Column) -> Column:
    """Distinct 64-bit hashes of a text's lower-cased terms (that of the empty term may be among them)."""
    return F.array_distinct(F.transform(F.split(F.lower(text), BLANKS), lambda w: F.xxhash64(w)))


def lexicon(texts: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(term, code) of the terms in the band, over all documents.

    ``code`` is the term's hash with its low 17 bits replaced: one bit per random
    lexicon tells whether that lexicon keeps the term, the 17th is left for the text's side.
    """
    n = texts.agg(F.count(F.lit(1)).alias("n"))
    df = texts.select(F.explode(term_hashes(F.col("text"))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"))
    band = df.filter(F.col("term") != F.xxhash64(F.lit(""))).crossJoin(F.broadcast(n)).filter(
        (F.col("df") >= F.col("n") * low) & (F.col("df") <= F.greatest(F.col("n") * high, F.lit(1))))
    mask = sum((F.when(F.pmod(F.xxhash64(F.col("term"), F.lit(r)), F.lit(k)) == 0, 1 << r).otherwise(0)
                for r, k in enumerate(KEEP)), F.lit(0))
    return band.select("term", F.col("term").bitwiseAND(~0x1FFFF).bitwiseOR(mask.cast("long")).alias("code"))


def fingerprint(codes: Column, text_hash: Column) -> Column:
    """Fingerprint text from the sorted lexicon codes of a text's distinct terms (without the side's bit)."""
    def signature(r: int) -> Column:
        kept = F.filter(codes, lambda c: c.bitwiseAND(1 << r) != 0)
        h = F.lpad(F.hex(F.xxhash64(kept).bitwiseAND(0xFFFFFFFF)), 8, "0")
        return F.when(F.size(kept) == 0, _EMPTY).when(h == _EMPTY, "00000001").otherwise(F.lower(h))

    whole = F.concat(*[signature(r) for r in range(len(KEEP))])
    bare = F.concat(F.lit("text-"), F.substring(text_hash, 1, 32))
    return F.when(F.size(codes) == 0, bare).otherwise(whole)


def likeness(a: Column, b: Column) -> Column:
    """Share of subsets, non-empty in either fingerprint, whose hashes agree."""
    part = lambda x, r: F.substring(x, 8 * r + 1, 8)
    used = sum((F.when((part(a, r) != _EMPTY) | (part(b, r) != _EMPTY), 1).otherwise(0)
                for r in range(len(KEEP))), F.lit(0))
    same = sum((F.when((part(a, r) == part(b, r)) & (part(a, r) != _EMPTY), 1).otherwise(0)
                for r in range(len(KEEP))), F.lit(0))
    bare = a.startswith("text-") | b.startswith("text-")
    return F.when(a == b, 1.0).when(bare | (used == 0), 0.0).otherwise(same / used).cast("double")


def in_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` with ``block``, and per block one row more (``extra``): the first row of the next block.

    Blocks are ranges of (doc_id, start of the text), cut at every FINE-th of the keys
    that a hash picks, so they hold about as many rows each whatever the ids are: far apart,
    repeated or missing.  Only rows of the same id, or of none, whose texts start with
    the same KEY_CHARS characters cannot be parted.  With the extra row, every row's successor
    is in its own block, and texts are shuffled once, by block.
    """
    n = rows.count()
    key = F.struct("doc_id", F.substring("text", 1, KEY_CHARS).alias("start"))
    step = max(1, max(BLOCK_ROWS, -(-n // MAX_BLOCKS)) // FINE)
    # about FINE * MAX_BLOCKS keys at most
    picked = rows.select(key.alias("key")).filter(F.pmod(F.xxhash64("key"), F.lit(step)) == 0).distinct()
    cuts = picked.agg(F.filter(F.array_sort(F.collect_list("key")), lambda c, i: i % FINE == FINE - 1).alias("cuts"))
    cuts = written(cuts.select(F.transform(
        F.sequence(F.lit(0), F.floor(F.size("cuts") / WIDE).cast("int")),
        lambda g: F.slice("cuts", g * WIDE + 1, WIDE)).alias("cuts")), "imatch-cuts")
    cuts = cuts.withColumn("firsts", F.transform("cuts", lambda g: F.get(g, F.lit(0))))
    listed = rows.crossJoin(F.broadcast(cuts)).withColumn("key", key)
    group = F.size(F.filter("firsts", lambda c: c <= F.col("key")))
    listed = listed.withColumn("group", group)
    among = F.size(F.filter(F.get("cuts", F.col("group") - 1), lambda c: c <= F.col("key")))
    block = F.when(F.col("group") == 0, 0).otherwise((F.col("group") - 1) * WIDE + among).cast("long")
    listed = listed.select("doc_id", "text", block.alias("block"), "key")
    # a row a block from here to the join
    order = Window.orderBy("of")
    heads = listed.groupBy(F.col("block").alias("of")).agg(F.min("key").alias("head")).select(
        F.coalesce(F.lag("of").over(order), F.max("of").over(Window.partitionBy())).alias("before"), "of", "head")
    first = listed.join(F.broadcast(heads), (F.col("block") == F.col("of")) & (F.col("key") == F.col("head")))
    first = first.groupBy(F.col("before").alias("block")).agg(
        F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    return (listed.select("doc_id", "text", "block", F.lit(0).alias("extra"))
            .unionByName(first.withColumn("extra", F.lit(1))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likenesses.

    The edited form has the last half of the characters replaced by the first as
    many of the next document.  Returns one row per input row: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = id_text(docs, id_col, text_col)
    lex = lexicon(rows, low, high)
    lex = F.broadcast(lex.unionByName(lex.sparkSession.range(1).select(
        F.lit(_ROW_MARK).cast("long").alias("term"), F.lit(_ROW_MARK).cast("long").alias("code"))))
    order = Window.partitionBy("block").orderBy("extra", "doc_id", "text")
    flow = in_blocks(rows).select(
        "block", "extra", "doc_id", "text",
        F.row_number().over(order).alias("at"), F.lead("text").over(order).alias("next"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    flow = flow.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), n - half),
        F.substring(F.coalesce("next", F.lit("")), F.lit(1), half)))
    # the row's own columns are made once and ride on one marked entry, so the spread-out rows stay narrow
    flow = flow.select(
        "block", "at", F.struct(
            "extra", "doc_id", n.cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"),
            F.sha2("edited", 256).alias("edited_sha256")).alias("about"),
        F.array(
            F.struct(F.lit(0).alias("side"), F.concat(
                F.array(F.lit(_ROW_MARK).cast("long")), term_hashes(F.col("text"))).alias("terms")),
            F.struct(F.lit(_SIDE).alias("side"), term_hashes(F.col("edited")).alias("terms"))).alias("texts"))
    flow = flow.select("block", "at", "about", F.explode("texts").alias("t"))
    flow = flow.select("block", "at", "about", F.col("t.side").alias("side"), F.explode("t.terms").alias("term"))
    flow = flow.select("block", "at", F.when(F.col("term") == _ROW_MARK, F.col("about")).alias("about"), "side", "term")
    code = F.when(F.col("term") != _ROW_MARK, F.col("code").bitwiseOR(F.col("side").cast("long")))
    # rows of a document stay in the task that holds its block: no shuffle here
    found = flow.join(lex, "term").groupBy("block", "at").agg(
        F.first("about", ignorenulls=True).alias("about"), F.collect_list(code).alias("codes"))
    # sorted once, here; the fingerprints below only filter
    found = found.withColumn("codes", F.sort_array("codes"))
    side = lambda s: F.transform(F.filter("codes", lambda c: c.bitwiseAND(_SIDE) == s),
                                 lambda c: c.bitwiseAND(~_SIDE))
    found = found.select("block", "at", "about.*", side(0).alias("own"), side(_SIDE).alias("changed"))
    found = found.select(
        "block", "at", "extra", "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("own"), F.col("text_sha256")).alias("fingerprint"),
        fingerprint(F.col("changed"), F.col("edited_sha256")).alias("edited_fingerprint"))
    found = found.withColumn("next_fingerprint", F.lead("fingerprint").over(
        Window.partitionBy("block").orderBy("at")))
    return found.filter("extra = 0").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        F.coalesce(likeness(F.col("fingerprint"), F.col("next_fingerprint")), F.lit(1.0)).alias("near_next"))
