"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Candidate strings are found by pattern in every whole text.  Each candidate's
hash is aggregated over the corpus: in how many distinct repositories and by how
many distinct owners it occurs.  A string that many owners share is a copied
example (documentation keys, vendor samples); one that stays with its owner
looks like a live credential.

The three base kinds are always reported.  Provider-shaped credentials
(``cred``) are added only when ownership says that they are owner-specific: few
owners, and few repositories of theirs.  Every kind's candidates are folded, and
each text carries the figures of its own.

Defined results: null or empty texts have no spans; a null id is kept as it is;
repeated rows each get their own result and count once per repository and owner;
a null owner or repository counts as one (unnamed) owner or repository.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: The base kinds, in the order in which equal starts are listed.
BASE_KINDS = ("assign", "access", "hex")
ADDED_KIND = "cred"
KINDS = (*BASE_KINDS, ADDED_KIND)

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
#: A greedy run of one class of 16+ (18+) is the whole run, so the lower bound can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Shapes of provider credentials, from the providers' public documentation.
CRED = (
    r"gh[opsu]_[A-Za-z0-9]{20,}|sk_live_[A-Za-z0-9]{16,}|sk-[A-Za-z0-9]{20,}|xox[abps]-[A-Za-z0-9-]{10,}"
    r"|AIza[A-Za-z0-9_-]{30,}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"
)
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "cred": CRED}

MIN_ASSIGN_VALUE = 12
#: A candidate of more distinct owners than this is a copied example.
MAX_LIVE_OWNERS = 2
#: So is one that stays with few owners but is found in more of their repositories than this.
MAX_LIVE_REPOS = 3
#: Verdicts of hashes with at least one in so many of all uses are broadcast (at most so many hashes).
HOT_SHARE = 1000

_SPAN = "struct<start:int,kind:int,end:int,value_start:int,hash:string>"
_JUDGED = "struct<start:int,kind:int,end:int,value_start:int,hash:string,live:boolean>"


def _matches(kind: str, pieces: Column, found: Column) -> Column:
    """Spans of one kind from the texts between its matches and the matches themselves."""
    k = KINDS.index(kind)

    def value(m: Column) -> Column:
        return F.regexp_extract(m, ASSIGN_VALUE, 1) if kind == "assign" else m

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        v = value(x["match"])
        span = F.struct(
            start.alias("start"), F.lit(k).alias("kind"), end.alias("end"),
            (end - F.length(v)).alias("value_start"), F.sha2(v, 256).alias("hash"),
        )
        ok = F.length(v) >= MIN_ASSIGN_VALUE if kind == "assign" else F.lit(True)
        return F.struct(
            end.alias("pos"),
            F.when(ok, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    pairs = F.zip_with(F.slice(pieces, 1, F.size(found)), found,
                       lambda p, m: F.struct(p.alias("piece"), m.alias("match")))
    none = F.struct(F.lit(0).alias("pos"), F.expr(f"cast(array() as array<{_SPAN}>)").alias("spans"))
    return F.aggregate(pairs, none, step, lambda acc: acc["spans"])


def with_spans(docs: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``docs`` with one more column ``_spans``: the candidate spans of ``kinds``, by start, then kind.

    ``split`` gives the text between matches and ``regexp_extract_all`` the
    matches; running lengths of the two give the offsets in code points.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs
    for kind in kinds:
        out = out.withColumn(f"_p_{kind}", F.split(text, PATTERNS[kind], -1))
    for kind in kinds:
        found = F.when(F.size(f"_p_{kind}") > 1, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)))
        out = out.withColumn(f"_m_{kind}", F.coalesce(found, F.expr("cast(array() as array<string>)")))
    spans = [_matches(k, F.col(f"_p_{k}"), F.col(f"_m_{k}")) for k in kinds]
    out = out.withColumn("_spans", F.array_sort(F.concat(*spans)))
    return out.drop(*[f"_{x}_{k}" for x in "pm" for k in kinds])


def ownership(spans: DataFrame) -> DataFrame:
    """Per candidate hash: uses, distinct repositories and owners, and whether it looks live.

    ``spans`` has ``hash``, ``repo`` and ``owner``, one row per occurrence.  Both
    counts start from distinct (hash, repo, owner) rows, so a string copied into
    a third of the corpus is folded inside each task before anything is shuffled.
    A repository belongs to its owner: the same name under two owners counts twice.
    """
    part = spans.select("hash", F.coalesce("repo", F.lit("")).alias("repo"),
                        F.coalesce("owner", F.lit("")).alias("owner"))
    part = part.groupBy("hash", "repo", "owner").agg(F.count(F.lit(1)).alias("n"))
    owners = part.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("repo").alias("repos"))
    return owners.groupBy("hash").agg(
        F.sum("n").alias("n_uses"), F.sum("repos").alias("n_repos"), F.count("owner").alias("n_owners"),
    ).withColumn("live", (F.col("n_owners") <= MAX_LIVE_OWNERS) & (F.col("n_repos") <= MAX_LIVE_REPOS))


def _rows(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_cols: tuple[str, ...]) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(owner_col).cast("string").alias("owner"),
        F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repo_cols]).alias("repo"))


def scanned(rows: DataFrame) -> DataFrame:
    """(doc_id, key, repo, owner, spans) of every row: the one scan of the texts, written without them."""
    return written(with_spans(rows).select(
        "doc_id", F.sha2("text", 256).alias("key"), "repo", "owner", F.col("_spans").alias("spans")), "secret-spans")


def _owned(found: DataFrame) -> DataFrame:
    return ownership(found.select("repo", "owner", F.explode("spans").alias("s"))
                     .select("repo", "owner", F.col("s.hash").alias("hash")))


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
             repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """(hash, n_uses, n_repos, n_owners, live) of every candidate, base and added kinds alike."""
    return _owned(scanned(_rows(docs, id_col, text_col, owner_col, repo_cols)))


def judged(found: DataFrame) -> DataFrame:
    """(doc_id, key, n, found, n_owners, n_repos, n_live) of the texts of ``scanned`` that hold a candidate.

    One row per doc_id and text, ``n`` of them in the input; ``found`` holds the
    spans with their verdict.  Verdicts meet the candidates by hash: those of
    hashes that make up a ``1 / HOT_SHARE`` of all uses or more (so at most
    ``HOT_SHARE`` hashes, whatever the corpus) are broadcast, the others joined.
    """
    owned = written(_owned(found), "secret-owners")
    total = owned.agg(F.sum("n_uses").alias("total"))
    hot = owned.crossJoin(F.broadcast(total)).filter(F.col("n_uses") * HOT_SHARE >= F.col("total"))
    hot = F.broadcast(hot.drop("total"))
    texts = found.filter(F.size("spans") > 0).groupBy("doc_id", "key").agg(
        F.count(F.lit(1)).alias("n"), F.first("spans").alias("spans"))
    spans = texts.select("doc_id", "key", "n", F.explode("spans").alias("s")).withColumn("hash", F.col("s.hash"))
    met = spans.join(hot, "hash").unionByName(spans.join(hot, "hash", "left_anti").join(owned, "hash"))
    return met.groupBy("doc_id", "key").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("s.*", "live"))).alias("found"),
        F.max("n_owners").alias("n_owners"), F.max("n_repos").alias("n_repos"),
        F.count_if("live").alias("n_live"))


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _reported(span: Column) -> Column:
    """Base kinds always, added ones if they look live."""
    return (span["kind"] < len(BASE_KINDS)) | span["live"]


def _count(spans: Column, kind: str) -> Column:
    k = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, digest of the base spans, all spans as text; over all of the
    text's candidates the most owners and repositories of one, and how many look live."""
    found = scanned(_rows(docs, id_col, text_col, owner_col, repo_cols))
    some = judged(found).withColumn("use", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    none = found.filter(F.size("spans") == 0).select(
        "doc_id", F.expr(f"cast(array() as array<{_JUDGED}>)").alias("found"),
        *[F.lit(0).cast("long").alias(c) for c in ("n_owners", "n_repos", "n_live")])
    out = some.select(none.columns).unionByName(none)
    base = F.filter("found", lambda s: s["kind"] < len(BASE_KINDS))
    return out.select(
        "doc_id", *[_count(F.col("found"), k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.filter("found", _reported)).alias("spans"),
        "n_owners", "n_repos", "n_live")


def redact(docs: DataFrame, mark: str = "<SECRET>", text_col: str = "text", id_col: str = "doc_id",
           owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang"),
           n_chars_col: str | None = "n_chars", only_live: bool = False) -> DataFrame:
    """``docs`` with every reported secret's value replaced by ``mark``; all rows and columns stay.

    ``only_live`` leaves values of the base kinds too where ownership calls them
    copied examples.  Overlapping values are replaced once, together.  ``n_chars``
    follows the new text.
    """
    names = docs.columns
    rows = docs.withColumns({"_id": F.col(id_col), "_text": F.coalesce(F.col(text_col), F.lit(""))})
    verdicts = judged(scanned(_rows(docs, id_col, text_col, owner_col, repo_cols))).select(
        F.col("doc_id").alias("_a_id"), F.col("key").alias("_a_key"), F.col("found").alias("_found"))
    has = reduce(or_, [F.col("_text").rlike(p) for p in PATTERNS.values()])
    # only texts that may hold a candidate are shuffled
    some = rows.filter(has).withColumn("_key", F.sha2("_text", 256)).join(
        verdicts, F.col("_id").eqNullSafe(F.col("_a_id")) & (F.col("_key") == F.col("_a_key")), "left").drop(
        "_a_id", "_a_key", "_key")
    none = F.expr(f"cast(array() as array<{_JUDGED}>)")
    rows = rows.filter(~has).withColumn("_found", none).unionByName(some)
    wanted = (lambda s: s["live"]) if only_live else _reported
    rows = rows.withColumn("_all", F.array_sort(F.transform(
        F.filter(F.coalesce("_found", none), wanted),
        lambda s: F.struct(s["value_start"].alias("a"), s["end"].alias("b")))))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["a"] >= acc["pos"]
        gap = F.substring(F.col("_text"), acc["pos"] + 1, s["a"] - acc["pos"])
        return F.struct(
            F.greatest(acc["pos"], s["b"]).alias("pos"),
            F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("_all", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(F.col("_text"), acc["pos"] + 1, F.length("_text"))))
    new = F.when(F.size("_all") > 0, done).otherwise(F.col(text_col))
    rows = rows.withColumn("_new", new)
    fields = []
    for c in names:
        if c == text_col:
            fields.append(F.col("_new").alias(c))
        elif c == n_chars_col:
            fields.append(F.when(F.size("_all") > 0, F.length("_new").cast(docs.schema[c].dataType))
                          .otherwise(F.col(c)).alias(c))
        else:
            fields.append(F.col(f"`{c}`"))
    return rows.select(*fields)
