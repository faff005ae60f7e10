"""Ownership decides: figures of every kind against brute force and SQL, and what redaction leaves."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tidewatch.llm import secrets
from tidewatch.llm.oracle import ORACLES

COLS = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_owners", "n_repos", "n_live")
SCHEMA = "doc_id long, text string, lang string, source string"
SPREAD, MINE, SAMPLE = "ghp_" + "Ab1" * 12, "ghp_" + "Zx9" * 12, "0123456789abcdef" * 2
PLAIN = {"assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         "access": r"(AKIA[A-Z0-9]{14,})", "hex": r"([0-9a-f]{16,})", "cred": f"({secrets.CRED})"}


def _rows():
    rows = [(i, f"in {lang} {SPREAD}", lang, "one") for i, lang in enumerate(("en", "de", "fr", "es"))]  # one owner, four repositories
    rows += [(10, f"a {MINE} b", "en", "one"), (11, f"b {MINE}", "de", "one")]  # one owner, two repositories
    rows += [(20 + i, f"token={SAMPLE} or {SAMPLE}", "en", f"s{i}") for i in range(5)]  # copied by five owners
    rows += [(30, "password: own-value-0001", "en", "s1"), (31, "password: own-value-0001 " + SAMPLE, "en", "s2")]
    rows += [(40, f"x {MINE}", None, None)] * 3 + [(None, f"y {SAMPLE}", None, None)] * 2  # repeats, null ids, owners
    rows += [(41, None, None, "s1"), (42, "", "en", None), (43, ("hex " + SAMPLE + " ") * 300, "en", "s9")]
    # a third of all rows share one value of one owner
    return rows + [(100 + i, f"no {i} secret='shared-by-hot-1234'", "en", "hot") for i in range(20)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(4)


def _plain(rows):
    """(spans with their hash per row, owners and repositories per value)."""
    owners, repos, per = defaultdict(set), defaultdict(set), []
    for i, t, lang, source in rows:
        spans = [(m.start(), k, m.end(), m[1]) for k, kind in enumerate(secrets.KINDS) for m in re.finditer(PLAIN[kind], t or "")
                 if kind != "assign" or len(m[1]) >= 12]
        for *_, v in spans:
            owners[v].add(source or "")
            repos[v].add((source or "", lang or ""))
        per.append((i, sorted(spans)))
    live = {v: len(owners[v]) <= secrets.MAX_LIVE_OWNERS and len(repos[v]) <= secrets.MAX_LIVE_REPOS for v in owners}
    return per, owners, repos, live


def test_figures_equal_brute_force_and_sql(df):
    per, owners, repos, live = _plain(_rows())
    assert not live[SPREAD] and not live[SAMPLE] and live["own-value-0001"] and live["shared-by-hot-1234"]
    want = Counter()
    for i, spans in per:
        said = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b, v in spans if k < 3 or live[v])
        base = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b, _ in spans if k < 3)
        want[i, *(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(base.encode()).hexdigest(), said,
             max((len(owners[s[3]]) for s in spans), default=0), max((len(repos[s[3]]) for s in spans), default=0),
             sum(live[s[3]] for s in spans)] += 1
    assert Counter(tuple(r[c] for c in COLS) for r in secrets.find_secrets(df).collect()) == want
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", _rows())
    sql = con.sql("select " + ", ".join(COLS) + " from (" + ORACLES["op9_secret_scan"] + ")").fetchall()
    assert Counter(sql) == want


def test_joined_verdicts_equal_broadcast_ones(df, monkeypatch):
    rows = Counter(secrets.find_secrets(df).collect())
    monkeypatch.setattr(secrets, "HOT_SHARE", 3)  # nearly all hashes take the join
    assert Counter(secrets.find_secrets(df).collect()) == rows


def test_classify_holds_every_kind(df):
    per, owners, repos, live = _plain(_rows())
    uses = Counter(s[3] for _, spans in per for s in spans)
    want = {(hashlib.sha256(v.encode()).hexdigest(), n, len(repos[v]), len(owners[v]), live[v]) for v, n in uses.items()}
    assert {tuple(r) for r in secrets.classify(df).select("hash", "n_uses", "n_repos", "n_owners", "live").collect()} == want


def test_redaction_follows_the_verdict(df):
    got = Counter((r["doc_id"], r["text"]) for r in secrets.redact(df, n_chars_col=None, only_live=True).collect())
    assert sum(got.values()) == len(_rows())
    by = {i: t for i, t in got}
    assert by[0] == f"in en {SPREAD}" and by[10] == "a <SECRET> b" and by[20] == f"token={SAMPLE} or {SAMPLE}"
    assert by[30] == "password: <SECRET>" and by[31] == f"password: <SECRET> {SAMPLE}"
    assert got[40, "x <SECRET>"] == 3 and got[None, f"y {SAMPLE}"] == 2 and by[41] is None and by[42] == ""
    assert by[43] == ("hex " + SAMPLE + " ") * 300 and by[105] == "no 5 secret='<SECRET>'"
    every = {r["doc_id"]: r["text"] for r in secrets.redact(df, n_chars_col=None).collect()}
    assert every[20] == "token=<SECRET> or <SECRET>" and every[0] == f"in en {SPREAD}"
