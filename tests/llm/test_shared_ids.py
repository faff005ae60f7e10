"""Rows without an id, with one shared id or with ids far apart: no group of them lands in one task."""

from __future__ import annotations

from collections import Counter

import duckdb

from tidewatch.llm import mixing
from tidewatch.llm.oracle import ORACLES

SCHEMA = "doc_id long, text string, lang string, source string"


def _uneven(n=1200):
    """A third without id, a third with one id, one id far away; all texts differ, some rows repeat."""
    ids = [None if i % 3 == 0 else 7 if i % 3 == 1 else i for i in range(n)]
    rows = [(d, f"text {i} " + "w " * (i % 17), "en", "big" if i % 2 else "small") for i, d in enumerate(ids)]
    return [*rows, rows[0], rows[1], (2 ** 60, "far away", "en", "big"), (-5, None, None, None)]


def test_mixture_blocks_of_shared_ids_stay_even(spark):
    rows = _uneven()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mixing.mix(df, budget=None).filter("epoch = 0").collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    in_block = Counter((r["source"], r["block"]) for r in got)
    assert max(in_block.values()) <= 4 * (len(rows) / 2) ** 0.5  # about sqrt(n) rows in each
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", rows)
    cols = ("doc_id", "source", "n_tokens", "epoch", "block", "block_order", "doc_order")
    want = con.sql("select " + ", ".join(cols) + " from (" + ORACLES["op6_source_mixture"] + ")").fetchall()
    assert Counter(tuple(r[c] for c in cols) for r in mixing.mix(df).collect()) == Counter(want)


def test_mixed_rows_are_the_ones_that_mix_takes(spark):
    df = spark.createDataFrame(_uneven(), SCHEMA)
    tokens = {}
    for r in mixing.mix(df).collect():
        tokens[r["doc_id"], r["source"]] = tokens.get((r["doc_id"], r["source"]), 0) + r["n_tokens"]
    again = {}
    for r in mixing.mixed_rows(df.repartition(9)).collect():
        k = (r["doc_id"], r["source"])
        again[k] = again.get(k, 0) + len((r["text"] or "").split())
    assert again == tokens
