"""Blocks of neighbouring rows where ids are uneven, repeated or missing."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from tidewatch.llm import imatch


def _rows() -> list[tuple[int | None, str]]:
    rng = random.Random(7)
    text = lambda: " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(1, 12)))
    ids = [*range(0, 6000, 2), 2**60, -(2**60)]
    return [(i, text()) for i in ids] + [(None, text()) for _ in range(2000)] + [(77, text()) for _ in range(2000)]


def test_blocks_are_even_where_ids_are_not(spark):
    df = spark.createDataFrame(_rows(), "doc_id long, text string").repartition(4)
    sizes = [r["n"] for r in imatch.in_blocks(df).groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 3 and max(sizes) < 3 * imatch.BLOCK_ROWS


def test_successors_hold_across_blocks_of_uneven_ids(spark):
    data = _rows()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = Counter((r["doc_id"], r["edited_sha256"]) for r in imatch.fingerprints(df).collect())
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want: Counter = Counter()
    for k, (i, t) in enumerate(order):
        half = len(t) // 2
        edited = t[:len(t) - half] + order[(k + 1) % len(order)][1][:half]
        want[i, hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert got == want


def test_one_row_follows_itself(spark):
    got = imatch.fingerprints(spark.createDataFrame([(None, "one two")], "doc_id long, text string")).collect()
    assert len(got) == 1 and got[0]["near_next"] == 1.0 and got[0]["n_chars"] == 7
