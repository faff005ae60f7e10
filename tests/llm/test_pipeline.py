"""The pipeline over a small folder of tables: every stage's decisions take effect."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import sentencepiece

import corpus_pipeline


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts = {i: " ".join(words(80)) for i in range(200)}
    for i in range(100, 130):
        texts[i] = " ".join(w + rng.choice(["###", "$$$"]) for w in texts[i].split())  # junk
    near = texts[3].split()
    near[40] = "changed"
    texts[150], texts[151] = " ".join(near), texts[3]
    texts[7] += " password = 0123456789abcdef0123"
    data = [(i, t, "en", "hot" if i % 3 else f"s{i % 7}", len(t)) for i, t in texts.items()]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, int(not 100 <= i < 130), 0) for i in range(200) if i % 4]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept, columns = {}, docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert docs.columns == columns
            docs.write.parquet(f"{tmp_path}/{k}.parquet")
            docs = spark.read.parquet(f"{tmp_path}/{k}.parquet")
        kept[name] = docs.collect()
    good = {r["doc_id"] for r in kept["quality classifier"]}
    assert good == set(range(200)) - set(range(100, 130))
    one = {r["doc_id"] for r in kept["minhash near-dedup"]}
    assert one == good - {150, 151}
    clean = {r["doc_id"]: r["text"] for r in kept["secret scan"]}
    assert set(clean) == one and clean[7].endswith("password = <SECRET>")
    assert {r["doc_id"] for r in kept["source mixing"]} == one
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in kept["sentencepiece"]:
        ids = lib.encode(clean[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, kept["sentencepiece"]))


ODD_NAMES = ("_score", "_stats", "_id", "_n", "_source", "_block", "_text", "_all", "_new", "_mark", "_left", "kept_id")


def _write(spark, folder, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in ODD_NAMES)
    spark.createDataFrame([(*r, *ODD_NAMES) for r in rows], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_odd_rows_and_clashing_names_pass_all_stages(spark, tmp_path):
    rng = random.Random(2)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    same = text(50)
    rows = [(1, same, "en", "a", 1), (2, same, "en", "a", 1), (3, None, "en", None, None), (4, "", None, "b", 0), (5, " \n", "de", "b", 3),
            (6, text(40_000), "fr", "b", 9), (7, "secret = 0123456789abcdef", "en", "c", 25), (8, text(30), "en", "a", 1),
            (8, text(30), "en", "a", 1), (9, "one", "en", "a", 3), (9, "one", "en", "a", 3), (None, same, "en", "a", 1), (None, None, None, None, None)]
    _write(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = stage(spark, docs, str(tmp_path))
        assert len(docs.columns) == 5 + len(ODD_NAMES)
        docs.write.parquet(f"{tmp_path}/{k}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{k}.parquet")
        assert all(r[c] == c for r in docs.collect() for c in ODD_NAMES)
        seen.append(sorted((r["doc_id"] or 0, r["text"] or "") for r in docs.collect()))
    assert seen[0] == sorted((r[0] or 0, r[1] or "") for r in rows)  # no labels: nothing is rejected
    once = [r for i, r in enumerate(rows) if r[0] != 2 and r not in rows[:i]]
    assert seen[1] == sorted((r[0] or 0, r[1] or "") for r in once)
    assert (7, "secret = <SECRET>") in seen[2] and len(seen[2]) == len(seen[1])
    assert set(seen[3]) == set(seen[2])
    last = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(last) == len(seen[3])


def test_empty_tables_pass_all_stages(spark, tmp_path):
    _write(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
