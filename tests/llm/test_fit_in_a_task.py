"""The quality fit runs in a task: no row of statistics and no matrix comes to the driver."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import DataFrame

from tidewatch.llm import quality


def _marked(spark, n):
    texts = [(i, f"word{i} and more of it, plain text. " * 4 if i % 2 else "BUY!!! $$$ 111 || " * (3 + i % 5)) for i in range(n)]
    return (spark.createDataFrame(texts, "doc_id long, text string"),
            spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, quality int"))


def test_the_driver_does_not_fit(spark, monkeypatch):
    docs, labels = _marked(spark, 60)
    rows = [quality.text_stats(r["text"]) for r in docs.orderBy("doc_id").collect()]
    want = quality.fit_rules(np.array(rows), np.arange(60) % 2.0)
    monkeypatch.setattr(quality, "fit_rules", lambda *a: pytest.fail("fitted in the driver"))
    monkeypatch.setattr(DataFrame, "toPandas", lambda self: pytest.fail("rows came to the driver"))
    got = quality.train(docs, labels)
    assert got["bias"] == pytest.approx(want["bias"], abs=1e-9) and len(got["rules"]) == len(want["rules"])
    assert got["linear"] == [pytest.approx(x, abs=1e-9) for x in want["linear"]]
    monkeypatch.undo()
    p = {r["doc_id"]: r["p"] for r in quality.score(docs, got, out="p").collect()}
    assert np.allclose([p[i] for i in range(60)], quality.score_numpy(want, np.array(rows)), atol=1e-9)


def test_without_labels_or_documents_every_score_is_a_half(spark):
    docs, labels = _marked(spark, 30)
    for d, m in ((docs, labels.limit(0)), (docs.limit(0), labels)):
        assert quality.score_numpy(quality.train(d, m), np.zeros((1, len(quality.STATS)))).tolist() == [0.5]
