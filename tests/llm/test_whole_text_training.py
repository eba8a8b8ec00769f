"""The classifier is fitted on whole texts, in blocks where they are long."""

import numpy as np
import pytest

from statuta.llm import quality_cnn


def test_whole_texts_are_fitted(spark, monkeypatch):
    rows = [(i, "é" * 3000 + " end" + str(i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_cnn, "fit", lambda texts, y, **_: seen.extend(texts))
    quality_cnn.train(docs, labels)
    assert seen and set(seen) <= {t.encode() for _, t in rows}


@pytest.mark.parametrize("block", [3, 7, 512])
def test_gradient_in_blocks(monkeypatch, block):
    r = np.random.default_rng(4)
    m = {k: v.astype(np.float64) for k, v in quality_cnn.initial().items()}
    texts, y = [r.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 5, 130, 700, 3000, 9001)], np.array([0, 1, 0, 1, 1.0, 0])
    whole = quality_cnn._gradient(m, texts, y, np.ones(6))
    monkeypatch.setattr(quality_cnn, "AT_ONCE", 0)
    monkeypatch.setattr(quality_cnn, "BLOCK", block)
    parts = quality_cnn._gradient(m, texts, y, np.ones(6))
    assert whole.keys() == parts.keys()
    for name, d in whole.items():
        assert np.allclose(d, parts[name], rtol=1e-3, atol=1e-5), name
