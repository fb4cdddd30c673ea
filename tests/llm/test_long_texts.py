"""The chain over long texts, walked in blocks, gives what the plain walk gives; training with other columns."""

import time

import numpy as np
import pytest

from talkmill.llm import toxicity


@pytest.mark.parametrize("n", [2, 3, 4, 5, 17, 1000])
@pytest.mark.parametrize("scale", [1.0, 20.0])
def test_blocks_equal_the_plain_walk(monkeypatch, n, scale):
    r = np.random.default_rng(n)
    scores, move = [r.normal(size=k) * scale for k in (n, n // 2 + 1, 1)], r.normal(size=(2, 2))
    plain, moves = toxicity.forward_backward(scores, move)
    monkeypatch.setattr(toxicity, "LONG", 1)
    blocked, more = toxicity.forward_backward(scores, move)
    assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(plain, blocked)) and np.allclose(moves, more, rtol=1e-6)


def test_long_texts_take_little_time():
    began = time.time()
    r = np.random.default_rng(1)
    (m,), _ = toxicity.forward_backward([r.normal(size=2_000_000) - 2], np.array([[1.0, -1.0], [-1.0, 1.0]]))
    assert len(m) == 2_000_000 and time.time() - began < 10


def test_training_with_other_columns_and_without_labels(spark):
    docs = spark.createDataFrame([(f"k{i}", ("vile scum " if i % 2 else "kind words ") * 5) for i in range(60)], "name string, body string")
    labels = spark.createDataFrame([(f"k{i}", i % 2, None) for i in range(60)] + [(None, 1, None), ("k1", None, None)], "name string, bad int, toxic int")
    model = toxicity.train(docs, labels, id_col="name", text_col="body", label_col="bad")
    rows = {r["name"]: r for r in toxicity.score(docs, model, id_col="name", text_col="body").collect()}
    assert all(r["predicted"] == int(k[1:]) % 2 for k, r in rows.items())
    blank = toxicity.train(docs, labels.limit(0), id_col="name", text_col="body", label_col="bad")
    assert len({round(r["score"], 9) for r in toxicity.score(docs, blank, id_col="name", text_col="body").collect()}) == 1
