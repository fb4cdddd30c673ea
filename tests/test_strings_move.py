"""Chunks and books move texts as strings, not as arrays of words, and lose nothing over that."""

import random

import pytest

from talkmill.operators import chunking


def exchanged(df):
    """The types of columns that exchanges of the plan give."""
    found, nodes = set(), [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.initialPlan()
        if node.nodeName() == "Exchange":
            found |= {node.output().apply(i).dataType().simpleString() for i in range(node.output().size())}
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def texts(n, seed):
    draw = random.Random(seed)
    return [draw.choice([" ", "\t", "\n "]).join(draw.choice(["a", "bé", "long-word", "\U0001f600"]) for _ in range(draw.choice([0, 1, 3, 30, 95]))) for _ in range(n)]


@pytest.mark.parametrize("most, overlap", [(400, 50), (40, 7)])
def test_streamed_chunks(spark, most, overlap):
    rows = [(e, i, None if i % 11 == 3 else f"S{i // 4 % 3}", i * 1.5, t) for e in ("x", "y", None) for i, t in enumerate(texts(60, repr(e)))]
    rows += [("twice", i // 2, "S", 0.0, "the same words again") for i in range(12)] + [("twice", 3, "S", 0.0, None)]
    segs = spark.createDataFrame(rows, "episode string, seq int, speaker string, start double, text string").repartition(4)
    out = chunking.build_chunks_streamed(segs, max_words=most, overlap=overlap)
    kinds = exchanged(out)
    assert "string" in kinds and "array<string>" not in kinds
    want = chunking.build_chunks(segs, max_words=most, overlap=overlap).select(*out.columns)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect())) and want.count() > 20


def test_books(spark):
    rows = [(b, p, t) for b in ("x", None) for p, t in enumerate(texts(50, repr(b)), 1)] + [("twice", 1, "one two  three")] * 5 + [("twice", 2, " four\nfive ")]
    out = chunking.book_chunks(spark.createDataFrame(rows, "book string, page long, text string").repartition(4), size=20, overlap=6)
    kinds = exchanged(out)
    assert "string" in kinds and "array<string>" not in kinds
    want = []
    for b in ("x", None, "twice"):
        words = [(p, w) for book, p, t in rows if book == b for w in t.split()]
        want += [(b, i, words[i * 14][0], len(words[i * 14 : i * 14 + 20]), " ".join(w for _, w in words[i * 14 : i * 14 + 20])) for i in range((len(words) - 1) // 14 + 1)]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))
