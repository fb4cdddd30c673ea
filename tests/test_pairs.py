"""Pairs of draws are multiplied in blocks, and values at ranks are found without moving all of them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from talkmill.functions import vectors
from talkmill.operators import evaluate


def told(a, b):
    if a is None or b is None or len(a) != len(b) or None in a or None in b:
        return 0.0
    lengths = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / lengths if lengths else 0.0


@pytest.mark.parametrize("kind, block", [("long", 1000), ("long", 4), ("string", 4)])
def test_draws_in_blocks(spark, monkeypatch, kind, block):
    monkeypatch.setattr(evaluate, "BLOCK", block)
    draw, wild = random.Random(7), [None, [0.0, 0.0, 0.0], [1.0, None, 2.0], [1.0, 2.0], []]
    rows = [("e", c, i, wild[i] if i < len(wild) else [draw.randint(-4, 4) * 1.0 for _ in range(3)]) for c, n in (("a", 30), ("b", 1), ("c", 9)) for i in range(n)]
    rows += [("e", "c", 8, [1.0, 1.0, 1.0]), (None, "c", 1, [1.0]), (None, "c", 2, [1.0]), ("e", "c", None, [1.0])]
    df = spark.createDataFrame(rows, "episode string, cluster string, draw long, vector array<float>").withColumn("draw", F.col("draw").cast(kind))
    out = evaluate.draw_pairs(df)
    assert out.schema["a"].dataType == df.schema["draw"].dataType
    as_ = int if kind == "long" else str
    want = sorted((c, as_(a), as_(b), round(told(va, vb), 9)) for e, c, a, va in rows for f, k, b, vb in rows if e == f == "e" and c == k and a is not None and b is not None and as_(a) < as_(b))
    assert sorted((r["cluster"], r["a"], r["b"], round(r["cosine"], 9)) for r in out.collect()) == want


def test_values_at_ranks(spark):
    draw = random.Random(3)
    values = [round(draw.uniform(-1, 1), 2) for _ in range(500)] + [0.25 + i * 1e-9 for i in range(300)] + [math.nan, math.inf, -math.inf, None]
    df = spark.createDataFrame([(x,) for x in values], "x double").repartition(5)
    ordered = sorted((x for x in values if x is not None), key=lambda x: (math.isnan(x), x))
    ranks = {f"r{i}": (lambda n, i=i: F.lit(i)) for i in (0, 1, 250, 400, 600, 801, 802, 803)} | {"last": lambda n: n - 1, "p": vectors.percentile_rank(0.3)}
    got = vectors.at_ranks(df, "x", ranks, {"rows": F.count("*")}).first()
    at = lambda i: repr(ordered[i]) if i < len(ordered) else "None"
    assert (got["n"], got["rows"]) == (803, 804)
    assert {k: repr(got[k]) for k in ranks} == {f"r{i}": at(i) for i in (0, 1, 250, 400, 600, 801, 802, 803)} | {"last": at(802), "p": at(240)}
    none = evaluate.cohesion(df.where("false").withColumnRenamed("x", "cosine"), 0.1).first()
    assert (none["pairs"], none["below"], none["p50"]) == (0, 0.0, None)
