"""Whitening beside an eigen decomposition, hard negatives beside scores of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkmill.llm import mining, queries, whitening

VECTORS = "vec_id long, x array<long>"


def table(spark, x, parts=3):
    return spark.createDataFrame([(i, list(map(int, v))) for i, v in enumerate(x)], VECTORS).repartition(parts)


def test_merged_states_lose_nothing():
    r = np.random.default_rng(1)
    x = r.normal(size=(300, 7)) * np.arange(1, 8) + 1e5
    state = whitening._of(x[:1])
    for at in range(1, 300, 23):
        state = whitening.merge(state, whitening._of(x[at : at + 23]))
    centred = x - x.mean(axis=0)
    assert state.n == 300 and np.allclose(state.mean, x.mean(axis=0), rtol=1e-14) and np.allclose(state.factors.T @ state.factors, centred.T @ centred, rtol=1e-9, atol=1e-6)


@pytest.mark.parametrize(("parts", "dim"), [(1, 3), (3, 12), (70, 10)])
def test_whitening_beside_an_eigen_decomposition(spark, parts, dim):
    r = np.random.default_rng(dim)
    x = np.floor(r.normal(size=(400, dim)) @ r.normal(size=(dim, dim)) * 300).astype(np.int64) + 100_000
    got = whitening.components_of(table(spark, x, parts)).toPandas().sort_values(["vec_id", "component"])
    k = min(8, dim)
    assert len(got) == 400 * k and set(got["n"]) == {400} and got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    exact = [sum((400 * int(v) - int(s)) ** 2 for v, s in zip(row, x.sum(axis=0))) for row in x]
    assert got["deviation"].tolist() == [d for d in exact for _ in range(k)]
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / 400)
    values, vectors = values[::-1], vectors[:, ::-1]
    expected = centred @ vectors[:, :k] / np.sqrt(values[:k])
    white = got["whitened"].to_numpy().reshape(400, k)
    white = white * np.sign((white * expected).sum(axis=0))
    assert np.allclose(white, expected, atol=1e-8) and np.allclose(got["explained"].to_numpy().reshape(400, k), values[:k] / values.sum(), rtol=1e-10)


def test_all_dimensions_are_kept(spark):
    x = np.random.default_rng(5).integers(-500, 500, (200, 12))
    rows = table(spark, x)
    model = whitening.fit(rows.select("x"))
    white = np.array([r["whitened"] for r in whitening.whiten(rows, model=model).collect()])
    assert white.shape == (200, 12) and np.allclose(np.cov(white.T, bias=True), np.eye(12), atol=1e-10)


def test_vectors_without_variance_and_odd_rows(spark):
    rows = [(1, [5, 5, 1]), (None, [5, 5, 2]), (1, [5, 5, 3]), (2, None), (3, [1, None, 2]), (4, [1, 2]), (5, [])]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"deviation": F.lit("x"), "at": F.lit(1), "n": F.lit(2)})
    got = sorted(whitening.components_of(df).collect(), key=lambda r: (r["component"], r["whitened"]))
    assert [r["whitened"] for r in got[3:]] == [0.0] * 6 and np.allclose(sorted(abs(r["whitened"]) for r in got[:3]), [0, math.sqrt(1.5), math.sqrt(1.5)])
    assert {r["n"] for r in got} == {3} and sorted(r["deviation"] for r in got[:3]) == [0, 9, 9] and got[0]["explained"] == pytest.approx(1) and got[0]["identity_error"] < 1e-12
    assert whitening.components_of(df.limit(0)).collect() == [] and whitening.components_of(df.where("vec_id = 2")).collect() == []
    one = whitening.components_of(df.where("get(x, 2) = 1")).collect()
    assert [(r["whitened"], r["explained"], r["deviation"]) for r in one] == [(0.0, 0.0, 0)] * 3


def test_deviations_beyond_a_long_are_null(spark):
    got = whitening.components_of(spark.createDataFrame([(1, [1 << 50, 0]), (2, [0, 0])], VECTORS)).collect()
    assert {r["deviation"] for r in got} == {None}
    assert {r["deviation"] for r in whitening.components_of(spark.createDataFrame([(1, [1 << 31, 0]), (2, [0, 0])], VECTORS)).collect()} == {1 << 62}


def mined(rows, anchor, positives=5, negatives=10, low=30, high=90):
    rows = {i: (label, x) for i, label, x in sorted(rows, key=lambda r: (r[1], r[2]), reverse=True)}
    score = lambda a, b: sum(p * q for p, q in zip(rows[a][1], rows[b][1]))
    out = []
    for a in filter(anchor, rows):
        best = lambda ids, k: sorted(ids, key=lambda i: (-score(a, i), i))[:k]
        for p in best([i for i in rows if i != a and rows[i][0] == rows[a][0]], positives):
            inside = [i for i in rows if rows[i][0] != rows[a][0] and low * score(a, p) <= 100 * score(a, i) <= high * score(a, p)]
            out += [(a, p, rank, i, score(a, p), score(a, i)) for rank, i in enumerate(best(inside, negatives), 1)]
    return sorted(out)


def taken(df, **more):
    return sorted(map(tuple, mining.mine(df, anchors=F.col("vec_id") % 10 == 0, **more).collect()))


@pytest.mark.parametrize(("dim", "size", "rows"), [(5, 3, 16), (40, 100, 64), (70, 30, 50)])
def test_negatives_beside_all_pairs(spark, monkeypatch, dim, size, rows):
    """Small blocks, few values for many ties, one label with half the rows."""
    monkeypatch.setattr(mining, "ROWS", rows)
    monkeypatch.setattr(mining, "ANCHORS", 7)
    r = random.Random(dim)
    given = [(i - 50, r.choice([1, 1, 1, 2, 3, 9]), [r.randint(-size // 3, size) for _ in range(dim)]) for i in range(300)]
    df = spark.createDataFrame(given, "vec_id long, label int, x array<long>").repartition(5)
    assert taken(df) == mined(given, lambda i: i % 10 == 0)
    assert taken(df, positives=2, negatives=3, low=(1, 2), high=(1, 1)) == mined(given, lambda i: i % 10 == 0, 2, 3, 50, 100)


def test_odd_vectors(spark):
    given = [(0, 1, [3, 1]), (1, 1, [4, 1]), (2, 2, [2, 1]), (3, 2, [3]), (3, 3, [9, 9]), (4, None, [3, 3]), (5, 2, None), (6, 2, [1, None]), (None, 2, [2, 2]), (2, 2, [2, 1]), (7, 2, []), (10, 5, [2, 2])]
    df = spark.createDataFrame(given, "vec_id long, label int, x array<long>").withColumns({"id": F.lit(1), "anchor": F.lit(2), "rank": F.lit("r")})
    assert taken(df) == [(0, 1, 1, 3, 13, 9), (0, 1, 2, 10, 13, 8), (0, 1, 3, 2, 13, 7)]
    assert taken(df.limit(0)) == [] and mining.mine(df, anchors=F.lit(None).cast("boolean")).collect() == []
    with pytest.raises(ValueError):
        taken(spark.createDataFrame([(0, 1, [1 << 40])], "vec_id long, label int, x array<long>"))


def test_the_queries_drop_what_is_not_finite(spark):
    rows = [(1, [0.5, float("nan")]), (2, [float("inf"), 1.0]), (3, None), (4, [None, 1.0]), (5, [-0.001, 0.25])]
    got = queries._fixed_point(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 1024, 100_000).collect()
    assert [(r["vec_id"], r["x"]) for r in got] == [(5, [99_998, 100_256])]
