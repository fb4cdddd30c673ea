"""Many queries at once meet rows in a grid: what moves grows with rows and queries, not with queries times cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_index import clustered

from talkmill.operators import index


@pytest.fixture(scope="module")
def vectors():
    x = clustered(1500, dim=12)
    x[700:740] = x[7]  # ties
    return x


@pytest.fixture(scope="module")
def records(spark, vectors):
    return spark.createDataFrame([(f"r{i:05d}", v.tolist()) for i, v in enumerate(vectors)] + [("none", None), ("flat", [0.0] * 12)], "id string, embedding array<float>").repartition(3)


@pytest.fixture(scope="module")
def built(records):
    return index.build(records, cells=30)


def asked(records, every):
    return records.where(f"id in ('none', 'flat') or int(substr(id, 2)) % {every} = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))


def told(built, vectors, every, n, k):
    """The same from all pairs; k is a number of cells or None for all rows."""
    x = vectors.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cell = np.empty(len(x), int)
    for r in built.table.where("id like 'r%'").select("id", built.cell).collect():
        cell[int(r[0][1:])] = r[1]
    there, out = np.unique(cell), []
    for q in range(0, len(x), every):
        probed = there[np.argsort(-(x[q] @ built.pivots[there].T), kind="stable")[:k]]
        rows, s = np.flatnonzero(np.isin(cell, probed)), np.round(x @ x[q], 9)
        out += [(f"r{q:05d}", rank, f"r{i:05d}") for rank, i in enumerate(rows[np.lexsort((rows, -s[rows]))][:n], 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("k", [None, 1, 4])
def test_hits_are_those_of_the_cells_probed(built, records, vectors, monkeypatch, k, small):
    if small:  # cells in parts, lines and columns of few
        for name, value in {"ROWS": 16, "QUERIES": 8, "COLUMN": 200, "LINE": 25, "COLUMNS": 3, "GIVEN": 50}.items():
            monkeypatch.setattr(index, name, value, raising=False)
    got = index.nearest_many(built, asked(records, 15), 12, probes=k, exact=k is None)
    assert sorted((r["query_id"], r["rank"], r["id"]) for r in got.collect()) == told(built, vectors, 15, 12, k)


def test_queries_are_not_moved_once_for_each_cell(spark, built, records):
    moved = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    queries = asked(records, 1)
    given = 1500 * 12 * 4  # bytes of the rows; queries are as many
    for exact in (True, False):
        before = moved()
        assert index.nearest_many(built, queries, 2, probes=15, exact=exact).count() == 3000
        assert 0 < moved() - before < 15 * given


def test_numbers_and_doubles(spark, vectors):
    """Ids of numbers are in order of numbers, and doubles aren't cut to floats."""
    rows = [(int(i), [1.0, 1e-9 * i]) for i in range(60)] + [(100 - i, [1.0, -1.0]) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, embedding array<double>")
    small = index.build(df, cells=2, probes=1)
    got = index.nearest_many(small, df.where("id = 95").select(F.col("id").cast("string").alias("query_id"), F.col("embedding").cast("array<float>").alias("vector")), 5, exact=True)
    assert got.dtypes == [("query_id", "string"), ("rank", "int"), ("id", "int"), ("similarity", "double")]
    assert [(r["query_id"], r["id"]) for r in got.orderBy("rank").collect()] == [("95", i) for i in range(89, 94)]
