"""The vector index beside a scan of all records."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkmill.operators import index, search

SCHEMA = "id string, embedding array<float>, show string, date string, date_ts int, speaker_id string, cell int"


def clustered(n=3000, groups=60, dim=24, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(groups, dim))[np.arange(n) % groups if seed else 0] + 0.15 * r.normal(size=(n, dim))
    return x.astype(np.float32)


@pytest.fixture(scope="module")
def vectors():
    return clustered()


@pytest.fixture(scope="module")
def records(spark, vectors):
    rows = [(f"r{i:05d}", v.tolist(), f"S{i % 7}", "2024-01-01", 20240101 + i % 5, None, i) for i, v in enumerate(vectors)]
    rows += [("none", None, "S1", None, 0, None, 0), ("short", [1.0], "S1", None, 0, None, 0), ("flat", [0.0] * 24, "S1", None, 0, None, 0), ("hole", [None] * 24, "S1", None, 0, None, 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def built(records):
    return index.build(records)


def brute(vectors, query, n):
    x = vectors.astype(float)
    s = np.round(x @ query / (np.linalg.norm(x, axis=1) * np.linalg.norm(query)), 9)
    return [f"r{i:05d}" for i in np.lexsort((np.arange(len(x)), -s))[:n]]


def test_every_row_is_in_a_cell_and_few_cells_are_probed(built, records):
    assert built.table.count() == records.count() == sum(built.sizes.values()) and built.sizes[index.ASIDE] == 4
    assert built.table.columns[:-1] == records.columns and built.cell == "cell_"
    assert len(built.sizes) > 30 and built.probes <= len(built.sizes) // 4
    plan = built.within([3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell_#" in plan and "IN (3,5,-1)" in plan.replace("INSET", "IN").replace(" ", "").replace("IN(3,5,-1)", "IN (3,5,-1)")


def test_probes_are_the_least_that_reach_the_target(built, records):
    rows = records.where("id like 'r%'").orderBy(F.xxhash64("id"), "id").limit(index.ASKED).select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))
    exact = index.nearest_many(built, rows, 10, exact=True)
    at = index.tuned(built, 0.9)
    assert index.recall(index.nearest_many(built, rows, 10, probes=at), exact) >= 0.9
    assert at == 1 or index.recall(index.nearest_many(built, rows, 10, probes=at - 1), exact) < 0.9
    assert index.tuned(built, 1.0) >= built.probes >= at


def test_recall_and_exact_search(built, records, vectors):
    r = np.random.default_rng(9)
    got = 0
    for i in r.integers(0, 3000, 12):
        query = (vectors[i] + 0.1 * r.normal(size=24)).tolist()
        want = brute(vectors, np.array(query), 10)
        got += len({x["id"] for x in index.indexed(built, query, 10).collect()} & set(want))
        assert [x["id"] for x in index.indexed(built, query, 10, probes=1, exact=True).collect()] == want == [x["id"] for x in search.nearest(records.where("size(embedding) = 24 and embedding[0] is not null and id != 'flat'"), query, 10).collect()]
    assert got >= 0.99 * 120


def test_far_queries_are_exact_too(built, vectors):
    for query in ([1.0] * 24, (-vectors[0]).tolist()):
        assert [x["id"] for x in index.indexed(built, query, 25, probes=1, exact=True).collect()] == brute(vectors, np.array(query), 25)


def test_filters_lose_no_hits(built, records, vectors):
    query = vectors[8].tolist()
    tree = {"$and": [{"show": {"$eq": "S3"}}, {"date_ts": {"$gte": 20240103}}]}
    want = [x["id"] for x in search.nearest(records.where("embedding is not null and size(embedding) = 24"), query, 40, tree).collect()]
    assert len(want) == 40 and [x["id"] for x in index.indexed(built, query, 40, tree, probes=1, exact=True).collect()] == want
    assert len(index.indexed(built, query, 40, tree, probes=1).collect()) == 40
    assert index.indexed(built, query, 5, {"show": "nowhere"}).collect() == []


def test_many_queries_at_once(built, records, vectors):
    asked = records.where("id like 'r%' and cast(substr(id, 2) as int) % 20 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))
    asked = asked.unionByName(records.where("id = 'none' or id = 'flat' or id = 'short'").select(F.col("id").alias("query_id"), F.col("embedding").alias("vector")))
    exact = index.nearest_many(built, asked, 10, exact=True)
    rows = {}
    for x in sorted(exact.collect(), key=lambda x: x["rank"]):
        rows.setdefault(x["query_id"], []).append(x["id"])
    assert rows == {f"r{i:05d}": brute(vectors, vectors[i].astype(float), 10) for i in range(0, 3000, 20)}
    assert index.recall(index.nearest_many(built, asked, 10), exact) >= 0.99
    assert index.recall(index.nearest_many(built, asked.limit(0), 10), exact.limit(0)) == 1.0


def test_an_index_is_read_back(spark, built, vectors):
    again = index.load(spark, built.at, probes=built.probes)
    query = vectors[77].tolist()
    assert [x["id"] for x in index.indexed(again, query, 7).collect()] == [x["id"] for x in index.indexed(built, query, 7).collect()]
    held = index.load(spark, built.at, probes=built.probes).resident()
    assert [x["id"] for x in index.indexed(held, query, 7).collect()] == [x["id"] for x in index.indexed(built, query, 7).collect()]
    held.table.unpersist()
    assert search.search(again, query, 5, show="S0").columns == search.search(again.table.drop("cell_"), query, 5, show="S0").columns


def test_small_and_empty_tables(spark, records):
    for part in (records.limit(0), records.where("id = 'none'"), records.where("id = 'r00001'")):
        small = index.build(part)
        assert [x["id"] for x in index.indexed(small, [1.0] * 24, 3).collect() if x["id"] != "none"] == [x["id"] for x in part.where("id != 'none'").collect()]
        assert index.nearest_many(small, part.select(F.col("id").alias("query_id"), F.col("embedding").alias("vector")), 3, exact=True).count() == part.where("id != 'none'").count()


def test_an_index_reaches_its_target_on_other_queries(spark):
    """On vectors without clusters, where each cell adds little."""
    x = np.random.default_rng(3).normal(size=(4000, 24))
    records = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>")
    built = index.build(records, target=0.95)
    assert built.probes > index.tuned(built, 0.95)
    asked = records.where("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))
    assert index.recall(index.nearest_many(built, asked, 10), index.nearest_many(built, asked, 10, exact=True)) >= 0.95


def test_queries_go_to_their_cells_in_pieces():
    """Ten thousand queries that probe all of a thousand cells aren't copied at once."""
    import pyarrow as pa

    x = np.random.default_rng(2).normal(size=(500, 8))
    pivots = np.random.default_rng(5).normal(size=(900, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(x.tolist())], ["id", "v"])
    n, seen = 0, set()
    for b in index._probed(iter([batch]), pivots, np.arange(0, 900, 3), 300):
        assert b.num_rows <= index.COPIES
        n += b.num_rows
        seen |= set(zip(b.column(0).to_pylist(), b.column(2).to_pylist()))
    assert n == len(seen) == 500 * 300
    (first,) = index._probed(iter([batch.slice(0, 1)]), pivots, np.arange(900), 1)
    assert first.column(2).to_pylist() == [int((pivots @ x[0]).argmax())]
