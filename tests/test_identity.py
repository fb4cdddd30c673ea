"""Centroids, assignment, conflicts, and how identity is stamped, carried and repaired."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkmill.functions import vectors as V
from talkmill.operators import cluster, evaluate, identity

KEYS = ["ep"]
A = [1.0, 0.0, 0.0]


def centroid(spark, rows):
    df = spark.createDataFrame(rows, "k int, vector array<double>, w double")
    return V.centroids(df, ["k"], "vector", "w").first()


def test_centroid_has_unit_length_and_follows_weights(spark):
    even, heavy = centroid(spark, [(1, [3.0, 4.0], 1.0), (1, [0.0, 1.0], 1.0)])["centroid"], centroid(spark, [(1, [1.0, 0.0], 9.0), (1, [0.0, 1.0], 1.0)])["centroid"]
    assert math.isclose(math.hypot(*even), 1) and heavy[0] > 0.99


@pytest.mark.parametrize("rows", [[(1, [1.0], 0.0)], [(1, [1.0], 1.0), (1, [1.0, 2.0], 1.0)], [(1, [1.0], 1.0), (1, [-1.0], 1.0)]])
def test_centroid_refuses(spark, rows):
    with pytest.raises(Exception, match="positive|differ|length"):
        centroid(spark, rows)


def test_person_centroids_use_voices_alone(spark):
    labels = spark.createDataFrame([("a1", "Ines", "voice"), ("b1", "Omar", "voice"), ("c", "Lena", "context"), ("s", None, "skipped"), ("gone", "Ann", "voice")], "clip_id string, person string, basis string")
    vecs = spark.createDataFrame([("a1", A), ("b1", [0.0, 1.0, 0.0]), ("c", [0.0, 1.0, 0.0]), ("s", A)], "clip_id string, vector array<double>")
    assert {r["person"] for r in identity.person_centroids(labels, vecs).collect()} == {"Ines", "Omar"}


TWO = [("Ines", A), ("Omar", [0.0, 1.0, 0.0])]


@pytest.mark.parametrize(
    "vector, people, threshold, margin, expected",
    [
        ([0.99**0.5, 0.01**0.5, 0.0], TWO, 0.5, 0.1, "Ines"),
        ([0.99**0.5, 0.01**0.5, 0.0], TWO, 0.999, 0.0, None),
        ([0.5**0.5, 0.5**0.5, 0.0], TWO, 0.5, 0.05, None),
        (A, TWO[:1], 0.9, 0.5, "Ines"),
        ([3.0, 4.0, 0.0], TWO[:1], 0.8, 0.0, None),
        ([7 * 0.99**0.5, 7 * 0.01**0.5, 0.0], TWO, 0.5, 0.1, "Ines"),
        ([3.0, 4.0, 0.0], TWO[:1], 0.6, 0.0, "Ines"),
        ([1.0, 1.0, 0.0], TWO, 0.5, 0.0, "Ines"),
    ],
)
def test_assign(spark, vector, people, threshold, margin, expected):
    v = spark.createDataFrame([(1, vector)], "k int, vector array<double>")
    p = spark.createDataFrame(people, "person string, centroid array<double>")
    assert identity.assign(identity.score(v, p, ["k"]), ["k"], threshold, margin).first()["person"] == expected


def test_no_people_assign_nobody(spark):
    v = spark.createDataFrame([(1, A)], "k int, vector array<double>")
    p = spark.createDataFrame([], "person string, centroid array<double>")
    assert identity.score(v, p, ["k"]).collect() == []


def test_a_vector_without_length_raises_in_scores_and_counts_zero_in_probes(spark):
    v = spark.createDataFrame([(1, [0.0, 0.0, 0.0])], "k int, vector array<double>")
    p = spark.createDataFrame(TWO, "person string, centroid array<double>")
    with pytest.raises(Exception, match="no length"):
        identity.score(v, p, ["k"]).collect()
    assert v.select(V.cosine(F.col("vector"), F.array(*map(F.lit, A))).alias("c")).first()["c"] == 0.0


def test_conflicts(spark):
    df = spark.createDataFrame([("ep1", "00", "JS"), ("ep1", "01", "JS"), ("ep2", "00", "JS"), ("ep3", "00", None), ("ep3", "01", None)], "episode string, cluster string, person string")
    assert [tuple(r) for r in identity.conflicts(df).collect()] == [("ep1", "JS", ["00", "01"])]


def test_duration_weights_decide(spark):
    crops = spark.createDataFrame([("e", "C", 150.0, [1.0, 0.0]), ("e", "C", 30.0, [0.0, 1.0]), ("e", "C", 99.0, None)], "episode string, cluster string, turn_duration_s double, vector array<double>")
    p = spark.createDataFrame([("Alice", [1.0, 0.0]), ("Bob", [0.6, 0.8])], "person string, centroid array<double>")
    c = identity.cluster_centroids(crops)
    assert identity.assign(identity.score(c, p, ["episode", "cluster"], "centroid"), ["episode", "cluster"], 0.516, 0.074).first()["person"] == "Alice"


REC = "ep string, id string, speaker string, speaker_id string, identity_version string, source string"


def records(spark, rows):
    return spark.createDataFrame(rows, REC)


def ident(spark, rows):
    return spark.createDataFrame(rows, "ep string, speaker string, person string")


def test_stamp_withholds_on_a_broken_join(spark):
    rows = records(spark, [("e", "e-0", "SPEAKER_00", None, None, None), ("f", "f-0", "SPEAKER_09", None, None, None), ("g", "g-0", "SPEAKER_00", None, None, None)])
    got = {r["id"]: (r["speaker_id"], r["identity_version"]) for r in identity.stamp(rows, ident(spark, [("e", "SPEAKER_00", "Ann"), ("f", "SPEAKER_00", "Ann")]), "1@1", KEYS).collect()}
    assert got == {"e-0": ("Ann", "1@1"), "f-0": (None, None), "g-0": (None, "1@1")}
    assert {r["identity_version"] for r in identity.stamp(rows, ident(spark, [("e", "SPEAKER_00", "Ann")]), None, KEYS).collect()} == {None}


def test_carry(spark):
    stored = records(spark, [("e", "e-0", "SPEAKER_00", "Ann", None, None), ("e", "e-1", "SPEAKER_00", None, None, None), ("e", "e-2", "SPEAKER_01", None, None, None), ("c", "c-0", "SPEAKER_00", "Ann", None, None), ("c", "c-1", "SPEAKER_00", "", None, None), ("b", "b-0", "SPEAKER_00", "Ann", None, "book")])
    fresh = records(spark, [(e, f"{e}-n{i}", s, None, None, None) for e, i, s in (("e", 0, "SPEAKER_00"), ("e", 1, "SPEAKER_01"), ("e", 2, "UNKNOWN"), ("c", 0, "SPEAKER_00"), ("b", 0, "SPEAKER_00"))])
    got = {r["id"]: (r["speaker_id"], r["identity_version"]) for r in identity.carry(stored, fresh, "1@1", KEYS).collect()}
    assert got == {"e-n0": ("Ann", "1@1"), "e-n1": (None, "1@1"), "e-n2": (None, "1@1"), "c-n0": (None, None), "b-n0": (None, None)}
    v = {r["ep"]: (r["refused"], r["unmapped"]) for r in identity.carry_verdicts(stored, fresh, KEYS).collect()}
    assert v == {"e": ([], []), "c": (["SPEAKER_00"], []), "b": ([], ["SPEAKER_00"])}


def test_repair(spark):
    rows = records(spark, [("e", "e-0", "SPEAKER_00", None, None, None), ("e", "e-1", "SPEAKER_01", "", None, None), ("e", "e-2", "SPEAKER_00", "Alice", None, None), ("e", "e-b", "SPEAKER_01", "Zoe", None, "book"), ("x", "x-0", "SPEAKER_01", "Bob", None, None), ("y", "y-0", "SPEAKER_05", None, None, None), ("z", "z-0", "SPEAKER_00", "Bob", None, None)])
    i = ident(spark, [("e", "SPEAKER_00", "Alice"), ("x", "SPEAKER_00", "Alice"), ("x", "SPEAKER_01", "Alice"), ("y", "SPEAKER_00", "Alice"), ("none", "SPEAKER_00", "Alice")])
    assert {r["ep"]: r["reason"] for r in identity.repair_refusals(rows, i, KEYS).collect()} == {"e": None, "x": "contradiction", "y": "broken_join", "none": "no_records", "z": "contradiction"}
    assert {r["id"]: r["speaker_id"] for r in identity.repair_updates(rows, i, "1@1", KEYS).collect()} == {"e-0": "Alice", "e-1": None, "e-2": "Alice"}


def test_version_is_withheld_over_stored_names(spark):
    stored = records(spark, [("e", "e-0", "SPEAKER_00", "Ann", None, None), ("f", "f-0", "SPEAKER_00", "", None, None)])
    got = identity.version_to_write(spark.createDataFrame([("e",), ("f",), ("g",)], "ep string"), stored, "1@1", KEYS)
    assert {r["ep"]: r["identity_version"] for r in got.collect()} == {"e": None, "f": "1@1", "g": "1@1"}


def test_pairs_and_groups_equal_brute_force(spark):
    import random

    r = random.Random(2)
    rows = [(i, [r.gauss(0, 1) + (i % 9 == k) * 3 for k in range(8)]) for i in range(130)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (math.hypot(*a) * math.hypot(*b))
    want = {(i, j) for i, a in rows for j, b in rows if i < j and cos(a, b) >= 0.8}
    cluster.BLOCK, old = 32, cluster.BLOCK
    got = {(p["a"], p["b"]) for p in cluster.similar_pairs(df, "k", "v", 0.8).collect()}
    cluster.BLOCK = old
    assert got == want and want
    root = {i: i for i, _ in rows}
    for a, b in sorted(want) * 8:
        root[a] = root[b] = min(root[a], root[b])
    edges = spark.createDataFrame(sorted(want), "a long, b long")
    assert {x["k"]: x["component"] for x in cluster.groups(df, "k", edges).collect()} == root


@pytest.mark.parametrize(("threshold", "spread"), [(0.95, 0.02), (0.5, 0.1), (0.0, 0.05), (-0.5, 0.05), (1.0, 0.0)])
def test_pruned_pairs_equal_all_pairs(spark, monkeypatch, threshold, spread):
    """Clusters, one of them with a third of the rows; equal vectors, none, one without length."""
    monkeypatch.setattr(cluster, "BLOCK", 16)
    r = np.random.default_rng(3)
    middles = r.normal(size=(12, 16))
    x = middles[np.where(np.arange(300) % 3 == 0, 0, np.arange(300) % 12)] + spread * r.normal(size=(300, 16))
    x[5:9] = x[4]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 12)
    got = {(p["a"], p["b"]) for p in cluster.similar_pairs(df, "k", "v", threshold - 1e-9).collect()}
    assert got == {(i, j) for i in range(300) for j in range(i + 1, 300) if s[i, j] >= threshold} and got
    assert cluster.similar_pairs(df.where("k >= 900"), "k", "v", threshold).collect() == []


def test_few_blocks_meet_on_clusters(spark, monkeypatch):
    monkeypatch.setattr(cluster, "BLOCK", 32)
    r = np.random.default_rng(4)
    middles = r.normal(size=(60, 32))
    df = spark.createDataFrame([(i, (middles[i % 60] + 0.1 * r.normal(size=32)).tolist()) for i in range(2400)], "k long, v array<double>")
    blocks = cluster.laid_in_blocks(df, "k", "v", 0.9)
    n, met = blocks.count(), cluster.block_pairs(blocks, 0.9).count()
    assert n >= 60 and n <= met < 0.1 * n * (n + 1) / 2, (n, met)


def shuffled(spark):
    """Bytes so far, once all listeners have heard of them."""
    time.sleep(0.5)
    spark.range(1).count()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()


def test_vectors_are_not_sent_once_for_each_block_that_they_meet(spark, monkeypatch):
    """All blocks meet, with keys that are there twice, and text keys; what is shuffled is so many times the vectors as there are groups."""
    monkeypatch.setattr(cluster, "BLOCK", 16)
    monkeypatch.setattr(cluster, "GROUPS", 4, raising=False)
    monkeypatch.setattr(cluster, "PRODUCT", 2000, raising=False)
    n, dim = 2400, 32
    x = np.random.default_rng(6).normal(size=(n, dim))
    df = spark.createDataFrame([(f"k{i % (n - 5)}", v.tolist()) for i, v in enumerate(x)], "k string, v array<double>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    before = shuffled(spark)
    got = {(p["a"], p["b"]): p["similarity"] for p in cluster.similar_pairs(df, "k", "v", 0.5).collect()}
    sent = shuffled(spark) - before
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T
    want = {}
    for i, j in zip(*np.nonzero(np.triu(s, 1) >= 0.5)):
        pair = tuple(sorted((f"k{i % (n - 5)}", f"k{j % (n - 5)}")))
        if pair[0] != pair[1]:
            want[pair] = max(s[i, j], want.get(pair, -1))
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert sent < 12 * n * dim * 8, sent


def test_partitions_hand_on_forests():
    import pyarrow as pa

    edges = [(i, j) for i in range(40) for j in range(i)] + [(100, 101), (101, 100), (7, 7)]
    batches = [pa.RecordBatch.from_arrays([pa.array([e[0] for e in part]), pa.array([e[1] for e in part])], ["u", "v"]) for part in (edges[:300], edges[300:])]
    assert sum(b.num_rows for b in cluster._forest(iter(batches))) == 39 + 1


def test_leave_one_out_skips_singletons(spark):
    rows = [("a1", "A", [1.0, 0.1]), ("a2", "A", [1.0, -0.1]), ("b1", "B", [0.0, 1.0]), ("b2", "B", [0.1, 1.0]), ("c", "C", [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "clip_id string, person string, vector array<double>")
    r = evaluate.leave_one_out(df, 0.5, 0.1).first()
    assert (r["scored"], r["correct"], r["skipped"], r["accuracy"]) == (4, 4, 1, 1.0)


def test_offset_scan_finds_the_ratio(spark):
    turns = spark.createDataFrame([("e", i, "AB"[i % 2], i * 10.0, 10.0) for i in range(40)], "episode string, turn_idx long, speaker string, start double, duration_s double")
    refs = spark.createDataFrame([("e", "A", [1.0, 0.0]), ("e", "B", [0.0, 1.0])], "episode string, cluster string, centroid array<double>")
    crops = spark.createDataFrame([(i, "e", s, [1.0, 0.0] if int(s * 0.5 // 10) % 2 == 0 else [0.0, 1.0]) for i, s in enumerate(x * 13.0 + 1 for x in range(30))], "crop_id int, episode string, crop_start_s double, vector array<double>")
    out = {r["r"]: r for r in evaluate.offset_scan(crops, turns, refs, [1.0, 0.75, 0.5]).collect()}
    assert out[0.5]["accuracy"] == 1.0 and out[0.5]["peak"] and not out[1.0]["peak"]


@pytest.mark.parametrize("few", [True, False])
def test_vectors_are_assigned_like_their_scores(spark, monkeypatch, few):
    import random

    r = random.Random(5)
    v = spark.createDataFrame([(i, [r.choice([-1.0, 0.5, 1.0]), r.choice([0.5, 1.0])]) for i in range(60)], "k int, vector array<double>")
    p = spark.createDataFrame([(n, [x, y]) for n, x, y in [("b", 1.0, 0.0), ("a", 1.0, 0.0), ("c", 0.0, 1.0), ("d", -0.6, 0.8)]], "person string, centroid array<double>")
    if not few:
        monkeypatch.setattr(identity, "MAX_BYTES", 8)
    for people in (p, p.where("person = 'c'"), p.where("person = 'x'")):
        want = identity.assign(identity.score(v, people, ["k"]), ["k"], 0.7, 0.1)
        assert sorted(map(tuple, identity.assign_vectors(v, people, ["k"], 0.7, 0.1).collect())) == sorted(map(tuple, want.collect()))


def test_sums_of_single_precision_in_other_orders(spark):
    """Stored vectors have 24 bits, sums 53: whatever order rows come in, centroids and scores agree far below the tolerance that copies are compared with, though sums of single precision would not."""
    r = np.random.default_rng(6)
    x = (r.normal(size=(4000, 6)) * 10.0 ** r.integers(-3, 4, (4000, 1))).astype(np.float32)
    found = []
    for order in (np.arange(4000), np.arange(4000)[::-1], r.permutation(4000)):
        df = spark.createDataFrame([(1, x[i].tolist(), 1.0) for i in order], "k int, vector array<float>, w double").repartition(3)
        found.append(np.array(V.centroids(df, ["k"], "vector", "w").first()["centroid"]))
    exact = x.astype(float).sum(axis=0)
    exact /= np.linalg.norm(exact)
    assert all(np.abs(c - exact).max() < 1e-12 for c in found)
    single = np.zeros(6, np.float32)
    for row in x:
        single += row
    assert np.abs(single / np.linalg.norm(single) - exact).max() > 1e-9
    close = spark.createDataFrame([(found[0].tolist(), found[1].tolist())], "a array<double>, b array<double>").select(V.all_close(F.col("a"), F.col("b"), 0.0).alias("ok")).first()["ok"]
    assert close
