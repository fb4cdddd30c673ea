"""Hard negatives: scores stay in the cells of the grid that make them."""

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_vectors import mined

from talkmill.functions.best import Best
from talkmill.llm import common, mining


@pytest.mark.parametrize("most", [100_000, 100_000_000])  # in doubles, beyond 2**53
def test_scores_are_neither_shuffled_nor_written(spark, monkeypatch, most):
    """In many lines and columns, with ids dealt unevenly and labels of any frequency, all that moves is a part of the scores' bytes."""
    for name, value in {"ANCHORS": 32, "ROWS": 64, "COLUMN": 4, "LINE": 100, "CHUNK": 3}.items():
        monkeypatch.setattr(mining, name, value, raising=False)
    tables, kept = [], common.written

    def written(df, name):
        out = kept(df, name)
        at = Path(out._talkmill_at.removeprefix("file://"))
        tables.append(sum(os.path.getsize(p) for p in at.glob("*.parquet")))
        return out

    monkeypatch.setattr(common, "written", written)
    draw = random.Random(most)
    given = [(i, draw.choice([1, 1, 1, 2, 3]), [draw.randint(-most // 4, most) for _ in range(4)]) for i in range(900)]
    df = spark.createDataFrame(given, "vec_id long, label int, x array<long>").repartition(3)
    moved = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = moved()
    out = mining.mine(df, anchors=F.col("vec_id") % 3 == 0, positives=2, negatives=2)
    assert sorted(map(tuple, out.collect())) == mined(given, lambda i: i % 3 == 0, 2, 2)
    assert 0 < moved() - before < 900 * 300 * 4 and 0 < sum(tables) < 900 * 300 * 4  # half of the scores


def test_the_best_of_what_was_offered():
    import numpy as np

    for kind, id_kind in ((np.int64, np.int64), (float, object)):
        draw, best, offered = np.random.default_rng(4), Best(5, 3, kind, id_kind), [[] for _ in range(5)]
        for block in range(12):
            scores = draw.integers(-4, 4, (4, 100)) if kind is np.int64 else draw.normal(size=(4, 100)) * 1e-8
            ids = block * 100 + draw.permutation(100)
            ids = ids if id_kind is np.int64 else np.array([f"r{i:04d}" for i in ids], object)
            wanted = draw.random((4, 100)) < (0.01 if block < 4 else 0.9)
            best.offer_tile(np.arange(4), scores, ids, wanted, None if kind is np.int64 else 9)
            for i, j in zip(*np.nonzero(wanted)):
                offered[i].append((-scores[i, j] if kind is np.int64 else -np.round(scores[i, j], 9), ids[j]))
        want = [(i, -score, id_) for i in range(5) for score, id_ in sorted(offered[i])[:3]]  # nothing was offered to the last
        assert list(zip(*(x.tolist() for x in best.rows()))) == want
