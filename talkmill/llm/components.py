"""Connected components of a graph that may not fit on one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of a batch; each id is then linked to the least of its set, so that a partition hands on a forest."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.stack([batch.column(i).to_numpy() for i in (0, 1)])
        ids, at = np.unique(ends, return_inverse=True)
        root = list(range(len(ids)))

        def find(x: int, root: list[int] = root) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in zip(*at.reshape(2, -1).tolist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        top = np.array([find(x) for x in range(len(ids))])
        loose = top != np.arange(len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids[top[loose]]), pa.array(ids[loose])], ["a", "b"])


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component_id: least id reachable) for each id in the links (a, b), both long; links may repeat and go either way. No links give no rows.

    Partitions first contract their links by union-find. Rounds of large-star and small-star then join each id's neighbours to the least of them, until each id hangs from the least of its component: of the order of log n rounds. Each round is written, so that a lost executor costs one round; drop_written() deletes the table that the result is read from.
    """
    common.ready(links.sparkSession)
    edges = links.select("a", "b").where("a is not null and b is not null and a != b").mapInArrow(common.lean(_forest), "a long, b long")
    edges = common.written(edges.distinct(), "edges")
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a != b").distinct()
        large = common.written(large, "large")
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(down, "b")
        small = joined.select(F.col("m").alias("a"), "b").union(joined.select("m", "a").toDF("a", "b")).where("a != b").distinct()
        following = common.written(small, "edges")
        # stars: no id is both above and below
        settled = following.select("a").distinct().join(following.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty() and following.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
        common.drop_written(edges)
        common.drop_written(large)
        edges = following
        if settled:
            break
    else:
        raise RuntimeError("components did not settle")
    out = edges.select(F.col("b").alias("id"), F.col("a").alias("component_id")).union(edges.select("a", "a").distinct())
    out._talkmill_at = edges._talkmill_at
    return out
