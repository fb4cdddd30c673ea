"""Pairs of similar vectors, and the groups that they form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import unit
from ..session import drop_written, prepared, written
from . import cells

#: Vectors in a block, about.
BLOCK = 512
#: Pivots to which each block's least and largest angles are kept, at most.
SEEN_FROM = 32
#: Groups that blocks are dealt to, and numbers that a group may hold; above that there are more groups.
GROUPS, HELD = 16, 4 << 20
#: Numbers of a product that are held at a time.
PRODUCT = 4 << 20
#: Angles that differ by less may be equal: cosines are rounded.
SLACK = 1e-6


def laid_in_blocks(vectors: DataFrame, key: str, vector: str, threshold: float) -> DataFrame:
    """block, cell, ring, rows (structs k, v of unit vectors, sorted), lo and hi (the least and largest angle to the own pivot), los and his (to each of SEEN_FROM pivots). Written.

    Cells lie around pivots; a cell's rows go by rings of their angle to the pivot, half as wide as the angle that the threshold allows, and rings larger than BLOCK by a hash of the key. So blocks are small whatever keys or places are frequent.
    """
    spark = prepared(vectors.sparkSession)
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(key).alias("k"), unit(F.col(vector)).alias("v")).where("v[0] is not null")
    rows = written(rows, "vectors")
    pivots = cells.fit_pivots(rows, "k", "v", max(1, -(-rows.count() // BLOCK)))
    reach = max(float(np.arccos(min(1.0, max(-1.0, threshold)))) / 2, 0.02)
    placed = written(cells.with_cells(rows, "v", pivots).withColumn("ring", F.floor(F.col("apart") / reach).cast("int")), "placed") if len(pivots) else spark.createDataFrame([], rows.withColumns({"cell": F.lit(0), "apart": F.lit(0.0), "ring": F.lit(0)}).schema)
    parts = placed.groupBy("cell", "ring").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    name = F.struct("cell", "ring", F.pmod(F.xxhash64("k"), F.col("parts")).alias("part"))
    packed = placed.join(parts, ["cell", "ring"]).groupBy(name.alias("block"), "cell", "ring").agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("rows"), F.min("apart").alias("lo"), F.max("apart").alias("hi"))
    seen = pivots[:SEEN_FROM]

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [pa.array([], pa.list_(pa.float64()))] * 2
            if batch.num_rows:
                each = [cells.angle(r.values.field("v").flatten().to_numpy(zero_copy_only=False).reshape(len(r.values), -1) @ seen.T) for r in batch.column(3)]
                lists = [pa.array([getattr(x, f)(axis=0) for x in each], pa.list_(pa.float64())) for f in ("min", "max")]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, "los", "his"])

    schema = packed.withColumns({"los": F.array(F.lit(0.0)), "his": F.array(F.lit(0.0))}).schema
    blocks = written(packed.mapInArrow(ranges, schema), "blocks")
    drop_written(rows)
    if len(pivots):
        drop_written(placed)
    blocks._pivots = pivots
    return blocks


def block_pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """The pairs of blocks (i <= j) that can hold a pair of vectors at the threshold, by the triangle inequality of angles: seen from a pivot, two vectors are at least as far apart as their angles to it differ. First cells are compared, by their pivots' distance, of which there are few; then the blocks of those that remain."""
    far = float(np.arccos(min(1.0, max(-1.0, threshold)))) + SLACK
    pivots = blocks._pivots
    between = cells.angle(pivots @ pivots.T) if len(pivots) else np.empty((0, 0))
    reach = blocks.groupBy("cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()  # one row for each pivot
    near = [(a["cell"], b["cell"]) for a in reach for b in reach if max(between[a["cell"], b["cell"]] - a["hi"] - b["hi"], a["lo"] - between[a["cell"], b["cell"]] - b["hi"], b["lo"] - between[a["cell"], b["cell"]] - a["hi"]) <= far]
    near = blocks.sparkSession.createDataFrame(near, "cell_i int, cell_j int")
    i, j = (blocks.select(*(F.col(c).alias(f"{c}_{x}") for c in ("block", "cell", "lo", "hi", "los", "his"))) for x in "ij")
    met = i.join(F.broadcast(near), "cell_i").join(j, "cell_j").where("block_i <= block_j")  # of MOST squared rows at most
    rings = (F.col("cell_i") != F.col("cell_j")) | ((F.col("lo_i") - F.col("hi_j") <= far) & (F.col("lo_j") - F.col("hi_i") <= far))
    apart = F.exists(F.zip_with("los_i", "his_j", lambda lo, hi: lo - hi > far), lambda x: x) | F.exists(F.zip_with("los_j", "his_i", lambda lo, hi: lo - hi > far), lambda x: x)
    return met.where(rings & ~apart).select("block_i", "block_j")


def _products(blocks: list[tuple], threshold: float) -> Iterator[pa.RecordBatch]:
    """The pairs x, y, similarity at the threshold of blocks (name, keys, matrix, names of blocks to meet), each block's vectors against those of all that it meets, PRODUCT numbers at a time."""
    at = {name: i for i, (name, *_) in enumerate(blocks)}
    for name, keys, a, others in blocks:
        met = sorted(at[x] for x in others)
        step = max(1, PRODUCT // max(1, len(a)))
        while met:
            n, size = 0, 0
            while n < len(met) and (not n or size + len(blocks[met[n]][2]) <= step):
                size += len(blocks[met[n]][2])
                n += 1
            some, met = [blocks[i] for i in met[:n]], met[n:]
            s = a @ np.concatenate([x[2] for x in some]).T
            from_ = 0
            for other, _, b, _ in some:
                if other == name:  # each pair once
                    s[:, from_ : from_ + len(b)][np.tri(len(a), dtype=bool)] = -2
                from_ += len(b)
            x, y = np.nonzero(s >= threshold)
            if len(x):
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(x)), pa.concat_arrays([o[1] for o in some]).take(pa.array(y)), pa.array(s[x, y])], ["x", "y", "similarity"])


def similar_pairs(vectors: DataFrame, key: str, vector: str, threshold: float) -> DataFrame:
    """Exact theta join: (a, b, similarity) for keys a < b whose cosine is threshold or more.

    Vectors lie in blocks around pivots (laid_in_blocks); only blocks that can hold a pair by block_pairs are multiplied as matrices. Blocks are dealt to groups, and two groups meet in one task: a vector is sent to as many tasks as there are groups, GROUPS unless these would hold more than HELD numbers, and not once for each block that it meets. Memory holds two groups, whatever the input. On vectors in clusters few blocks meet; on vectors that spread evenly in many dimensions, all do.
    """
    blocks = laid_in_blocks(vectors, key, vector, threshold)
    kind = blocks.schema["rows"].dataType.elementType["k"].dataType.simpleString()
    size = blocks.agg(F.coalesce(F.sum(F.size("rows")), F.lit(0)).alias("n"), F.coalesce(F.max(F.size(F.col("rows")[0]["v"])), F.lit(0)).alias("dim")).first()
    n = max(1, min(GROUPS, -(-size["n"] // (4 * BLOCK))), -(-size["n"] * size["dim"] // HELD))
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(n))
    near = written(block_pairs(blocks, threshold), "near")
    near = near.withColumn("task", F.least(group("block_i"), group("block_j")) * n + F.greatest(group("block_i"), group("block_j")))
    roles = near.select("task", F.col("block_i").alias("block"), F.col("block_j").alias("other")).unionByName(near.select("task", F.col("block_j").alias("block"), F.lit(None).alias("other")))
    roles = roles.groupBy("task", "block").agg(F.collect_list("other").alias("others"))
    flat = blocks.select("block", F.transform("rows", lambda r: r["k"]).alias("k"), F.flatten(F.transform("rows", lambda r: r["v"])).alias("v"))
    sent = roles.join(flat, "block").repartition(n * (n + 1) // 2, "task").sortWithinPartitions("task").select("task", "block", "others", "k", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, []
        for batch in batches:
            tasks, names, others = (batch.column(i).to_pylist() for i in range(3))
            for i in range(batch.num_rows):
                if tasks[i] != task:
                    yield from _products(held, threshold)
                    task, held = tasks[i], []
                keys = batch.column(3)[i].values
                rows = batch.column(4)[i].values.to_numpy(zero_copy_only=False).reshape(len(keys), -1)
                held.append((tuple(names[i].values()), keys, rows, [tuple(x.values()) for x in others[i]]))
        yield from _products(held, threshold)

    found = sent.mapInArrow(run, f"x {kind}, y {kind}, similarity double")
    pairs = found.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")
    keys = blocks.select(F.explode("rows.k").alias("k"))
    if keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return pairs
    return pairs.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def similar_pairs_within(vectors: DataFrame, keys: list[str], key: str, vector: str, threshold: float) -> DataFrame:
    """The same among rows with equal keys, as an equi join with a condition; for groups that are small by nature."""
    from ..functions.vectors import cosine

    a = vectors.select(*keys, F.col(key).alias("a"), F.col(vector).alias("va"))
    b = vectors.select(*keys, F.col(key).alias("b"), F.col(vector).alias("vb"))
    return a.join(b, keys).where("a < b").select(*keys, "a", "b", cosine(F.col("va"), F.col("vb")).alias("similarity")).where(F.col("similarity") >= threshold)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges u, v of a partition without those that join what earlier ones have joined: fewer than the nodes that it has seen, which is also what it holds."""
    at: dict = {}
    root: list[int] = []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        if not batch.num_rows:
            continue
        both = pa.concat_arrays([batch.column(0), batch.column(1)]).dictionary_encode()
        ids = []
        for k in both.dictionary.to_pylist():
            if k not in at:
                at[k] = len(root)
                root.append(len(root))
            ids.append(at[k])
        top = np.array([find(i) for i in ids])[both.indices.to_numpy()].reshape(2, -1)
        kept = []
        for i in np.flatnonzero(top[0] != top[1]).tolist():
            a, b = find(int(top[0, i])), find(int(top[1, i]))
            if a != b:
                root[max(a, b)] = min(a, b)
                kept.append(i)
        yield batch.take(pa.array(kept, pa.int64()))


def groups(nodes: DataFrame, key: str, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(key, component: least key reachable over the edges a, b) of all nodes. Partitions keep a forest of their edges first, so that no more is shuffled than nodes for each of them. Each round gives every node the least label among its neighbours and then that label's own label; rounds are written tables, of the order of log n, each of which replaces the one before."""
    prepared(edges.sparkSession)
    some = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u is not null and v is not null")
    forest = written(some.mapInArrow(_forest, some.schema), "forest")
    both = written(forest.union(forest.select("v", "u")).distinct(), "edges")
    drop_written(forest)
    held = written(nodes.select(F.col(key).alias("u"), F.col(key).alias("l"), F.col(key).alias("n")).distinct(), "labels")
    for _ in range(rounds):
        labels = held.select("u", F.col("n").alias("l"))
        near = both.join(labels.select(F.col("u").alias("v"), "l"), "v").groupBy("u").agg(F.min("l").alias("m"))
        lower = labels.join(near, "u", "left").select("u", "l", F.least("l", F.coalesce("m", "l")).alias("n"))
        jumped = lower.join(labels.select(F.col("u").alias("n"), F.col("l").alias("j")), "n", "left").select("u", "l", F.least("n", F.coalesce("j", "n")).alias("n"))
        following = written(jumped, "labels")
        drop_written(held)
        held = following
        if following.where("n < l").isEmpty():
            drop_written(both)
            return following.select(F.col("u").alias(key), F.col("n").alias("component"))
    raise RuntimeError("groups did not settle")


def group_sizes(grouped: DataFrame, episode: str, gate: int = 15, least: int = 5) -> DataFrame:
    """Groups by how many distinct episodes they span, and whether enough of them span `least` or more."""
    sizes = grouped.groupBy("component").agg(F.countDistinct(episode).alias("episodes"))
    out = sizes.groupBy("episodes").agg(F.count("*").alias("groups"))
    wide = sizes.agg(F.count_if(F.col("episodes") >= least).alias("qualifying")).withColumn("clears", F.col("qualifying") >= gate)
    return out.crossJoin(F.broadcast(wide))  # one row


