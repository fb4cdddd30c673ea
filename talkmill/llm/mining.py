"""Hard negatives by a block matrix product in two dimensions: blocks of anchors and of rows, in chunks of dimensions, meet in the cells of a grid, which add the partial tiles of scores and keep the best."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.best import Best
from . import common
from .whitening import matrices

#: Anchors and rows in a tile, and dimensions in a chunk; vectors are cut in PARTS chunks at most.
ANCHORS, ROWS, CHUNK, PARTS = 256, 1024, 32, 8
#: Blocks of rows in a column of the grid, until there are COLUMNS; after that columns grow, which costs no memory.
COLUMN, COLUMNS = 8, 64
#: Anchors in a line of the grid, and numbers that they may have; a cell holds a line's anchors and their best rows.
LINE, HELD = 1 << 15, 4 << 20
#: Rows of a batch that a cell gives.
GIVEN = 1 << 16
#: Scores must stay below this, so that a hundred of one is still a long.
LIMIT = (1 << 63) // 100 - 1
_BLOCK = "block long, chunk int, ids binary, labels binary, part binary"
_NEAR = "anchors long, anchor_id long, id long, score long"
_FOUND = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _cut(size: int, width: int, kind: str):
    """Blocks of up to size rows of a partition, sorted by id, in chunks of width dimensions of integers of a kind; a block's number holds the partition's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, parts, held, made = [], [], [], 0, 0

        def emit(n: int) -> Iterator[pa.RecordBatch]:
            nonlocal ids, labels, parts, held, made
            i, k, x = np.concatenate(ids), np.concatenate(labels), np.concatenate(parts)
            ids, labels, parts, held = [i[n:]], [k[n:]], [x[n:]], held - n
            order = np.argsort(i[:n], kind="stable")
            i, k, x = i[:n][order], k[:n][order], x[:n][order]
            no = (TaskContext.get().partitionId() << 32) + made
            made += 1
            chunks = range(0, max(1, x.shape[1]), width)
            cells = [[no] * len(chunks), range(len(chunks)), [i.tobytes()] * len(chunks), [k.tobytes()] * len(chunks), [np.ascontiguousarray(x[:, c : c + width]).tobytes() for c in chunks]]
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, kinds)], ["block", "chunk", "ids", "labels", "part"])

        for batch in batches:
            if not batch.num_rows:
                continue
            for part, x in matrices(batch, 2):
                ids.append(batch.column(0).to_numpy()[part])
                labels.append(batch.column(1).to_numpy()[part])
                parts.append(x.astype(kind))
                held += len(part)
                while held >= size:
                    yield from emit(size)
        if held:
            yield from emit(held)

    return run


@dataclass
class Side:
    """Anchors, or rows, of a cell: for each its block, id and label; for each chunk of dimensions a matrix, the same in doubles, and its largest entry; and the windows of anchors."""

    blocks: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray, int]]
    windows: list[dict]


def _side(blocks: list[list[dict]], kind: str) -> Side:
    ids, labels = ([np.frombuffer(b[0][k], np.int64) for b in blocks] for k in ("ids", "labels"))
    parts = [np.concatenate([np.frombuffer(b[c]["part"], kind).reshape(len(i), -1) for b, i in zip(blocks, ids)]) for c in range(len(blocks[0]))]
    numbers = np.repeat([b[0]["block"] for b in blocks], [len(i) for i in ids])
    return Side(numbers, np.concatenate(ids), np.concatenate(labels), [(x, x.astype(float), max(int(x.max(initial=0)), -int(x.min(initial=0)))) for x in parts], [w for b in blocks for w in b[0].get("windows") or []])


def _sides(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[int, Side]]:
    """Of a cell's chunks of blocks, in order: its anchors (0), whole, then its rows (1), ROWS or so at a time."""
    held: list[list[dict]] = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
            if row["chunk"]:
                held[-1].append(row)
                continue
            side = held[0][0]["side"] if held else row["side"]
            if row["side"] != side or (side and sum(len(b[0]["ids"]) for b in held) >= 8 * ROWS):  # of 8 bytes each
                yield side, _side(held, kind)
                held = []
            held.append([row])
    if held:
        yield held[0][0]["side"], _side(held, kind)


def _tiles(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[Side, np.ndarray, Side, np.ndarray]]:
    """A cell's anchors, places of ANCHORS of them at most, some rows, and their scores: the sum of the chunks' partial tiles, each exact, in doubles where sums stay below 2**53."""
    anchors = None
    for side, rows in _sides(batches, kind):
        if not side:
            anchors = rows
        elif anchors is not None:  # a line may have none
            for at in range(0, len(anchors.ids), ANCHORS):
                scores = np.zeros((min(ANCHORS, len(anchors.ids) - at), len(rows.ids)), np.int64)
                for (a, a_doubles, a_most), (b, b_doubles, b_most) in zip(anchors.parts, rows.parts):
                    if a_most * b_most * max(1, a.shape[1]) < 1 << 53:
                        scores += (a_doubles[at : at + ANCHORS] @ b_doubles.T).astype(np.int64)
                    else:
                        scores += a[at : at + ANCHORS].astype(np.int64) @ b.T.astype(np.int64)
                yield anchors, np.arange(at, at + len(scores)), rows, scores


def _given(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), GIVEN):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + GIVEN]) for c in columns], names)


def _nearest(k: int, kind: str):
    """The k best other rows of each anchor's label in a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for anchors, at, rows, scores in _tiles(batches, kind):
            best = best or Best(len(anchors.ids), k, np.int64, np.int64)
            best.offer_tile(at, scores, rows.ids, (anchors.labels[at][:, None] == rows.labels) & (anchors.ids[at][:, None] != rows.ids))
        if best:
            of, score, ids = best.rows()
            yield from _given([anchors.blocks[of], anchors.ids[of], ids, score], ["anchors", "anchor_id", "id", "score"])

    return run


def _inside(k: int, low: tuple[int, int], high: tuple[int, int], kind: str):
    """The k best rows of other labels in a cell for each window of an anchor and a positive."""

    bounded = lambda x: max(-LIMIT - 1, min(LIMIT + 1, x))  # noqa: E731  as scores are

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for anchors, at, rows, scores in _tiles(batches, kind):
            if best is None:
                place, turn = {a: i for i, a in enumerate(anchors.ids.tolist())}, [0] * len(anchors.ids)
                of, nth = np.empty(len(anchors.windows), np.int64), np.empty(len(anchors.windows), np.int64)
                for w, window in enumerate(anchors.windows):
                    of[w] = place[window["anchor_id"]]
                    nth[w] = turn[of[w]]
                    turn[of[w]] += 1
                positive, score = (np.array([w[c] for w in anchors.windows], np.int64) for c in ("id", "score"))
                # negative * low[1] >= positive * low[0] and negative * high[1] <= positive * high[0]
                least = np.array([bounded(-(-s * low[0] // low[1])) for s in score.tolist()], np.int64)
                most = np.array([bounded(s * high[0] // high[1]) for s in score.tolist()], np.int64)
                best = Best(len(of), k, np.int64, np.int64)
                each = [np.flatnonzero(nth == i) for i in range(max(turn, default=0))]
                each = [w[np.argsort(of[w], kind="stable")] for w in each]  # an anchor's first windows, second ones, ...
            other = anchors.labels[at][:, None] != rows.labels
            for windows in each:
                w = windows[np.searchsorted(of[windows], at[0]) : np.searchsorted(of[windows], at[-1], "right")]
                mine = scores[of[w] - at[0]]
                best.offer_tile(w, mine, rows.ids, other[of[w] - at[0]] & (mine >= least[w][:, None]) & (mine <= most[w][:, None]))
        if best:
            w, found, ids = best.rows()
            yield from _given([anchors.ids[of[w]], positive[w], score[w], ids, found], ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def _dealt(left: DataFrame, right: DataFrame, lines: int, columns: int) -> DataFrame:
    """The chunks of a cell in each partition, anchors first: a line's blocks of anchors (left) go to all its columns, a column's blocks of rows (right) to all its lines. Blocks of a partition go to neighbouring lines or columns, so that these are even."""
    place = F.shiftright("block", 32) + F.col("block").bitwiseAND((1 << 32) - 1)
    a = left.select(F.lit(0).alias("side"), *left.columns, F.pmod(place, F.lit(lines)).alias("line"), F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("column"))
    b = right.select(F.lit(1).alias("side"), *right.columns, F.pmod(place, F.lit(columns)).alias("column"), F.explode(F.sequence(F.lit(0), F.lit(lines - 1))).alias("line"))
    both = a.unionByName(b, allowMissingColumns=True)
    return both.repartitionById(lines * columns, (F.col("line") * columns + F.col("column")).cast("int")).sortWithinPartitions("side", "block", "chunk").drop("line", "column")


def _first(rows: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key with their rank; Spark keeps k of each task before it shuffles."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def mine(rows: DataFrame, *, anchors: Column, positives: int = 5, negatives: int = 10, low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100), id_col: str = "vec_id", label_col: str = "label", vector_col: str = "x") -> DataFrame:
    """Hard negatives for each anchor and each of its positives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of two arrays of longs; higher ones come first, ties by the smaller id. Anchors are the rows for which the condition anchors holds. Positives are an anchor's first other rows with its label; negatives of the two the first rows with other labels whose score lies between low and high (numerator, denominator) times the positive's.

    1. Rows and anchors are cut into blocks, and these into chunks of dimensions, and dealt to a grid: a line's anchors go to all its columns, a column's rows to all its lines. A cell holds its line's anchors (LINE at most); rows pass by in blocks, and the partial tiles of their chunks are added there. Scores are neither shuffled nor written.
    2. Each cell gives its best positives for each anchor; these are reduced to the first ones.
    3. The cells meet again, with the windows of their anchors, and give their best negatives for each window; these are reduced too.
    Rows are shuffled once for each line and pass, anchors and what is kept for them once for each column, of which there are COLUMNS at most. No cell or group holds more than a line, whatever labels are frequent.

    Rows with a null id, label or vector or a null entry take no part. Of rows with equal id, the one of the least label, then vector counts. Shorter vectors count as if zeros followed. A table whose scores could pass 9.2e16 raises ValueError. No anchors, or an empty table, give no rows.
    """
    common.ready(rows.sparkSession)
    x = common.col(vector_col)
    held = rows.select(common.col(id_col).cast("long").alias("id"), common.col(label_col).cast("long").alias("label"), x.alias("x"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    held = held.where("id is not null and label is not null and x is not null").where(F.forall("x", lambda v: v.isNotNull()))
    held = held.groupBy("id").agg(F.min(F.struct("label", "x", "anchor")).alias("s")).select("id", "s.*")
    held = common.written(held, "vectors")
    size = held.agg(F.max(F.size("x")), F.max(F.aggregate("x", F.lit(0).cast("long"), lambda a, v: F.greatest(a, F.abs(v)))), F.count("*"), F.count_if("anchor")).first()
    dim, most, n, n_anchors = (v or 0 for v in size)
    if dim * most * most > LIMIT:
        raise ValueError(f"vectors of {dim} entries up to {most} have scores that don't fit")
    width = max(CHUNK, -(-dim // PARTS))
    padded = held.withColumn("x", F.when(F.size("x") < dim, F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x")))).otherwise(F.col("x")))
    kind = next(k for k in ("int8", "int16", "int32", "int64") if most <= np.iinfo(k).max)
    columns = max(1, min(COLUMNS, -(-n // (ROWS * COLUMN))))
    lines = max(1, -(-n_anchors // max(1, min(LINE, HELD // max(1, dim)))))
    few = padded.where("anchor").select("id", "label", "x").repartition(max(1, -(-n_anchors // ANCHORS)), "id")  # blocks of anchors are full, however they lie among the rows
    left = common.written(few.mapInArrow(common.lean(_cut(ANCHORS, width, kind)), _BLOCK), "anchors")
    right = common.written(padded.select("id", "label", "x").mapInArrow(common.lean(_cut(ROWS, width, kind)), _BLOCK), "rows")

    near = _dealt(left, right, lines, columns).mapInArrow(common.lean(_nearest(positives, kind)), _NEAR)
    near = common.written(_first(near, ["anchors", "anchor_id"], [F.desc("score"), F.col("id")], positives).drop("rank"), "positives")
    windows = near.groupBy(F.col("anchors").alias("block"), F.lit(0).alias("chunk")).agg(F.collect_list(F.struct("anchor_id", "id", "score")).alias("windows"))  # of one block of anchors, beside its first chunk
    found = _dealt(left.join(windows, ["block", "chunk"], "left"), right, lines, columns).mapInArrow(common.lean(_inside(negatives, low, high, kind)), _FOUND)
    out = _first(found, ["anchor_id", "positive_id"], [F.desc("negative_score"), F.col("negative_id")], negatives)
    out = common.written(out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"), "negatives")
    for table in (held, left, right, near):
        common.drop_written(table)
    return out
