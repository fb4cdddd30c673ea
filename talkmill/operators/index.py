"""An index for vector search: inverted cells around pivots, stored as partitions of a table that a search prunes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.best import Best
from ..session import prepared, shared_dir
from . import cells as around
from .search import nearest

#: Rows and queries that are multiplied at a time, where many queries are asked at once.
ROWS, QUERIES = 2048, 512
#: Rows in a column of the grid where these meet, and lines times columns, about; where lines are many, there are so many columns nevertheless. A column may grow, which costs no memory.
COLUMN, GRID, COLUMNS = 8192, 64, 16
#: Queries in a line, and numbers that they may have; a task holds a line's queries and their best rows.
LINE, NUMBERS = 1 << 16, 4 << 20
#: Rows of a batch that a task gives there.
GIVEN = 1 << 16
#: Rows of queries, once for each cell that they probe, that a task makes at a time.
COPIES = 4096
#: Rows of a resident index that one task searches; up to so many, a query isn't compiled.
HELD = 20_000
#: Rows that probes are chosen by, at most.
ASKED = 200
#: Standard errors by which the recall measured on them has to exceed the target.
ERRORS = 3.0
#: The cell of rows that no pivot is near: without a vector of the index's length.
ASIDE = -1
_SLACK = 1e-6


@dataclass
class VectorIndex:
    """A built index: where it lies, its rows with their cells, the pivots, each cell's number of rows and largest angle to its pivot, and how many cells a search probes."""

    at: str
    table: DataFrame
    pivots: np.ndarray
    sizes: dict[int, int]
    reach: dict[int, float]
    probes: int
    id_col: str
    vector: str
    cell: str

    def nearest_cells(self, query: list[float]) -> list[tuple[int, float]]:
        """Cells with rows, nearest pivot first, and the angle to it; the cell aside is none of them."""
        q = np.asarray(query, float)
        angles = around.angle(self.pivots @ (q / np.linalg.norm(q))) if len(self.pivots) else np.empty(0)
        return [(int(c), float(angles[c])) for c in np.argsort(angles, kind="stable") if int(c) in self.sizes]

    def resident(self) -> VectorIndex:
        """The same, with its rows held in the executors' memory, HELD to a task; what is lost there is read again from the table."""
        self.table = self.table.coalesce(max(1, -(-sum(self.sizes.values()) // HELD))).persist()
        self.table.count()
        return self

    def within(self, cells: list[int]) -> DataFrame:
        """The rows of these cells and those aside; the others' files aren't read."""
        wanted = [*cells, *([ASIDE] if ASIDE in self.sizes else [])]
        return self.table.where(F.col(self.cell).isin(wanted)).drop(self.cell)


def _cell_name(columns: list[str]) -> str:
    name = "cell"
    while name in {c.lower() for c in columns}:
        name += "_"
    return name


def build(records: DataFrame, *, id_col: str = "id", vector: str = "embedding", cells: int | None = None, probes: int | None = None, target: float = 0.99, n: int = 10, at: str | None = None) -> VectorIndex:
    """An index of all records, whatever their vectors, in a folder of its own in the shared folder, or at `at`.

    Pivots are fitted on a sample of around.SAMPLE rows at most; each row then goes to the cell of its nearest pivot. Cells are partitions of the table, so that a search reads those that it probes; Spark splits large cells into several files. Unless probes are given, as many are taken as reach the target recall of n hits on a sample of ASKED rows asked back, by ERRORS standard errors, so that other queries reach it too.
    """
    spark = prepared(records.sparkSession)
    rows = records.count()
    pivots = around.fit_pivots(records, id_col, vector, cells or max(1, round(rows**0.5)))
    cell, size = _cell_name(records.columns), pivots.shape[1]
    fits = F.coalesce((F.size(vector) == size) & F.forall(vector, lambda x: x.isNotNull()) & F.exists(vector, lambda x: x != 0), F.lit(False)) if size else F.lit(False)
    placed = records.where(~fits).withColumns({cell: F.lit(ASIDE), "apart_": F.lit(0.0)})
    if size:
        placed = around.with_cells(records.where(fits), vector, pivots, cell, "apart_").unionByName(placed)
    at = at or f"{shared_dir(spark)}/talkmill/index-{uuid.uuid4().hex}"
    placed.hint("rebalance", cell).write.partitionBy(cell).parquet(f"{at}/cells")
    stored = spark.read.schema(placed.schema).parquet(f"{at}/cells")
    known = stored.groupBy(cell).agg(F.count("*").alias("n"), F.max("apart_").alias("reach"))
    known = known.join(spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pivots)], f"{cell} int, pivot array<double>"), cell, "full")  # a row for each cell
    known.select(F.col(cell).alias("cell"), "n", "reach", "pivot").coalesce(1).write.parquet(f"{at}/pivots")
    spark.createDataFrame([(placed.schema.json(),)], "value string").write.text(f"{at}/schema")
    index = load(spark, at, id_col=id_col, vector=vector, probes=probes or 1)
    if probes is None:
        index.probes = tuned(index, target, n, ERRORS)
    return index


def load(spark: SparkSession, at: str, *, id_col: str = "id", vector: str = "embedding", probes: int = 8) -> VectorIndex:
    """An index that build() has written at `at`."""
    known = spark.read.parquet(f"{at}/pivots").orderBy("cell").collect()  # one row for each of around.MOST cells at most
    pivots = np.array([r["pivot"] for r in known if r["pivot"] is not None])
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{at}/schema").first()[0]))
    table = spark.read.schema(schema).parquet(f"{at}/cells").drop("apart_")
    cell = table.columns[-1]
    return VectorIndex(at, table, pivots if len(pivots) else np.empty((0, 0)), {r["cell"]: r["n"] for r in known if r["n"]}, {r["cell"]: r["reach"] for r in known if r["n"]}, probes, id_col, vector, cell)


def indexed(index: VectorIndex, query: list[float], n: int, tree: dict | None = None, *, probes: int | None = None, exact: bool = False) -> DataFrame:
    """The n records nearest to the query among those of the cells nearest to it, as nearest() gives them.

    With exact, the distance of the last hit tells which other cells can hold a nearer one: those whose pivot is no farther from the query than that angle and the cell's reach together. They are read too, so that the hits are those of all records. Where a filter leaves fewer than n in the cells probed, all cells are read: a filter never loses hits.
    """
    order = index.nearest_cells(query)
    first = [c for c, _ in order[: probes or index.probes]]
    few = sum(index.sizes[c] for c in first) <= HELD
    found = nearest(index.within(first), query, n, tree, index.vector, index.id_col, few=few)
    if not exact and tree is None and sum(index.sizes[c] for c in first) >= n:
        return found
    held = [r["distance"] for r in found.select("distance").collect()]  # n at most
    if len(held) < n:
        more = [c for c, _ in order]
    elif exact:
        bound = float(around.angle(1 - max(held))) + _SLACK
        more = first + [c for c, a in order[len(first) :] if a - index.reach[c] <= bound]
    else:
        return found
    return found if len(more) == len(first) else nearest(index.within(more), query, n, tree, index.vector, index.id_col)


def nearest_many(index: VectorIndex, queries: DataFrame, n: int, *, query_id: str = "query_id", query_vector: str = "vector", probes: int | None = None, exact: bool = False, digits: int = 9) -> DataFrame:
    """query_id, rank, id, similarity: the n nearest records to each of many queries, ties by id. exact probes all cells.

    Rows and queries are dealt to a grid: a line's queries go to the columns that hold rows of the cells that they probe, a column's rows to all lines, as they are. A task holds its line's queries and the best n of each; rows pass by cell by cell and are multiplied as matrices with the queries that probe them. So rows are shuffled once for each line, queries and their hits once for each column: as the input, not as queries times cells, and no cell is in one task, whatever its size. Similarities are rounded to so many digits before they are compared, so that the order doesn't rest on how products are summed. Records without a vector of the index's length have no similarity and are not found; queries without one find nothing.
    """
    prepared(index.table.sparkSession)
    size, there = index.pivots.shape[1], sorted(c for c in index.sizes if c != ASIDE)
    k = len(there) if exact else min(probes or index.probes, len(there))
    all_, total, n_asked = k == len(there), sum(index.sizes[c] for c in there), queries.count()
    lines = max(-(-n_asked // max(1, min(LINE, NUMBERS // max(1, size)))), min(-(-n_asked // QUERIES), round((GRID * n_asked / max(1, total)) ** 0.5)), 1)
    columns = max(1, min(-(-total // COLUMN), max(COLUMNS, -(-GRID // lines))))
    id_kind, query_kind = index.table.schema[index.id_col].dataType.simpleString(), queries.schema[query_id].dataType.simpleString()
    fits = lambda v: (F.size(v) == size) & F.forall(v, lambda x: x.isNotNull()) & F.exists(v, lambda x: x != 0)
    floats = {index.table.schema[index.vector].dataType.simpleString(), queries.schema[query_vector].dataType.simpleString()} == {"array<float>"}
    vector = lambda v: F.col(v).cast("array<float>" if floats else "array<double>").alias("v")

    first, dealt, parts = {}, 0, {c: -(-index.sizes[c] // ROWS) for c in there}  # parts of cells are dealt to columns in turn
    for c in there:
        first[c], dealt = dealt, dealt + parts[c]
    at = lambda known: F.element_at(F.create_map(*(F.lit(x) for pair in (known or {0: 1}).items() for x in pair)), F.col(index.cell))  # noqa: E731  of MOST cells at most
    hashed = F.xxhash64(index.id_col)
    column = F.pmod(hashed, F.lit(columns)) if all_ else F.pmod(at(first) + F.pmod(hashed, at(parts)), F.lit(columns))
    rows = index.table.where(F.col(index.cell) != ASIDE).select(F.lit(1).alias("side"), F.lit(0).alias("cell") if all_ else F.col(index.cell).alias("cell"), F.col(index.id_col).alias("id"), vector(index.vector), column.cast("int").alias("column"), F.explode(F.sequence(F.lit(0), F.lit(lines - 1))).alias("line"))
    asked = queries.where(fits(F.col(query_vector))).select(F.col(query_id).alias("asked"), vector(query_vector))
    if all_:
        asked = asked.withColumns({"probed": F.lit(None).cast("binary"), "columns": F.sequence(F.lit(0), F.lit(columns - 1))})
    else:
        asked = _probing(asked, index, k, np.array([[(col - first[c]) % columns < parts[c] for col in range(columns)] for c in there]))
    asked = asked.select(F.lit(0).alias("side"), "asked", "v", "probed", F.explode("columns").alias("column"), F.pmod(F.xxhash64("asked"), F.lit(lines)).cast("int").alias("line"))
    both = asked.unionByName(rows, allowMissingColumns=True)
    met = both.repartitionById(lines * columns, F.col("line") * columns + F.col("column")).sortWithinPartitions("side", "cell").select("side", "cell", "asked", "id", "v", "probed")
    found = met.mapInArrow(lambda batches: _met(batches, n, digits, there), f"query_id {query_kind}, id {id_kind}, similarity double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))).where(F.col("rank") <= n)
    return ranked.select("query_id", "rank", "id", "similarity")


def _units(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _met(batches: Iterator[pa.RecordBatch], n: int, digits: int, there: list[int]) -> Iterator[pa.RecordBatch]:
    """query_id, id, similarity: the best n rows for each query of a task, which gets its queries first, then its rows by cell."""
    asked, best, place = [], None, {c: i for i, c in enumerate(there)}
    for batch in batches:
        begin = int(np.searchsorted(batch.column("side").to_numpy(), 1))
        if begin:
            asked.append(batch.slice(0, begin))
        rows = batch.slice(begin)
        if not asked or not rows.num_rows:
            continue
        kind = rows.schema.field("id").type
        if best is None:
            names = pa.concat_arrays([b.column("asked") for b in asked])
            queries = np.concatenate([_units(b) for b in asked])
            bits = pa.concat_arrays([b.column("probed") for b in asked])
            bits = None if bits.null_count else np.frombuffer(b"".join(bits.to_pylist()), np.uint8).reshape(len(names), -1)
            best = Best(len(names), n, float, np.int64 if pa.types.is_integer(kind) else object)
        cells = rows.column("cell").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for begin, end in zip(edges, edges[1:]):
            if bits is None:
                mine = np.arange(len(names))
            else:
                c = place[int(cells[begin])]
                mine = np.flatnonzero(bits[:, c >> 3] >> (7 - (c & 7)) & 1)
            for at in range(begin, end, ROWS):
                block = rows.slice(at, min(ROWS, end - at))
                x, ids = _units(block), block.column("id")
                ids = ids.to_numpy().astype(np.int64) if pa.types.is_integer(kind) else np.array([*ids.to_pylist(), None], object)[:-1]
                for q in range(0, len(mine), QUERIES):
                    some = mine[q : q + QUERIES]
                    best.offer_tile(some, queries[some] @ x.T, ids, digits=digits)
    if best is not None:
        of, similarity, ids = best.rows()
        for at in range(0, len(of), GIVEN):
            part = slice(at, at + GIVEN)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(of[part])), pa.array(ids[part].tolist(), kind), pa.array(similarity[part])], ["query_id", "id", "similarity"])


def _probing(asked: DataFrame, index: VectorIndex, k: int, lies: np.ndarray) -> DataFrame:
    """asked (asked, v) with bits of the k cells with rows whose pivots are nearest, and the columns where such rows lie; lies tells that for each cell with rows."""
    pivots, there = index.pivots, np.array(sorted(c for c in index.sizes if c != ASIDE), int)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _probed(batches, pivots, there, k):
            m = batch.num_rows // k
            probed = np.zeros((m, len(there)), bool)
            np.put_along_axis(probed, np.searchsorted(there, batch.column(2).to_numpy()).reshape(m, k), True, axis=1)
            once = batch.take(pa.array(np.arange(m) * k))
            bits = pa.array([x.tobytes() for x in np.packbits(probed, axis=1)], pa.binary())
            columns = pa.array([np.flatnonzero(x) for x in probed.astype(int) @ lies], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*once.columns[:2], bits, columns], ["asked", "v", "probed", "columns"])

    return asked.mapInArrow(run, asked.withColumns({"probed": F.lit(b""), "columns": F.array(F.lit(0))}).schema)


def _probed(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, there: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Queries once for each of the k cells with rows whose pivots are nearest, COPIES rows or one query's at a time."""
    step = max(1, COPIES // max(1, min(k, len(there))))
    for whole in batches:
        for at in range(0, whole.num_rows if len(there) else 0, step):
            batch = whole.slice(at, step)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            best = there[np.argsort(-(x @ pivots[there].T), axis=1, kind="stable")[:, :k]]
            took = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), best.shape[1])))
            yield pa.RecordBatch.from_arrays([*took.columns, pa.array(best.ravel().astype(np.int32))], [*batch.schema.names, "cell"])


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Of the hits in exact, the share that found has; both as nearest_many() gives them."""
    hit = exact.select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    got = hit.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
    return 1.0 if got is None else float(got)


def tuned(index: VectorIndex, target: float = 0.99, n: int = 10, errors: float = 0.0) -> int:
    """The least number of probes that reaches the target recall of n hits, measured on ASKED rows of the index at most, those with the least hashes of their ids, asked back against all rows. With errors, the measured recall less so many of its standard errors (rows asked differ from each other) has to reach the target.

    One pass over the rows, which go nowhere: each batch is multiplied with the rows asked, and keeps its best n. A hit is found if its cell is among those probed; so its cell's place in the query's order of cells tells from how many probes on.
    """
    there = np.array(sorted(c for c in index.sizes if c != ASIDE), int)
    if len(there) < 2:
        return 1
    rows = index.table.where(F.col(index.cell) != ASIDE).select(F.col(index.id_col).alias("id"), F.col(index.vector).cast("array<double>").alias("v"), F.col(index.cell).alias("cell"))
    asked = np.array([r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(ASKED).collect()])
    asked /= np.linalg.norm(asked, axis=1, keepdims=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                s = np.round(asked @ x.T / np.linalg.norm(x, axis=1), 9)
                best = np.argpartition(-s, min(n, s.shape[1]) - 1, axis=1)[:, :n]
                q = np.repeat(np.arange(len(asked)), best.shape[1])
                at = pa.array(best.ravel())
                yield pa.RecordBatch.from_arrays([pa.array(q), batch.column(0).take(at), pa.array(s[q, best.ravel()]), batch.column(2).take(at)], ["q", "id", "s", "cell"])

    found = rows.mapInArrow(run, f"q long, id {rows.schema['id'].dataType.simpleString()}, s double, cell int")
    first = found.withColumn("no", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "id"))).where(F.col("no") <= n).select("q", "cell").collect()
    order = np.argsort(-(asked @ index.pivots[there].T), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(there))[None, :], axis=1)
    got = np.zeros(place.shape)
    for r in first:
        got[r["q"], place[r["q"], np.searchsorted(there, r["cell"])]] += 1
    got = np.cumsum(got, axis=1)  # hits of each row asked, by the number of probes
    shares = got / np.maximum(got[:, -1:], 1)
    sure = got.sum(axis=0) / got[:, -1].sum() - errors * shares.std(axis=0) / np.sqrt(len(shares))
    return int(np.argmax(sure >= target - 1e-12)) + 1
