"""Whitening of vectors by singular value decompositions of partitions, merged in a tree."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: States that one task merges.
FAN = 8
#: Sums of whole numbers are kept in two halves of so many bits, so that they can't overflow.
HALF = 26
_STATE = "dim int, no long, n long, sums binary, mean binary, factors binary"


class State(NamedTuple):
    """What is kept of n vectors: exact sums (two halves), their mean, and the singular values times the right singular vectors of the rest, with all dimensions."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    factors: np.ndarray


class Model(NamedTuple):
    """Of n vectors: exact sums for each dimension, unit eigenvectors of the covariance as rows and their eigenvalues, falling."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray

    @property
    def live(self) -> np.ndarray:
        """The components that vary at all, as far as double precision tells: singular values above 1e-10 of the largest."""
        return self.values > self.values.max(initial=0.0) * 1e-20


def _factors(rows: np.ndarray) -> np.ndarray:
    """Singular values times right singular vectors; as many rows as columns."""
    _, values, right = np.linalg.svd(rows, full_matrices=False)
    out = np.zeros((rows.shape[1], rows.shape[1]))
    out[: len(values)] = values[:, None] * right
    return out


def _of(x: np.ndarray) -> State:
    """The state of the rows of x."""
    if x.dtype == np.int64:
        sums = np.stack([(x >> HALF).sum(axis=0), (x & ((1 << HALF) - 1)).sum(axis=0)])
        base = x[0]
        mean = (x - base).mean(axis=0)
        return State(len(x), sums, base + mean, _factors((x - base) - mean))
    mean = x.mean(axis=0)
    return State(len(x), np.zeros((2, x.shape[1]), np.int64), mean, _factors(x - mean))


def merge(a: State, b: State) -> State:
    """The state of the vectors of both: their factors and a row for the distance of the means are decomposed again, so that nothing is lost."""
    n = a.n + b.n
    between = np.sqrt(a.n * (b.n / n)) * (a.mean - b.mean)
    return State(n, a.sums + b.sums, a.mean + (b.mean - a.mean) * (b.n / n), _factors(np.vstack([a.factors, b.factors, between])))


def _row(dim: int, no: int, s: State) -> pa.RecordBatch:
    cells = [[dim], [no], [s.n], [s.sums.tobytes()], [s.mean.tobytes()], [s.factors.tobytes()]]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], ["dim", "no", "n", "sums", "mean", "factors"])


def _state(row: dict) -> State:
    d = row["dim"]
    return State(row["n"], np.frombuffer(row["sums"], np.int64).reshape(2, d), np.frombuffer(row["mean"]), np.frombuffer(row["factors"]).reshape(d, d))


def matrices(batch: pa.RecordBatch, column: int = 0, most: int = 4 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (numbers of them in the batch) and matrix of the vectors of each length in a column of lists without nulls, in pieces of most entries or so."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)
    starts = lists.offsets.to_numpy()[:-1].astype(np.int64)
    for dim in np.unique(sizes):
        of = np.flatnonzero(sizes == dim)
        step = max(1, most // max(1, dim))
        for at in range(0, len(of), step):
            part = of[at : at + step]
            yield part, values[starts[part][:, None] + np.arange(dim)]


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One state for each length of vectors in a partition; a batch at a time is in memory."""
    states: dict[int, State] = {}
    for batch in batches:
        for _, x in matrices(batch):
            if x.shape[1]:
                states[x.shape[1]] = merge(states[x.shape[1]], _of(x)) if x.shape[1] in states else _of(x)
    for dim, s in states.items():
        yield _row(dim, TaskContext.get().partitionId(), s)


def _merged(table: pa.Table) -> pa.Table:
    rows = table.sort_by("no").to_pylist()
    out = _state(rows[0])
    for row in rows[1:]:
        out = merge(out, _state(row))
    return pa.Table.from_batches([_row(rows[0]["dim"], rows[0]["no"] // FAN, out)])


def fit(vectors: DataFrame) -> Model | None:
    """The model of a DataFrame's one column of long or double arrays without null or non-finite entries; None where there is none.

    Each partition keeps a state of fixed size (dimensions squared). States are merged FAN at a time until one is left, which alone reaches the driver: no task sees more than FAN of them, whatever the table. Empty vectors don't count. Where lengths differ, the one that most vectors have is fitted, the longer of equals.
    """
    common.ready(vectors.sparkSession)
    states = common.written(vectors.mapInArrow(common.lean(_partial), _STATE), "states")
    tables, top = [states], states.agg(F.max("no")).first()[0]
    while top is not None and top > 0:
        states = common.written(states.groupBy("dim", F.floor(F.col("no") / FAN)).applyInArrow(_merged, _STATE), "states")
        tables.append(states)
        top //= FAN
    best = states.orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()  # one row for each length
    for table in tables:
        common.drop_written(table)
    if not best:
        return None
    s = _state(best[0].asDict())
    sums = [(int(hi) << HALF) + int(lo) for hi, lo in s.sums.T]
    _, values, right = np.linalg.svd(s.factors)
    return Model(s.n, sums, right, values**2 / s.n)


def _deviation(x: np.ndarray, model: Model) -> tuple[np.ndarray, list[int | None]]:
    """n * x - S as doubles, and the exact sum of its squares for each row; null where that is beyond a long."""
    n, reach = model.n, max(map(abs, model.sums), default=0)
    most = n * int(np.abs(x).max(initial=0)) + reach
    if most * most * max(1, x.shape[1]) < 1 << 63:
        apart = n * x - np.array(model.sums, np.int64)
        return apart.astype(float), (apart * apart).sum(axis=1).tolist()
    apart = n * x.astype(object) - np.array(model.sums, object)
    squares = (apart * apart).sum(axis=1)
    return apart.astype(float), [int(v) if v < 1 << 63 else None for v in squares]


def whiten(rows: DataFrame, *, model: Model | None, components: int | None = None, vector_col: str = "x") -> DataFrame:
    """rows with the columns deviation (long) and whitened (array<double>) added; columns of these names give way.

    vector_col holds arrays of longs. whitened is (x - S/n) projected on each of the first components (all, if None) over the root of its eigenvalue; 0 for a component that doesn't vary. deviation is the sum over dimensions of (n * x - S)^2, exact, null beyond a long. Rows whose vector is null, has a null entry or another length than the model's are dropped; without a model, all are.
    """
    common.ready(rows.sparkSession)
    own = [c for c in rows.columns if c.lower() not in {"deviation", "whitened"}]
    (vec,) = common.unused(rows, "w_vec")
    at = own.index(vector_col)
    dim = len(model.sums) if model else -1
    kept = rows.select(*map(common.col, own)).where((F.size(common.col(vector_col)) == dim) & F.forall(common.col(vector_col), lambda v: v.isNotNull()))
    schema = kept.withColumns({"deviation": F.lit(None).cast("long"), "whitened": F.array(F.lit(0.0))}).schema
    first = model.vectors[:components] if model else None
    scale = np.where(model.live, 1 / np.sqrt(np.where(model.live, model.values, 1)), 0.0)[:components] if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in matrices(batch, at):
                apart, squares = _deviation(x.astype(np.int64), model)
                out = (apart / model.n) @ first.T * scale
                lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, max(1, out.shape[1]), dtype=np.int32), pa.array(out.ravel()))
                took = batch.take(pa.array(part))
                yield pa.RecordBatch.from_arrays([*took.columns, pa.array(squares, pa.int64()), lists], [*own, "deviation", "whitened"])

    return kept.mapInArrow(common.lean(run), schema)


def identity_error(whitened: DataFrame, live: int) -> float:
    """The largest absolute entry of the covariance less the identity, over the first live entries of a DataFrame's one column of arrays."""
    if not live:
        return 0.0
    found = fit(whitened.select(F.slice(F.col(whitened.columns[0]), 1, live).alias("x")))
    return float(np.abs((found.vectors.T * found.values) @ found.vectors - np.eye(live)).max())


def components_of(vectors: DataFrame, *, components: int = 8, id_col: str = "vec_id", vector_col: str = "x") -> DataFrame:
    """One row for each vector and each of the first components: id_col, component (from 1), n, deviation, whitened, explained, identity_error.

    vector_col holds arrays of longs; rows with a null vector or a null entry are dropped. The model is fitted on all others (fit()), whatever their ids, null and repeated ones too. Vectors of another length than most have are dropped, empty ones too. There are fewer components where vectors are shorter. Entries are exact to 2**53. An empty table gives no rows.
    """
    x, id_ = common.col(vector_col).alias("x"), common.col(id_col).alias("id")
    rows = vectors.select(id_, x).where(F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull()))
    model = fit(rows.select("x"))
    done = common.written(whiten(rows, model=model, components=components).select("id", "deviation", "whitened"), "whitened")
    shown = min(components, len(model.values)) if model else 0
    error = identity_error(done.select("whitened"), int(model.live[:shown].sum())) if model else 0.0
    total = float(model.values.sum()) if model else 0.0
    shares = [float(v) / total if total else 0.0 for v in model.values[:shown]] if model else []
    each = done.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.get(F.array(*map(F.lit, shares)).cast("array<double>"), F.col("at"))
    return each.select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
