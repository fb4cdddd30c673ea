"""Cells of vectors around pivots: which rows lie near which, and how far a cell reaches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import prepared

#: Vectors that pivots are fitted on, at most: those with the least hashes of their keys.
SAMPLE = 20_000
#: Pivots, at most. What is known of cells is of a fixed size, then, whatever the table.
MOST = 1024


def _units(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def _column(batch: pa.RecordBatch, at: int) -> np.ndarray:
    """A column of lists of one length, without nulls, as a matrix."""
    lists = batch.column(at)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1)


def fit_pivots(vectors: DataFrame, key: str, vector: str, cells: int, rounds: int = 12, sample: int = SAMPLE) -> np.ndarray:
    """Unit vectors in the middle of clusters, `cells` of them at most (spherical k-means from far points on), fitted on the driver on a sample of bounded size: the rows with the least hashes of their keys. No usable vector gives none."""
    usable = vectors.where(F.col(vector).isNotNull() & F.exists(vector, lambda x: x != 0))
    rows = usable.select(F.col(vector).cast("array<double>").alias("v")).orderBy(F.xxhash64(key), key).limit(sample).collect()
    if not rows:
        return np.empty((0, 0))
    size = len(rows[0]["v"])
    x = _units(np.array([r["v"] for r in rows if len(r["v"]) == size]))
    k = max(1, min(cells, MOST, len(x)))
    spread = np.random.default_rng(7)
    near, picked = np.full(len(x), -2.0), [0]
    for _ in range(k - 1):  # each next pivot is drawn by its distance from those before
        near = np.maximum(near, x @ x[picked[-1]])
        weight = np.maximum(1 - near, 0)
        if weight.sum() <= 1e-12:
            break
        picked.append(int(spread.choice(len(x), p=weight / weight.sum())))
    pivots = x[picked]
    for _ in range(rounds):
        of = (x @ pivots.T).argmax(axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, of, x)
        moved = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 1e-9, _units(sums), pivots)
        if np.allclose(moved, pivots, atol=1e-7):
            break
        pivots = moved
    return pivots


def angle(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def with_cells(rows: DataFrame, vector: str, pivots: np.ndarray, cell: str = "cell", apart: str = "apart") -> DataFrame:
    """rows with the number of the nearest pivot and the angle to it. vector must have the pivots' length; a vector without length is a right angle from all."""
    prepared(rows.sparkSession)
    at = rows.columns.index(vector)
    schema = rows.withColumns({cell: F.lit(0), apart: F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _units(_column(batch, at)) @ pivots.T
            of = x.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of.astype(np.int32)), pa.array(angle(x[np.arange(len(x)), of]))], [*batch.schema.names, cell, apart])

    return rows.mapInArrow(run, schema)
