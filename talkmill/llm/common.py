"""Helpers that the operators share: unused names, distributed running sums, words; shared tables as in the library."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_written, shared_dir, written  # noqa: F401
from ..session import prepared as ready  # noqa: F401

#: Characters that separate words.
SPACES = " \t\n\x0b\f\r"
#: What separates words, as a Java regular expression.
SPACE_RUN = "[ \\x09-\\x0D]+"


def unused(df: DataFrame, *names: str) -> list[str]:
    """names, each with underscores added until df has no such column, in whatever case."""
    there, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in there:
            name += "_"
        there.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """The column of just this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def running_sum(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds to each row the sum of value over the rows before it with equal keys, in order of the integer column bucket, then order.

    No task gets all rows of a key: rows are summed within (keys, bucket), and only the buckets' totals are summed by keys. The totals are broadcast: callers keep keys x buckets under some 100,000 rows by construction.
    """
    inner, total, before = unused(df, "rs_inner", "rs_total", "rs_before")
    part = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = df.groupBy(*keys, bucket).agg(F.sum(value).alias(total))
    whole = Window.partitionBy(*(keys or [F.lit(1)])).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn(before, F.coalesce(F.sum(total).over(whole), F.lit(0))).drop(total)
    summed = df.withColumn(inner, F.sum(value).over(part) - value)
    renamed = totals.select(*(F.col(k).alias(f"{before}_{i}") for i, k in enumerate([*keys, bucket])), before)
    on = [F.col(k).eqNullSafe(F.col(f"{before}_{i}")) for i, k in enumerate([*keys, bucket])]
    out = summed.join(F.broadcast(renamed), on, "left")
    return out.withColumn(name, (F.col(inner) + F.col(before)).cast("long")).select(*df.columns, name)


def words(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of text as an array; none for null or blank text."""
    bare = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " "))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, with what a task has freed given back to the system at its end: workers are kept for later tasks, beside the JVM."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # other systems than Linux have no such call
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser with full avalanche (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = {True: _powers(_BASE, 1 << 12), False: _powers(_INVERSE, 1 << 12)}


def powers(n: int, up: bool) -> np.ndarray:
    if len(_POWERS[up]) < n:
        _POWERS[up] = _powers(_BASE if up else _INVERSE, 2 * n)
    return _POWERS[up][:n]


def spans(space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs where space is False."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    return edge[0::2], edge[1::2]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, found for all spans at once by sums over prefixes."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * powers(n, True), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(n + 1, False)[starts] + (ends - starts).astype(np.uint64))
