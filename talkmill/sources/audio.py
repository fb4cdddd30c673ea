"""Crops of WAV files: cut in the file's own rate, brought to one rate, mixed down to one channel."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import prepared

RATE = 16_000
#: The low-pass filter's zero crossings to either side, and its edge as a share of the lower rate's half.
CROSSINGS, ROLL_OFF = 6, 0.99
#: Files of a task, about.
FILES = 128
#: A crop that has less than this of what the file has left at its place is no crop.
ENOUGH = 0.9
_INTEGERS = {8: "u1", 16: "<i2", 32: "<i4"}
_FLOATS = {32: "<f4", 64: "<f8"}


class Wav(NamedTuple):
    """Where the samples of a file lie: rate, channels, bits, whether they are floats, the first sample's byte and the number of frames."""

    rate: int
    channels: int
    bits: int
    floats: bool
    at: int
    frames: int


def wav_header(data: bytes) -> Wav:
    """The header of a RIFF file with plain samples; anything else raises ValueError. Frames are those that are there, whatever the header says."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("no WAV file")
    at, kind = 12, None
    while at + 8 <= len(data):
        name, size = struct.unpack_from("<4sI", data, at)
        if name == b"fmt " and size >= 16 and at + 24 <= len(data):
            kind = struct.unpack_from("<HHIIHH", data, at + 8)
            if kind[0] == 0xFFFE and size >= 26:  # the kind stands further on
                kind = (struct.unpack_from("<H", data, at + 32)[0], *kind[1:])
        elif name == b"data":
            if kind is None:
                raise ValueError("samples come before their format")
            code, channels, rate, _, _, bits = kind
            if not channels or not rate or not (code == 1 and bits in (8, 16, 24, 32) or code == 3 and bits in _FLOATS):
                raise ValueError(f"samples of kind {code} with {bits} bits aren't read")
            there = min(size, len(data) - at - 8)
            return Wav(rate, channels, bits, code == 3, at + 8, there // (channels * bits // 8))
        at += 8 + size + size % 2
    raise ValueError("no samples")


def wav_frames(data: bytes, head: Wav, first: int, n: int) -> np.ndarray:
    """n frames from the first on, as many as there are, as doubles of -1 to 1: a row for each channel."""
    first = min(max(0, first), head.frames)
    n = min(n, head.frames - first)
    width = head.bits // 8
    at, count = head.at + first * head.channels * width, n * head.channels
    if head.floats:
        x = np.frombuffer(data, _FLOATS[head.bits], count, at).astype(float)
    elif head.bits == 24:
        low = np.frombuffer(data, "u1", 3 * count, at).reshape(-1, 3).astype(np.int32)
        x = ((low[:, 0] << 8 | low[:, 1] << 16 | low[:, 2] << 24) >> 8) / float(1 << 23)
    else:
        x = np.frombuffer(data, _INTEGERS[head.bits], count, at).astype(float)
        x = (x - 128) / 128 if head.bits == 8 else x / float(1 << (head.bits - 1))
    return x.reshape(n, head.channels).T


@lru_cache(maxsize=64)
def _filters(up: int, down: int) -> tuple[np.ndarray, int]:
    """One filter for each of `up` places of an output sample between input samples, and how far it reaches back."""
    edge = min(up, down) * ROLL_OFF / down  # of the input's half rate
    reach = math.ceil(CROSSINGS / edge)
    away = np.arange(-reach, reach + down)[None, :] - np.arange(up)[:, None] * (down / up)
    crossing = np.clip(away * edge, -CROSSINGS, CROSSINGS)
    return edge * np.sinc(crossing) * np.cos(crossing * math.pi / CROSSINGS / 2) ** 2, reach


def resampled(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Channels at another rate, by a windowed sinc in as many phases as the rates' ratio has: ceil(samples * to / rate) samples."""
    if rate == to or not x.shape[1]:
        return x
    up, down = to // math.gcd(rate, to), rate // math.gcd(rate, to)
    filters, reach = _filters(up, down)
    n = -(-x.shape[1] * up // down)
    steps = -(-n // up)
    padded = np.pad(x, ((0, 0), (reach, max(0, (steps - 1) * down + filters.shape[1] - reach - x.shape[1]))))
    seen = np.lib.stride_tricks.sliding_window_view(padded, filters.shape[1], axis=1)[:, : (steps - 1) * down + 1 : down]
    return np.concatenate([(part @ filters.T).reshape(1, -1) for part in seen])[:, :n]


def crop(data: bytes, start_s: float, length_s: float, to: int = RATE) -> np.ndarray:
    """One channel of samples at the rate `to`, from start_s on. Places are counted in the file's own rate. A crop may be short where the file ends; any other that is raises ValueError."""
    head = wav_header(data)
    x = resampled(wav_frames(data, head, int(start_s * head.rate), int(length_s * head.rate)), head.rate, to)
    wanted = min(length_s, max(0.0, head.frames / head.rate - start_s))
    if x.shape[1] / to < wanted * ENOUGH:
        raise ValueError(f"{x.shape[1] / to:.2f} s of {wanted:.2f} s are there at {start_s} s")
    return x.mean(axis=0) if x.shape[1] else np.empty(0)


def cut_crops(plan: DataFrame, files: DataFrame, *, path: str = "audio_path", to: int = RATE) -> DataFrame:
    """plan (path, crop_start_s, crop_length_s and more) with samples (array<float>), native_rate, error and error_kind: "download" where files (path, content, as binaryFile reads them) has none, "crop" where it can't be cut.

    A file's crops stand in one row with it, so that it is read once; a task holds a file and its crops. Rows without a place have an error.
    """
    prepared(plan.sparkSession)
    own = F.struct(*(F.col(f"`{c}`") for c in plan.columns)).alias("crop")
    asked = plan.groupBy(F.col(path).alias("path_")).agg(F.collect_list(own).alias("crops"))
    n = max(1, -(-plan.select(path).distinct().count() // FILES))
    found = files.select(F.col("path").alias("path_"), "content").repartition(n, "path_")
    met = asked.repartition(n, "path_").hint("merge").join(found, "path_", "left").select("crops", "content")  # contents are larger than Spark knows: never broadcast
    kind = plan.withColumns({"samples": F.lit(None).cast("array<float>"), "native_rate": F.lit(None).cast("int"), "error": F.lit(None).cast("string"), "error_kind": F.lit(None).cast("string")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for crops, content in zip(batch.column(0), batch.column(1)):
                data, given = content.as_py(), crops.values
                samples, rates, errors, kinds = [], [], [], []
                for start, length in zip(given.field("crop_start_s").to_pylist(), given.field("crop_length_s").to_pylist()):
                    found, rate, error, what = None, None, None, None
                    try:
                        if data is None:
                            raise FileNotFoundError("no such file")
                        if start is None or length is None or not (start >= 0 and length >= 0 and start + length < float("inf")):
                            raise ValueError("no place in a file")
                        rate = wav_header(data).rate
                        found = crop(data, start, length, to).astype(np.float32)
                    except (ValueError, OSError) as e:
                        error, what = str(e), "download" if isinstance(e, OSError) else "crop"
                    samples.append(found)
                    rates.append(rate)
                    errors.append(error)
                    kinds.append(what)
                columns = [given.field(i) for i in range(given.type.num_fields)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(samples, pa.list_(pa.float32())), pa.array(rates, pa.int32()), pa.array(errors, pa.string()), pa.array(kinds, pa.string())], kind.names)

    return met.mapInArrow(run, kind)
