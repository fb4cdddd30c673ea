"""Crops of audio beside sines whose every sample is known."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkmill.sources import audio


def wav(x, rate, bits=16, floats=False, extensible=False, more=b""):
    """x: channels by samples, of -1 to 1."""
    flat = np.asarray(x, float).T.ravel()
    if floats:
        body = flat.astype(f"<f{bits // 8}").tobytes()
    elif bits == 8:
        body = np.round(flat * 127 + 128).astype("u1").tobytes()
    elif bits == 24:
        body = b"".join(struct.pack("<i", round(v * 8388607))[:3] for v in flat)
    else:
        body = np.round(flat * (2 ** (bits - 1) - 1)).astype(f"<i{bits // 8}").tobytes()
    code = 3 if floats else 1
    n = len(x)
    fmt = struct.pack("<HHIIHH", 0xFFFE if extensible else code, n, rate, rate * n * bits // 8, n * bits // 8, bits)
    if extensible:
        fmt += struct.pack("<HHIH", 22, bits, 0, code) + bytes(14)
    chunks = b"LIST" + struct.pack("<I", 3) + b"abc\0" + b"fmt " + struct.pack("<I", len(fmt)) + fmt + more + b"data" + struct.pack("<I", len(body)) + body
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def sine(rate, seconds, tone=440.0, channels=1):
    t = np.arange(int(rate * seconds)) / rate
    return np.stack([0.5 * np.sin(2 * math.pi * tone * t + k) for k in range(channels)])


@pytest.mark.parametrize(("bits", "floats", "close"), [(8, False, 1e-2), (16, False, 1e-4), (24, False, 1e-6), (32, False, 1e-8), (32, True, 1e-6), (64, True, 1e-12)])
@pytest.mark.parametrize("extensible", [False, True])
def test_samples_of_all_kinds(bits, floats, close, extensible):
    x = sine(16_000, 0.5, channels=2)
    data = wav(x, 16_000, bits, floats, extensible, b"junk" + struct.pack("<I", 2) + b"..")
    head = audio.wav_header(data)
    assert (head.rate, head.channels, head.frames) == (16_000, 2, 8000) and np.allclose(audio.wav_frames(data, head, 100, 50), x[:, 100:150], atol=close)
    assert np.allclose(audio.crop(data, 0.25, 0.1), x[:, 4000:5600].mean(axis=0), atol=close)


@pytest.mark.parametrize("rate", [48_000, 44_100, 32_000, 22_050, 8000, 11_025])
def test_a_crop_is_the_sine_at_its_place(rate):
    """Away from the crop's ends, where the filter sees silence, a tone is the same tone at the new rate."""
    got = audio.crop(wav(sine(rate, 4), rate, 32, True), 1.5, 2.0)
    assert len(got) == 32_000
    start = int(1.5 * rate) / rate
    t = start + np.arange(32_000) / 16_000
    assert np.abs(got - 0.5 * np.sin(2 * math.pi * 440 * t))[200:-200].max() < 1e-3
    assert np.abs(audio.resampled(np.ones((1, rate)), rate, 16_000)[0, 100:-100] - 1).max() < 2e-3


def test_phases_are_a_plain_sum():
    """Each output sample beside the sum over all input samples of a windowed sinc at its distance."""
    r = np.random.default_rng(1)
    for rate, to in ((48_000, 16_000), (44_100, 16_000), (8000, 16_000)):
        x = r.normal(size=(2, 700))
        got = audio.resampled(x, rate, to)
        edge = min(rate, to) * audio.ROLL_OFF / rate
        away = (np.arange(700)[None, :] - np.arange(got.shape[1])[:, None] * rate / to) * edge
        inside = np.where(np.abs(away) < audio.CROSSINGS, np.cos(away * math.pi / 12) ** 2, 0)
        assert got.shape == (2, math.ceil(700 * to / rate)) and np.allclose(got, x @ (edge * np.sinc(away) * inside).T, atol=1e-9)


def test_what_is_above_the_new_half_rate_goes():
    high = audio.crop(wav(sine(48_000, 1, 12_000), 48_000, 32, True), 0.0, 1.0)
    assert np.abs(high[200:-200]).max() < 1e-3


def test_crops_are_short_only_at_the_end():
    data = wav(sine(16_000, 1), 16_000)
    assert len(audio.crop(data, 0.5, 30.0)) == 8000 and len(audio.crop(data, 0.0, 3600.0)) == 16_000 and len(audio.crop(data, 5.0, 1.0)) == 0
    cut = data[: len(data) // 2]
    assert len(audio.crop(cut, 0.0, 1.0)) < 8000


@pytest.mark.parametrize("data", [b"", b"RIFF", b"ID3 an mp3", wav(sine(8000, 0.1), 8000)[:40], wav([[0.0]], 8000).replace(b"\x01\x00\x01\x00", b"\x55\x00\x01\x00"), b"RIFF\0\0\0\0WAVEdata\4\0\0\0abcd"])
def test_other_files_are_errors(data):
    with pytest.raises(ValueError):
        audio.crop(data, 0.0, 1.0)


def test_crops_of_a_plan(spark, tmp_path):
    for name, rate in (("a", 48_000), ("b", 44_100)):
        (tmp_path / f"{name}.wav").write_bytes(wav(sine(rate, 3, channels=2), rate))
    (tmp_path / "c.wav").write_bytes(b"not audio")
    files = spark.read.format("binaryFile").load(str(tmp_path)).selectExpr("element_at(split(path, '/'), -1) as path", "content")
    plan = [("e", 0, "a.wav", 0.5, 1.0), ("e", 1, "a.wav", 2.5, 1.0), ("f", 0, "b.wav", 1.0, 0.5), ("g", 0, "c.wav", 0.0, 1.0), ("h", 0, "none.wav", 0.0, 1.0), ("i", 0, None, 0.0, 1.0), ("e", 2, "a.wav", None, 1.0), ("e", 3, "a.wav", float("nan"), 1.0), ("e", 4, "a.wav", -1.0, 1.0)]
    df = spark.createDataFrame(plan, "episode string, draw int, audio_path string, crop_start_s double, crop_length_s double")
    out = audio.cut_crops(df, files)
    assert out.columns == [*df.columns, "samples", "native_rate", "error", "error_kind"]
    got = {(r["episode"], r["draw"]): (len(r["samples"] or []), r["native_rate"], r["error_kind"]) for r in out.collect()}
    assert got == {("e", 0): (16_000, 48_000, None), ("e", 1): (8000, 48_000, None), ("f", 0): (8000, 44_100, None), ("g", 0): (0, None, "crop"), ("h", 0): (0, None, "download"), ("i", 0): (0, None, "download"), ("e", 2): (0, None, "crop"), ("e", 3): (0, None, "crop"), ("e", 4): (0, None, "crop")}
    assert audio.cut_crops(df.limit(0), files).collect() == []


def test_contents_are_not_broadcast(spark):
    """However small a table seems to Spark, of which each row becomes a file."""
    files = spark.range(300).selectExpr("cast(id as string) as path").withColumn("content", F.lit(wav(sine(8000, 0.1), 8000)))
    plan = spark.range(300).selectExpr("cast(id as string) as audio_path", "0.0D as crop_start_s", "0.05D as crop_length_s")
    out = audio.cut_crops(plan, files)
    assert out.where("size(samples) = 800").count() == 300
    shown = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in shown and "Broadcast" not in shown and "hashpartitioning(path_" in shown
