"""TIFF: what is damaged has an error and no pixels; small samples and planes; the query against a plain version."""

import hashlib
import random
import struct
import tracemalloc
import time
import zlib

import numpy as np
import pytest

from talkmill.llm import queries, tiff


def one_page(tags, data, order="<"):
    """A TIFF of one page from tags {tag: (kind, values)}; data stands at place 8, values after it."""
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0)) + data
    entries = b""
    for tag, (kind, values) in sorted(tags.items()):
        raw = struct.pack(f"{order}{len(values)}{tiff.NUMBERS[kind]}", *values)
        place = raw.ljust(4, b"\0")
        if len(raw) > 4:
            place = struct.pack(order + "I", len(out))
            out += raw
        entries += struct.pack(order + "HHI", tag, kind, len(values)) + place
    struct.pack_into(order + "I", out, 4, len(out))
    return bytes(out + struct.pack(order + "H", len(tags)) + entries + b"\0\0\0\0")


def grey(width, height, parts, code=tiff.NONE, rows=None, **more):
    offsets = np.cumsum([8, *map(len, parts)]).tolist()[:-1]
    tags = {256: (4, [width]), 257: (4, [height]), 258: (3, [8]), 259: (3, [code]), 273: (4, offsets), 278: (4, [rows or height]), 279: (4, list(map(len, parts)))} | {int(k[1:]): v for k, v in more.items()}
    return one_page(tags, b"".join(parts))


BOMB = zlib.compress(b"\0" * 50_000_000, 9)
DAMAGED = {
    "a short strip": grey(10, 10, [b"x" * 40]),
    "a short packed strip": grey(10, 10, [tiff.pack_bits(b"x" * 46)], tiff.PACKBITS),
    "a short LZW strip": grey(10, 10, [tiff.lzw_encode(b"x" * 46)], tiff.LZW),
    "a cut deflate strip": grey(10, 10, [zlib.compress(bytes(range(100)))[:-30]], tiff.DEFLATE),
    "noise for deflate": grey(10, 10, [b"\xff" * 60], tiff.DEFLATE),
    "a strip too few": grey(10, 10, [b"x" * 50], rows=5),
    "an offset past the end": grey(10, 10, [b"x" * 100], _273=(4, [10**6])),
    "a count past the end": grey(10, 10, [b"x" * 100], _279=(4, [10**9])),
    "a giant": grey(1 << 24, 1 << 30, [b"x" * 100]),
    "a wide giant": grey(1 << 31, 1, [BOMB], tiff.DEFLATE),
    "no width": grey(0, 10, [b""]),
    "giant tiles": grey(10, 10, [b"x"], _322=(4, [1 << 30]), _323=(4, [1 << 30]), _324=(4, [8]), _325=(4, [1])),
    "an unknown compression": grey(10, 10, [b"x" * 100], 7),
    "an unknown predictor": grey(10, 10, [b"x" * 100], _317=(3, [9])),
    "samples of two sizes": grey(10, 10, [b"x" * 300], _258=(3, [8, 16, 8]), _277=(3, [3])),
    "a giant count of values": grey(10, 10, [b"x" * 100])[:-60] + b"\xff" * 40,
    "null": None,
    "empty": b"",
    "junk": b"II*\0\xff\xff\xff\x7f",
}


def test_what_is_damaged_has_an_error(spark):
    began = time.time()
    df = spark.createDataFrame([(k, v) for k, v in DAMAGED.items()], "doc_id string, media binary")
    rows = tiff.read_pages(df).collect()
    assert {r["doc_id"] for r in rows} == set(DAMAGED) and all(r["error"] and r["pixels"] is None for r in rows)
    found = {r["doc_id"]: r for r in tiff.digest(tiff.read_pages(df)).collect()}
    assert set(found) == set(DAMAGED) and all(r["error"] and r["payload_sha256"] is None for r in found.values())
    assert found["null"]["media_bytes"] == 0 and time.time() - began < 60


def test_more_bytes_than_needed_are_not_unpacked():
    media = grey(10, 10, [BOMB], tiff.DEFLATE)
    (tags,) = tiff.directories(media)
    assert not tiff.page_samples(media, tags).any()
    assert len(tiff.unpack_bits(tiff.pack_bits(b"x" * 10_000), 100)) < 300 and len(tiff.lzw_decode(tiff.lzw_encode(b"xy" * 10_000), 100)) < 400


def test_pages_before_a_break_stay(spark):
    good = bytearray(tiff.write_tiff(bytes(range(200)) * 3, width=60, rows=5))
    last = struct.unpack_from("<I", good, 4)[0]
    (n,) = struct.unpack_from("<H", good, last)
    struct.pack_into("<I", good, last + 2 + 12 * n, len(good) + 1000)
    rows = tiff.read_pages(spark.createDataFrame([(1, good)], "doc_id int, media binary")).collect()
    assert [(r["page"], bool(r["error"]), r["pixels"] is None) for r in rows] == [(0, False, False), (1, True, True)]
    assert [(r["error"] is None, r["payload_bytes"]) for r in tiff.digest(tiff.read_pages(spark.createDataFrame([(1, good)], "doc_id int, media binary"))).collect()] == [(False, None)]


@pytest.mark.parametrize("bits", [1, 2, 4])
@pytest.mark.parametrize("samples", [1, 3])
def test_samples_smaller_than_a_byte(bits, samples):
    a = np.random.default_rng(bits).integers(0, 1 << bits, (7, 13, samples), np.uint8)
    lines = [b"".join(int("".join(format(v, f"0{bits}b") for v in row.ravel()).ljust(-(-13 * samples * bits // 8) * 8, "0"), 2).to_bytes(-(-13 * samples * bits // 8), "big") for row in a[top : top + 4]) for top in (0, 4)]
    media = grey(13, 7, [tiff.pack_bits(x) for x in lines], tiff.PACKBITS, rows=4, _258=(3, [bits] * samples), _277=(3, [samples]))
    (tags,) = tiff.directories(media)
    assert (tiff.page_samples(media, tags) == a).all()


@pytest.mark.parametrize("predictor", [1, 2])
def test_planes(predictor):
    a = np.random.default_rng(3).integers(0, 256, (9, 5, 3), np.uint8)
    strips = [a[top : top + 4, :, [k]] for k in range(3) for top in (0, 4, 8)]
    parts = [zlib.compress((tiff.predict(x) if predictor == 2 else x).tobytes()) for x in strips]
    media = grey(5, 9, parts, tiff.DEFLATE, rows=4, _258=(3, [8, 8, 8]), _277=(3, [3]), _284=(3, [2]), _317=(3, [predictor]))
    (tags,) = tiff.directories(media)
    assert (tiff.page_samples(media, tags) == a).all()


def test_a_tiff_without_a_byte_count(spark):
    media = tiff.write_tiff(b"ab" * 300, width=60, description="a picture")
    (r,) = tiff.digest(tiff.read_pages(spark.createDataFrame([(1, media)], "doc_id int, media binary"))).collect()
    assert (r["n_bytes"], r["payload_bytes"], r["error"]) == (None, 600, None)


def test_the_query_against_a_plain_version(spark, tmp_path):
    r = random.Random(2)
    texts = [None, "", "é" * 288, "x" * 575, "x" * 577, *("".join(r.choices("abc äß日🙂\n", k=r.choice([5, 600, 400_000]))) for _ in range(12))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {x["doc_id"]: x for x in queries.op9_tiff_pages(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        padded = raw + b"\xff" * ((-len(raw)) % 576 or (0 if raw else 576))
        media = tiff.write_tiff(padded, description=f"n_bytes={len(raw)}")
        counts = np.bincount(np.frombuffer(padded, np.uint8), minlength=256)
        x = rows[i]
        assert (x["n_bytes"], x["payload_bytes"], x["payload_sha256"], x["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
        assert (x["media_bytes"], x["media_sha256"], x["error"]) == (len(media), hashlib.sha256(media).hexdigest(), None)
        assert x["feature"] == f"pages={-(-len(padded) // (576 * 512))};mean={sum(padded) // len(padded)};mode={int(counts.argmax())}"


def bomb(n_tags, count, directories=1, overlap=False):
    """A TIFF whose directories have many tags of many values, all of which lie in the same place."""
    body = bytearray(b"II*\0\0\0\0\0") + bytes(4 * count)
    link, place = 4, 8
    for d in range(directories):
        at = len(body)
        struct.pack_into("<I", body, link, at)
        tags = [256, 257, 258, 273, 279, 324, 325, 339][:8] * -(-n_tags // 8)
        entries = b"".join(struct.pack("<HHII", tag if i < 8 else 40_000 + i % 20_000, 4, count, place) for i, tag in enumerate(tags[:n_tags]))
        body += struct.pack("<H", n_tags) + entries + b"\0\0\0\0"
        link = len(body) - 4
        if overlap:
            struct.pack_into("<I", body, link, at + 12)
            break
    return bytes(body)


@pytest.mark.parametrize("media", [bomb(8, 200_000), bomb(40, 200_000), bomb(60_000, 50_000), bomb(3, 100_000, 40), bomb(30, 10, 1, True)])
def test_small_files_stand_for_no_large_ones(spark, media):
    """Tags that point at the same numbers, in one directory or in many, and directories that overlap: an error within bounded memory."""
    tracemalloc.start()
    with pytest.raises((ValueError, struct.error)):
        for _ in tiff.directories(media):
            pass
    assert tracemalloc.get_traced_memory()[1] < 50e6
    tracemalloc.stop()
    rows = tiff.read_pages(spark.createDataFrame([(1, media)], "doc_id long, media binary")).collect()
    assert rows and rows[-1]["error"] and all(r["pixels"] is None for r in rows)


def test_tags_that_are_not_read_cost_nothing():
    good = tiff.write_tiff(bytes(range(200)) * 6, width=20)
    at = struct.unpack_from("<I", good, 4)[0]
    (n,) = struct.unpack_from("<H", good, at)
    body = bytearray(good)
    struct.pack_into("<I", body, 4, len(body))
    body += struct.pack("<H", n + 1) + good[at + 2 : at + 2 + 12 * n] + struct.pack("<HHII", 50_000, 4, 1 << 30, 0) + b"\0\0\0\0"
    (tags,) = tiff.directories(bytes(body))
    assert 50_000 not in tags and tiff.page_samples(bytes(body), tags).tobytes() == bytes(range(200)) * 6
