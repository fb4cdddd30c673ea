"""TIFF: a writer of grey pages, and a reader that walks image directories and gives one row per page."""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ready

#: Bytes of a batch that a worker hands back, about.
BATCH_BYTES = 8 << 20
#: Tags and codes of the TIFF 6.0 format.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, DESCRIPTION = 256, 257, 258, 259, 262, 270
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR, PREDICTOR = 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT = 322, 323, 324, 325, 339
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
NUMBERS = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i"}


def unpack_bits(data: bytes, most: int = sys.maxsize) -> bytes:
    out, i = bytearray(), 0
    while i < len(data) and len(out) < most:
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2 if n > 128 else 1
    return bytes(out)


def pack_bits(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        run = 1
        while run < 128 and i + run < n and data[i + run] == data[i]:
            run += 1
        if run > 2:
            out += bytes((257 - run, data[i]))
            i += run
            continue
        start = i
        while i < n and i - start < 128 and not (i + 2 < n and data[i] == data[i + 1] == data[i + 2]):
            i += 1
        out += bytes((i - start - 1,)) + data[start:i]
    return bytes(out)


def lzw_decode(data: bytes, most: int = sys.maxsize) -> bytes:
    """Codes of 9 to 12 bits, high bits first; widths grow one code early, 256 clears the table, 257 ends. No code is read once there are `most` bytes."""
    out, table = bytearray(), []
    width, before, held, bits = 9, b"", 0, 0
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & (1 << width) - 1
        if len(out) >= most:
            break
        if code == 257:
            break
        if code == 256:
            table, width, before = [bytes((i,)) for i in range(256)] + [b"", b""], 9, b""
            continue
        if not before:
            entry = table[code] if table else bytes((code,))
        else:
            if code > len(table):
                raise ValueError("an LZW code beyond the table")
            entry = table[code] if code < len(table) else before + before[:1]
            table.append(before + entry[:1])
        if not table:
            table = [bytes((i,)) for i in range(256)] + [b"", b""]
        out += entry
        before = entry
        size = len(table) + 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    out, held, bits = bytearray(), 0, 0

    def put(code: int, width: int) -> None:
        nonlocal held, bits
        held, bits = held << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
        held &= (1 << bits) - 1

    table = {bytes((i,)): i for i in range(256)}
    put(256, width := 9)
    size, word = 258, b""
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if longer in table:
            word = longer
            continue
        put(table[word], width)
        table[longer] = size
        size += 1
        if size == 4094:
            put(256, width)
            table, size, width = {bytes((k,)): k for k in range(256)}, 258, 9
        else:
            width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        word = data[i : i + 1]
    if word:
        put(table[word], width)
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    put(257, width)
    if bits:
        put(0, 8 - bits)
    return bytes(out)


def compress(data: bytes, code: int) -> bytes:
    return {NONE: bytes, DEFLATE: lambda d: zlib.compress(d, 6), LZW: lzw_encode, PACKBITS: pack_bits}[code](data)


def decompress(data: bytes, code: int, size: int) -> bytes:
    """The first `size` bytes of what data holds; raises ValueError if that is less. Nothing beyond them is unpacked, but for the end of a run."""
    if code == NONE:
        out = data
    elif code in (DEFLATE, OLD_DEFLATE):
        out = zlib.decompressobj().decompress(data, max(size, 1))
    elif code == LZW:
        out = lzw_decode(data, size)
    elif code == PACKBITS:
        out = unpack_bits(data, size)
    else:
        raise ValueError(f"compression {code} isn't read")
    if len(out) < size:
        raise ValueError(f"a strip or tile holds {len(out)} of {size} bytes")
    return out[:size]


def predict(rows: np.ndarray) -> np.ndarray:
    """Horizontal differences of rows x width x samples."""
    out = rows.copy()
    out[:, 1:] -= rows[:, :-1]
    return out


def unpredict(raw: bytes, height: int, width: int, samples: int, kind: np.dtype, predictor: int) -> np.ndarray:
    """The samples of a strip or tile, height x width x samples, with the predictor undone."""
    line = width * samples * kind.itemsize
    if predictor == 3:  # of floating point: bytes by significance, differences over the whole row
        b = np.frombuffer(raw, np.uint8, height * line).reshape(height, line)
        step = b.reshape(height, -1, samples)
        b = np.cumsum(step, axis=1, dtype=np.uint8).reshape(height, kind.itemsize, width * samples)
        return np.ascontiguousarray(b.transpose(0, 2, 1)).view(kind.newbyteorder(">")).reshape(height, width, samples).astype(kind.newbyteorder("="))
    data = np.frombuffer(raw, kind, height * width * samples).reshape(height, width, samples)
    if predictor == 2:
        return np.cumsum(data, axis=1, dtype=kind.newbyteorder("="))
    if predictor != 1:
        raise ValueError(f"predictor {predictor} isn't known")
    return data.astype(kind.newbyteorder("="))


def write_tiff(payload: bytes, *, width: int = 576, rows: int = 512, strip_rows: int = 64, compression: int = DEFLATE, predictor: int = 2, description: str = "") -> bytes:
    """payload, a positive multiple of width, as a little-endian TIFF of grey 8-bit pages of at most rows rows, in strips of strip_rows rows. The description stands on the first page."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for at in range(0, len(payload), width * rows):
        page = np.frombuffer(payload[at : at + width * rows], np.uint8).reshape(-1, width, 1)
        offsets, counts = [], []
        for top in range(0, len(page), strip_rows):
            strip = page[top : top + strip_rows]
            data = compress((predict(strip) if predictor == 2 else strip).tobytes(), compression)
            offsets.append(len(out))
            counts.append(len(data))
            out += data
        tags = [(WIDTH, 4, [width]), (LENGTH, 4, [len(page)]), (BITS, 3, [8]), (COMPRESSION, 3, [compression]), (PHOTOMETRIC, 3, [1])]
        if description and not at:
            tags.append((DESCRIPTION, 2, description.encode("ascii") + b"\0"))
        tags += [(STRIP_OFFSETS, 4, offsets), (SAMPLES, 3, [1]), (ROWS_PER_STRIP, 4, [strip_rows]), (STRIP_COUNTS, 4, counts), (PREDICTOR, 3, [predictor])]
        entries = []
        for tag, kind, values in tags:
            raw = values if kind == 2 else struct.pack(f"<{len(values)}{NUMBERS[kind]}", *values)
            if len(raw) > 4:
                out += b"\0" * (len(out) % 2)
                place = struct.pack("<I", len(out))
                out += raw
            else:
                place = raw.ljust(4, b"\0")
            entries.append(struct.pack("<HHI", tag, kind, len(values)) + place)
        out += b"\0" * (len(out) % 2)
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(entries)) + b"".join(entries) + b"\0\0\0\0"
        link = len(out) - 4
    return bytes(out)


#: The tags that are read; of others nothing is unpacked.
READ = {WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, DESCRIPTION, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT}
#: Those of them whose numbers of values are those of strips, tiles or samples; the rest has one value that counts.
MANY = {STRIP_OFFSETS, STRIP_COUNTS, TILE_OFFSETS, TILE_COUNTS, BITS, SAMPLE_FORMAT}


def directories(media: bytes) -> Iterator[dict[int, tuple]]:
    """The tags of each image directory that are read, in the order of the chain; it ends where it would go round.

    What directories say is bounded by the file that says it: their values together, which are unpacked one directory at a time, may not be larger than the file, nor may directories overlap, so that no small file stands for many or large ones. One that breaks this raises ValueError.
    """
    order = {b"II": "<", b"MM": ">"}.get(media[:2])
    if order is None or len(media) < 8 or struct.unpack_from(order + "H", media, 2)[0] != 42:
        raise ValueError("not a TIFF")
    at, seen, ends, left = struct.unpack_from(order + "I", media, 4)[0], set(), [], len(media)
    while at and at not in seen:
        seen.add(at)
        tags: dict[int, tuple] = {0: (order,)}
        (n,) = struct.unpack_from(order + "H", media, at)
        end = at + 6 + 12 * n
        near = bisect.bisect(ends, (at,))
        if near and ends[near - 1][1] > at or near < len(ends) and ends[near][0] < end:
            raise ValueError("directories overlap")
        ends.insert(near, (at, end))
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", media, at + 2 + 12 * i)
            if tag not in READ:
                continue
            if tag not in MANY and kind != 2:
                count = min(count, 1)
            size = SIZES.get(kind, 0) * count
            left -= size
            if tag in tags or left < 0:
                raise ValueError("a directory says more than its file holds")
            where = at + 10 + 12 * i if size <= 4 else struct.unpack_from(order + "I", media, at + 10 + 12 * i)[0]
            if kind == 2:
                tags[tag] = (media[where : where + count].rstrip(b"\0").decode("latin-1"),)
            elif kind in NUMBERS:
                tags[tag] = struct.unpack_from(f"{order}{count}{NUMBERS[kind]}", media, where)
        yield tags
        (at,) = struct.unpack_from(order + "I", media, at + 2 + 12 * n)


def page_samples(media: bytes, tags: dict[int, tuple], max_bytes: int = 1 << 28) -> np.ndarray:
    """The samples of a page, height x width x samples. A page whose samples would take more than max_bytes, or that lacks strips, tiles or bytes of them, raises ValueError."""
    one = lambda tag, default: tags.get(tag, (default,))[0]
    width, height, samples, bits = one(WIDTH, 0), one(LENGTH, 0), one(SAMPLES, 1), one(BITS, 1)
    code, predictor, apart = one(COMPRESSION, 1), one(PREDICTOR, 1), one(PLANAR, 1) == 2 and samples > 1
    if bits not in (1, 2, 4, 8, 16, 32) or len(set(tags.get(BITS, (1,)))) > 1 or min(width, height, samples) < 1:
        raise ValueError("no size, or samples of sizes that aren't read")
    if bits < 8 and predictor != 1:
        raise ValueError(f"predictor {predictor} is for whole bytes")
    kind = np.dtype({1: "u", 2: "i", 3: "f"}.get(one(SAMPLE_FORMAT, 1), "u") + str(max(bits, 8) // 8)).newbyteorder(tags[0][0])
    if width * height * samples * kind.itemsize > max_bytes:
        raise ValueError(f"a page of {width} x {height} x {samples} samples is over {max_bytes} bytes")
    tiles = TILE_OFFSETS in tags
    wide, tall = (one(TILE_WIDTH, 0), one(TILE_LENGTH, 0)) if tiles else (width, min(one(ROWS_PER_STRIP, height), height))
    if min(wide, tall) < 1 or wide * tall * samples * kind.itemsize > 4 * max_bytes:
        raise ValueError(f"strips or tiles of {wide} x {tall} samples")
    across, down, planes = -(-width // wide), -(-height // tall), samples if apart else 1
    offsets, counts = (tags[TILE_OFFSETS], tags[TILE_COUNTS]) if tiles else (tags[STRIP_OFFSETS], tags[STRIP_COUNTS])
    if min(len(offsets), len(counts)) < across * down * planes:
        raise ValueError(f"{min(len(offsets), len(counts))} of {across * down * planes} strips or tiles")
    deep = 1 if apart else samples
    out = np.empty((height, width, samples), kind.newbyteorder("="))
    for i, (start, count) in enumerate(itertools.islice(zip(offsets, counts), across * down * planes)):
        plane, place = divmod(i, across * down)
        top, left = place // across * tall, place % across * wide
        rows = tall if tiles else min(tall, height - top)
        if start + count > len(media):
            raise ValueError(f"a strip or tile at {start} ends beyond the file")
        if bits < 8:
            line = -(-wide * deep * bits // 8)
            packed = np.frombuffer(decompress(media[start : start + count], code, rows * line), np.uint8).reshape(rows, line)
            shifts = np.arange(8 - bits, -1, -bits, dtype=np.uint8)
            part = (packed[:, :, None] >> shifts & np.uint8((1 << bits) - 1)).reshape(rows, -1)[:, : wide * deep].reshape(rows, wide, deep)
        else:
            part = unpredict(decompress(media[start : start + count], code, rows * wide * deep * kind.itemsize), rows, wide, deep, kind, predictor)
        part = part[: height - top, : width - left]
        out[top : top + len(part), left : left + part.shape[1], plane if apart else slice(None)] = part[:, :, 0] if apart else part
    return out


def _batches(rows: Iterator[tuple], kinds: list[tuple[str, pa.DataType]], size: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows, each closed at about BATCH_BYTES of the column number size."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += len(row[size] or b"")
        if held >= BATCH_BYTES or len(out) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*out), kinds)], [n for n, _ in kinds])
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*out), kinds)], [n for n, _ in kinds])


def write_pages(docs: DataFrame, *, width: int = 576, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, media): each whole text as UTF-8, filled up with bytes 255 to a positive multiple of width, as a deflated TIFF with horizontal differences. Its description holds the text's own byte count.

    Null text counts as empty. Null and repeated ids are written row by row. An empty table gives no rows. Columns besides the two are not read.
    """
    ready(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:

            def rows() -> Iterator[tuple]:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):  # noqa: B023
                    raw = (text.as_py() or "").encode()
                    yield doc, write_tiff(raw + b"\xff" * (-len(raw) % width or (0 if raw else width)), width=width, description=f"n_bytes={len(raw)}")

            yield from _batches(rows(), [("doc_id", batch.schema.field(0).type), ("media", pa.binary())], 1)

    out = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(lean(run), f"doc_id {kind}, media binary")
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)


PAGES = [("page", "long", pa.int64()), ("n_pages", "long", pa.int64()), ("width", "long", pa.int64()), ("height", "long", pa.int64()), ("samples", "long", pa.int64()), ("bits", "long", pa.int64()), ("description", "string", pa.string()), ("media_bytes", "long", pa.int64()), ("media_sha256", "string", pa.string()), ("pixels", "binary", pa.binary()), ("error", "string", pa.string())]


def read_pages(media: DataFrame, *, max_page_bytes: int = 1 << 28, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row per page of each TIFF, in the order of its directories: id_col, page (from 0), n_pages, width, height, samples, bits, description, media_bytes, media_sha256, pixels (samples in native order, row by row), error.

    Strips and tiles, in either byte order; no compression, PackBits, LZW and deflate; no predictor, horizontal differences and the floating-point one; samples of 1, 2 and 4 bits (given as bytes), 8, 16 and 32 bits, side by side or in planes of their own. Rows are read one by one.
    A page has an error and null pixels if it can't be read, lacks strips, tiles or any bytes of them, or has samples of more than max_page_bytes; no more than these is ever unpacked. A chain of directories that breaks off gives one row more, after the pages that were found, with an error; so bytes that are no TIFF, null and empty ones included, give just that row, with page 0.
    """
    ready(media.sparkSession)
    kind = media.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pages(doc, data: bytes | None) -> Iterator[tuple]:
            sha, size = hashlib.sha256(data or b"").hexdigest(), len(data or b"")
            found, wrong = [], ""
            try:
                for tags in directories(data or b""):
                    found.append(tags)
            except (ValueError, struct.error, OverflowError, MemoryError) as e:
                wrong = str(e) or type(e).__name__
            for i, tags in enumerate(found):
                one = lambda tag, default=None: tags.get(tag, (default,))[0]  # noqa: B023, E731
                pixels, error = None, None
                try:
                    pixels = page_samples(data, tags, max_page_bytes).tobytes()
                except (ValueError, KeyError, IndexError, struct.error, zlib.error, TypeError, OverflowError, MemoryError) as e:
                    error = str(e) or type(e).__name__
                yield doc, i, len(found), one(WIDTH), one(LENGTH), one(SAMPLES, 1), one(BITS, 1), one(DESCRIPTION), size, sha, pixels, error
            if wrong:
                yield doc, len(found), len(found), None, None, None, None, None, size, sha, None, wrong

        for batch in batches:
            rows = (row for doc, data in zip(batch.column(0).to_pylist(), batch.column(1)) for row in pages(doc, data.as_py()))  # noqa: B023
            yield from _batches(rows, [("doc_id", batch.schema.field(0).type), *((n, k) for n, _, k in PAGES)], 10)

    out = media.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{media_col}`").alias("media")).mapInArrow(lean(run), f"doc_id {kind}, " + ", ".join(f"{n} {t}" for n, t, _ in PAGES))
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)


DIGEST = [("n_bytes", "long", pa.int64()), ("payload_bytes", "long", pa.int64()), ("payload_sha256", "string", pa.string()), ("tail_crc32", "long", pa.int64()), ("media_bytes", "long", pa.int64()), ("media_sha256", "string", pa.string()), ("feature", "string", pa.string()), ("error", "string", pa.string())]


def digest(pages: DataFrame) -> DataFrame:
    """One row per TIFF of read_pages, which keeps a TIFF's pages together: n_bytes (from the description), payload_bytes, payload_sha256 and tail_crc32 (of the last 32 bytes) of all pages' pixels, media_bytes, media_sha256, feature (pages, mean and most common sample, each as a whole number), error. A TIFF with an error in any row has the first one and nulls for what comes from pixels; one without a byte count in its description has a null n_bytes."""
    ready(pages.sparkSession)
    kind = pages.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []
        out: list[tuple] = []
        schema = None

        def close() -> None:
            doc, note, sha, tail, n, counts, size, media_sha, n_pages, error = state
            n_bytes = int(note[8:]) if note and re.fullmatch("n_bytes=[0-9]{1,18}", note) else None
            if error:
                out.append((doc, n_bytes, None, None, None, size, media_sha, None, error))
                return
            total = int((counts * np.arange(256)).sum())
            out.append((doc, n_bytes, n, sha.hexdigest(), zlib.crc32(tail), size, media_sha, f"pages={n_pages};mean={total // max(n, 1)};mode={int(counts.argmax())}", None))

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [schema.field(0).type, *(k for _, _, k in DIGEST)])], ["doc_id", *(n for n, _, _ in DIGEST)])

        for batch in batches:
            schema = batch.schema
            at = {n: i for i, n in enumerate(schema.names)}
            for i, (doc, page) in enumerate(zip(batch.column(0).to_pylist(), batch.column(at["page"]).to_pylist())):
                get = lambda n: batch.column(at[n])[i].as_py()  # noqa: B023, E731
                if page == 0:
                    if state:
                        close()
                    state[:] = [doc, get("description"), hashlib.sha256(), b"", 0, np.zeros(256, np.int64), get("media_bytes"), get("media_sha256"), get("n_pages"), None]
                pixels, error = get("pixels"), get("error")
                if pixels is None:
                    state[9] = state[9] or error or "no pixels"
                    continue
                state[2].update(pixels)
                state[3] = (state[3] + pixels[-32:])[-32:]
                state[4] += len(pixels)
                state[5] += np.bincount(np.frombuffer(pixels, np.uint8), minlength=256)
            if len(out) >= 4096:
                yield batch_of()
                out = []
        if state:
            close()
        if out:
            yield batch_of()

    return pages.mapInArrow(lean(run), f"doc_id {kind}, " + ", ".join(f"{n} {t}" for n, t, _ in DIGEST))
