"""Removal of long strings that are found more than once, by suffix orders of the texts around shared anchors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .suffixorder import suffix_order

#: Bytes of a string that must not be found twice, and of an anchor in it.
WINDOW, ANCHOR = 200, 64
#: Texts of a bucket that one order takes; larger buckets are split and their parts compared.
BUCKET = 64
#: Bytes of texts that are measured at once, and symbols that are ordered at once.
PIECE, ORDERED = 1 << 18, 3 << 19
_PLACE = 20
_ANCHORS = "th long, h long, c long, lo long, n int"
_ORDERS = "h long, c long, runs array<int>, off int, w1 long, w2 long, alone boolean"


class _Hashes:
    """Hashes of any stretch of some bytes, by sums over prefixes."""

    def __init__(self, raw: np.ndarray) -> None:
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(common._BYTE[raw] * common.powers(len(raw), True), out=self.sums[1:])
        self.back = common.powers(len(raw) + 1, False)

    def all(self, size: int) -> np.ndarray:
        """Of the stretch of this size from each place on."""
        out = self.sums[size:] - self.sums[:-size]
        out *= self.back[: len(out)]
        return common.mix(out + np.uint64(size))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return common.mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of width values from each place on."""
    rows = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """The windows of texts that lie one after the other in raw, by their anchor: text, first window, number of windows, hash of the anchor, hash of all bytes from the first window's start to the last one's end.

    A window's anchor is the stretch of anchor bytes in it whose hash is least, the first of equals. It depends on the window's bytes alone, so that equal windows have equal anchors.
    """
    hashes = _Hashes(raw)
    each = hashes.all(anchor)
    mask = np.uint64((1 << _PLACE) - 1)
    least = _least((each & ~mask) | np.arange(len(each), dtype=np.uint64), window - anchor + 1)
    at = (least & mask).astype(np.int64)
    inside = np.ones(len(at), bool)
    for end in ends.tolist():  # windows that run into the next text
        inside[max(0, end - window + 1) : end] = False
    new = inside.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new)
    stop = np.flatnonzero(np.concatenate([inside[:-1] & (new[1:] | ~inside[1:]), inside[-1:]])) + 1
    text = np.searchsorted(begins, first, "right") - 1
    return text, first - begins[text], stop - first, each[at[first]], hashes.of(first, stop + window - 1)


def _measured(window: int, anchor: int):
    """Anchors of a batch's texts (id, hash, bytes); long texts in pieces that overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            places = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
            at = 0
            while at < len(column):
                # whole texts up to a piece's size; one that is longer goes in pieces
                to = max(at + 1, int(np.searchsorted(places, places[at] + PIECE, "right")) - 1)
                lo, hi = int(places[at]), int(places[to])
                for cut in range(lo, max(lo + 1, hi - window + 1), PIECE):
                    end = min(hi, cut + PIECE + window - 1) if to == at + 1 else hi
                    begins = places[at:to] - lo if to > at + 1 else np.zeros(1, np.int64)
                    stops = places[at + 1 : to + 1] - lo if to > at + 1 else np.array([end - cut])
                    if end - cut < window:
                        break
                    text, first, n, h, c = anchors(raw[cut:end], begins, stops, window, anchor)
                    if len(text):
                        took = batch.select([0, 1]).take(pa.array(text + at))
                        shift = cut - lo if to == at + 1 else 0
                        yield pa.RecordBatch.from_arrays([*took.columns, pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(first + shift), pa.array(n.astype(np.int32))], ["id", "th", "h", "c", "lo", "n"])
                    if to > at + 1:
                        break
                at = to

    return run


def _runs(marks: np.ndarray, owner: np.ndarray, count: int) -> pa.ListArray:
    """For each of count owners of consecutive marks, begins and ends of the runs of true ones, within the owner."""
    sizes = np.bincount(owner, minlength=count)
    starts = np.cumsum(sizes) - sizes
    edge = np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8))
    same = np.concatenate([owner[1:] == owner[:-1], [False]])
    begin = (edge[:-1] == 1) | (marks & ~np.concatenate([[False], same[:-1]]))
    end = marks & ((edge[1:] == -1) | ~same)
    a, b = np.flatnonzero(begin), np.flatnonzero(end) + 1
    flat = np.stack([a - starts[owner[a]], b - starts[owner[a]]], axis=1).ravel().astype(np.int32)
    per = 2 * np.bincount(owner[a], minlength=count)
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(per)]).astype(np.int32), pa.array(flat))


def _equal(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Which stretches of size bytes from a and from b on are equal: byte by byte."""
    seen = np.lib.stride_tricks.sliding_window_view(raw, size)
    out = np.zeros(len(a), bool)
    probe = np.linspace(0, size - 1, 4).astype(int)
    left = np.flatnonzero((raw[a[:, None] + probe] == raw[b[:, None] + probe]).all(axis=1))
    for at in range(0, len(left), 1 << 14):
        part = left[at : at + (1 << 14)]
        out[part] = (seen[a[part]] == seen[b[part]]).all(axis=1)
    return out


def _ordered(rows: list[tuple], window: int) -> pa.RecordBatch:
    """Which windows of the texts of whole buckets are found twice in their bucket. rows: h, sub, parts, c, k, bytes; buckets one after the other."""
    h, sub, parts, c, k = (np.array([r[i] for r in rows], np.int64) for i in range(5))
    sizes = np.array([len(r[5]) for r in rows])
    new = np.ones(len(rows), bool)
    new[1:] = (h[1:] != h[:-1]) | (sub[1:] != sub[:-1])
    bucket = np.cumsum(new) - 1
    # a 1 behind each text, a 0 behind each bucket
    last = np.append(new[1:], True)
    room = sizes + 1 + last
    begins = np.cumsum(room) - room
    text = np.ones(int(room.sum()), np.uint16)
    raw = np.zeros(len(text), np.uint8)
    joined = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
    where = np.arange(len(joined)) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
    raw[where] = joined
    text[where] = joined.astype(np.uint16) + 2
    text[(begins + room - 1)[last]] = 0
    order = suffix_order(text, begins[new])
    # windows in the order of their suffixes; equal ones are neighbours
    count = sizes - window + 1
    owner_at = np.full(len(text), -1, np.int32)
    starts = np.arange(int(count.sum())) + np.repeat(begins - (np.cumsum(count) - count), count)
    owner_at[starts] = np.repeat(np.arange(len(rows), dtype=np.int32), count)
    order = order[owner_at[order] >= 0].astype(np.int64)
    owner = owner_at[order]
    near = np.flatnonzero(bucket[owner[1:]] == bucket[owner[:-1]])
    follows = np.zeros(len(order), bool)  # equal to the one before
    follows[near + 1] = _equal(raw, order[near], order[near + 1], window)
    twice = follows.copy()
    twice[:-1] |= follows[1:]
    twice |= k[owner] > 1
    marks = np.zeros(len(text), bool)
    marks[order] = twice
    runs = _runs(marks[starts], owner_at[starts], len(rows))
    none = lambda n, kind: pa.nulls(n, kind)
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
    verdicts = [pa.array(h), pa.array(c), runs, *(none(len(rows), t) for t in kinds[3:])]
    # buckets that were split: one of each distinct window, to be compared with the other parts'
    shown = np.flatnonzero((parts[owner] > 1) & ~follows)
    at, by = order[shown], owner[shown]
    hashed = [x.of(at, at + window).view(np.int64) if len(at) else np.empty(0, np.int64) for x in ((_Hashes(raw), _Hashes(raw ^ 0x5A)) if len(at) else (None, None))]
    windows = [pa.array(h[by]), pa.array(c[by]), none(len(by), kinds[2]), pa.array((at - begins[by]).astype(np.int32)), *map(pa.array, hashed), pa.array(~twice[shown])]
    names = ["h", "c", "runs", "off", "w1", "w2", "alone"]
    return pa.RecordBatch.from_arrays([pa.concat_arrays([x.cast(t), y.cast(t)]) for x, y, t in zip(verdicts, windows, kinds)], names)


def _orders(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("h", "sub", "parts", "c", "k", "bytes"))):
                if size >= ORDERED and row[:2] != held[-1][:2]:
                    yield _ordered(held, window)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield _ordered(held, window)

    return run


def _cut(at: int, spans_at: int, names: list[str]):
    """Takes the bytes of the spans (arrays of begins and ends) out of a batch's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                texts = batch.column(at).cast(pa.binary()).fill_null(b"")
                places = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
                raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[places[0] : places[-1]]
                places = places - places[0]
                spans = batch.column(spans_at)
                owner = np.repeat(np.arange(len(texts)), spans.value_lengths().fill_null(0).to_numpy())
                flat = spans.flatten()
                a, b = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) + places[owner] for i in (0, 1))
                # merged: a run begins where no earlier span reaches
                by = np.argsort(a, kind="stable")
                a, b, owner = a[by], b[by], owner[by]
                reach = np.maximum.accumulate(b) if len(b) else b
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] > reach[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(new)
                a, b, owner = a[first], reach[np.append(first[1:], len(new)) - 1] if len(first) else b, owner[first]
                edges = np.zeros(len(raw) + 1, np.int8)
                np.add.at(edges, a, 1)
                np.add.at(edges, b, -1)
                keep = np.cumsum(edges[:-1], dtype=np.int8) == 0
                gone = np.concatenate([[0], np.cumsum(np.bincount(owner, b - a, len(texts)).astype(np.int64))])
                rest = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((places - gone).astype(np.int32).tobytes()), pa.py_buffer(raw[keep].tobytes())])
                runs = pa.StructArray.from_arrays([pa.array(a - places[owner]), pa.array(b - places[owner])], ["start", "end"])
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int32)
                columns = [batch.column(i) for i in range(batch.num_columns) if i != spans_at]
                yield pa.RecordBatch.from_arrays([*columns, rest, pa.ListArray.from_arrays(offsets, runs)], names)

    return run


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id_"]) & (a["th"] == b["th_"])


def repeats(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, bucket: int = BUCKET, written: Callable[[DataFrame, str], DataFrame] = common.written) -> DataFrame:
    """id, th, spans: for each document with a repeated string, the stretches (start, end in bytes; they overlap) of strings of window bytes that start anywhere else too.

    docs have id, th (a hash of the text) and bytes; rows with equal id and th count as copies of each other. See remove_repeats() for the method.
    """
    id_type = docs.schema["id"].dataType.simpleString()
    found = written(docs.where(F.length("bytes") >= window).mapInArrow(common.lean(_measured(window, anchor)), f"id {id_type}, {_ANCHORS}"), "anchors")
    tables = [found]

    def kept(df: DataFrame, name: str) -> DataFrame:
        tables.append(written(df, name))
        return tables[-1]

    often = kept(found.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h"), "often")  # a table, so that Spark can split a hot anchor's part of the join
    shared = kept(found.join(often, "h", "left_semi"), "shared")
    texts = kept(shared.groupBy("h", "c").agg(F.count("*").alias("k"), *(F.first(x).alias(x) for x in ("id", "th", "lo", "n"))), "around")
    varied = texts.groupBy("h").agg(F.count("*").alias("d"))
    several = texts.join(varied.where("d > 1"), "h").withColumn("parts", F.when(F.col("d") <= bucket * 3 / 2, 1).otherwise(F.ceil(F.col("d") / bucket)).cast("long"))
    several = kept(several.withColumn("sub", F.pmod(F.xxhash64("c"), F.col("parts"))), "several")
    wanted = several.groupBy("id", "th").agg(F.collect_list(F.struct("h", "sub", "parts", "d", "c", "k", "lo", "n")).alias("wanted")).withColumnsRenamed({"id": "id_", "th": "th_"})
    cut = docs.join(wanted, _same(docs, wanted)).select("bytes", F.explode("wanted").alias("w"))
    cut = cut.select("w.h", "w.sub", "w.parts", "w.d", "w.c", "w.k", F.substring("bytes", (F.col("w.lo") + 1).cast("int"), F.col("w.n") + (window - 1)).alias("bytes"))
    cut = cut.repartition("h", "sub").sortWithinPartitions(F.least("d", F.lit(bucket)), "h", "sub").select("h", "sub", "parts", "c", "k", "bytes")  # buckets of a size go through the steps together
    orders = kept(cut.mapInArrow(common.lean(_orders(window)), _ORDERS), "orders")

    windows = orders.where("w1 is not null")
    across = windows.groupBy("h", "w1", "w2").agg(F.count("*").alias("in_parts")).where("in_parts > 1").select("h", "w1", "w2")
    more = windows.where("alone").join(across, ["h", "w1", "w2"]).select("h", "c", F.array(F.col("off"), F.col("off") + 1).alias("runs"))
    single = texts.join(varied.where("d = 1"), "h", "left_semi").select("h", "c", F.array(F.lit(0), F.col("n")).alias("runs"))
    marked = orders.where("w1 is null and size(runs) > 0").select("h", "c", "runs").unionByName(single).unionByName(more)
    spans = shared.select("id", "th", "h", "c", "lo").join(marked, ["h", "c"])
    pairs = F.transform(F.sequence(F.lit(0), F.size("runs") - 2, F.lit(2)), lambda i: F.struct((F.col("lo") + F.get("runs", i)).alias("start"), (F.col("lo") + F.get("runs", i + 1) + (window - 1)).alias("end")))
    out = written(spans.select("id", "th", pairs.alias("pairs")).groupBy("id", "th").agg(F.flatten(F.collect_list("pairs")).alias("spans")), "spans")
    for table in tables:
        common.drop_written(table)
    return out


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the columns rest (the bytes that remain of the UTF-8 text) and removed (array of start, end) added; columns of these names give way.

    A byte is removed where a string of window bytes that covers it also starts anywhere else, in the same document too. Strings are judged on the input, and overlaps count.

    1. Each window of window bytes has an anchor: the stretch of anchor bytes in it with the least hash. The windows of a document that share one make a text around it. Equal windows have equal anchors, so only texts with an anchor that is found twice go on (bytes are not copied for it), and equal texts around one as their first, with their number.
    2. Texts around the same anchor make a bucket, whose suffixes are ordered by linear grouping (suffixorder.py). Windows that are equal, byte for byte, are neighbours then. One text alone needs no order: its windows are repeated as often as it is.
    3. A bucket of more than bucket texts is split; each part is ordered, and of each distinct window of a part one row, with 128 bits of hash, meets those of the other parts.
    4. Repeated windows become stretches of each document, which are merged and taken out.

    Shuffled are anchors (about one for 69 bytes), the texts twice, to meet what is known of them, and the bytes around anchors with several texts. Hot anchors are counted where they are read, meet one row in joins that Spark can split, and make parts of bounded size.
    Null text has no bytes; its rest is empty. Rows with equal id and text are copies of each other; ids may be null. Texts under window bytes stay whole. A rest may end within a character. An empty table gives no rows.
    """
    if not 0 < anchor <= window < PIECE or PIECE + window > 1 << _PLACE:
        raise ValueError("an anchor must fit into a window, and a window into a piece")
    common.ready(docs.sparkSession)
    own = [c for c in docs.columns if c.lower() not in {"rest", "removed"}]
    id_, text = common.col(id_col), common.col(text_col).cast("string")
    rows = docs.select(id_.alias("id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("bytes")).where("bytes is not null")
    spans = repeats(rows, window=window, anchor=anchor, bucket=bucket)
    k_id, k_th, k_spans, k_text = common.unused(docs, "k_id", "k_th", "k_spans", "k_text")
    spans = spans.toDF(k_id, k_th, k_spans)
    met = docs.select(*map(common.col, own), text.alias(k_text)).join(spans, id_.eqNullSafe(F.col(k_id)) & (F.xxhash64(F.col(k_text)) == F.col(k_th)), "left")
    met = met.select(*map(common.col, own), k_text, k_spans)
    schema = met.select(*map(common.col, own), k_text).withColumns({"rest": F.lit(b""), "removed": F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end")))}).schema
    names = [*own, k_text, "rest", "removed"]
    return met.mapInArrow(common.lean(_cut(len(own), len(own) + 1, names)), schema).drop(k_text)
