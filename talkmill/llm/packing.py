"""Harmonic packing of token sequences into fixed-length training sequences."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ready

#: Words whose ids a worker remembers, about, and the bytes of the longest one of them, so that memory is bounded: some 200 MB if all were that long. Others are encoded anew in each batch.
CACHE_WORDS, CACHE_BYTES = 400_000, 48
#: Rows and ids in a batch that a worker hands back, at most about.
BATCH_ROWS, BATCH_IDS = 4096, 1 << 20

_tokenizers: dict[str, tuple] = {}


class WordIds:
    """Ids of texts by one tokenizer that lower-cases, drops white space and marks the last id of a word, so that a text's ids are those of its words in turn; ids of words are remembered.

    Texts in which a special token is spelled out are encoded whole. Ids are kept as bytes of 32-bit numbers.
    """

    #: Punctuation between an ASCII letter and white space, which the tokenizer cuts off as one word.
    TAIL = re.compile(rb"[!-/:-@\[-`{-~](?<=[a-z].)[!-/:-@\[-`{-~]*(?=[ \t-\r]|\Z)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab()
        self.last = np.zeros(max(names.values()) + 1, bool)
        self.last[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def _letters(self, new: list[bytes], to: dict[bytes, bytes]) -> list[bytes]:
        """Encodes words of letters alone, many at once: each ends where an id is marked so. Gives back those for which that doesn't hold."""
        left = []
        for at in range(0, len(new), 1000):
            group = new[at : at + 1000]
            (encoded,) = self.tokenizer.encode_batch_fast([b"\n".join(group).decode()], add_special_tokens=False)
            ids = np.array(encoded.ids, "<i4")
            ends = (np.flatnonzero(self.last[ids]) + 1) * 4
            if len(ends) != len(group) or len(ids) * 4 != ends[-1]:
                left += group
                continue
            raw, start = ids.tobytes(), 0
            for word, end in zip(group, ends.tolist()):
                to[word] = raw[start:end]
                start = end
        return left

    def _others(self, new: list[bytes], to: dict[bytes, bytes]) -> None:
        for at in range(0, len(new), 512):
            group = new[at : at + 512]
            part = [w.decode() for w in group]
            starts = np.cumsum([0, *(len(w) + 1 for w in part)])
            encoded = self.tokenizer.encode("\n".join(part), add_special_tokens=False)
            owner = np.searchsorted(starts, [o[0] for o in encoded.offsets], "right") - 1
            cut = (np.searchsorted(owner, np.arange(len(part) + 1)) * 4).tolist()
            raw = np.array(encoded.ids, "<i4").tobytes()
            to.update((w, raw[cut[i] : cut[i + 1]]) for i, w in enumerate(group))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        split = []
        for text in texts:
            raw = text.encode().lower()
            split.append(None if any(s in raw for s in self.special) else self.TAIL.sub(rb" \g<0>", raw).split())
        known = self.known
        new = list({w for words in split if words for w in words}.difference(known))
        if new:
            letters = [w for w in new if w.decode().isalpha()]
            self._others([*set(new).difference(letters), *self._letters(letters, known)], known)
        out = []
        for text, words in zip(texts, split):
            if words is None:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32))
            else:
                out.append(np.frombuffer(b"".join(map(known.__getitem__, words)), "<i4"))
        full = len(known) > CACHE_WORDS
        for word in new:
            if full or len(word) > CACHE_BYTES:
                del known[word]
        return out


def tokenizer(path: str) -> WordIds:
    """The tokenizer of this worker; tasks of one worker share it."""
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


def encoded_parts(texts: pa.Array, encode: WordIds) -> Iterator[np.ndarray]:
    """The ids of each text; null counts as empty. Two MB of texts or so are taken at once."""
    part, size = [], 0
    for text in texts:
        part.append(text.as_py() or "")
        size += len(part[-1])
        if size >= 2 << 20:
            yield from encode(part)
            part, size = [], 0
    yield from encode(part)


class Bins:
    """The bins of one worker.

    Documents of more than capacity / (k + 1) and at most capacity / k ids are class k; a bin is begun with just k of a class. What room it then has is filled, first by documents that fit whole: those that wait in smaller classes, then those to come. Up to WAIT bins stay open for that. Only what remains after that is filled by cutting: ends of documents longer than the capacity first, else a bin is given up for the others. No cut leaves less than least ids on either side. Documents of class SMALL and above share a class, whose bins take what fits.
    """

    SMALL, WAIT = 64, 32

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id, self.least = capacity, first_id, max(1, capacity // 64)
        #: Pieces are (document, start, ids, ids of the document). open: by class; small: ids in the last class.
        self.open: dict[int, list[tuple]] = {}
        self.small = 0
        #: Pieces that may be cut, and the number of their ids.
        self.stock: list[tuple] = []
        self.stocked = 0
        #: [room, pieces] of bins that aren't full; and of the one that misses most of those that miss less than least.
        self.waiting: list[list] = []
        self.spare: list | None = None

    def put(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        """Takes a document; gives the pieces of the bins that this closes, with sequence and offset."""
        total, at, c = len(ids), 0, self.capacity
        if total <= c:
            yield from self._whole((doc, 0, ids, total))
            return
        while total - at >= c + self.least or total - at == c:
            yield from self._closed([(doc, at, ids[at : at + c], total)])
            at += c
        if total - at > c:  # too little would be left for a piece
            size = total - at - self.least
            yield from self._whole((doc, at, ids[at : at + size].copy(), total))
            at += size
        if at < total:
            piece = (doc, at, ids[at:].copy(), total)
            if self.stocked < 4 * c:
                self._stock(piece)
                yield from self._served()
            else:
                yield from self._whole(piece)

    def _closed(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, ids, total, self.next_id, offset
            offset += len(ids)
        self.next_id += 1

    def _done(self, room: int, pieces: list[tuple]) -> Iterator[tuple]:
        """Closes a bin, or keeps it for the last few ids in the place of the one kept so far."""
        if room > (self.spare[0] if self.spare else 0):
            before, self.spare = self.spare, [room, pieces]
            if before:
                yield from self._closed(before[1])
        else:
            yield from self._closed(pieces)

    def _whole(self, piece: tuple) -> Iterator[tuple]:
        n = len(piece[2])
        best = min((b for b in self.waiting if b[0] >= n), key=lambda b: b[0], default=None)
        if best:
            best[0] -= n
            best[1].append(piece)
            if best[0] < self.least:
                self.waiting.remove(best)
                yield from self._done(*best)
            return
        k = min(self.capacity // n, self.SMALL)
        mine = self.open.setdefault(k, [])
        if k == self.SMALL:
            if self.small + n > self.capacity:
                room, full = self.capacity - self.small, mine
                self.open[k], self.small = [], 0
                yield from self._begun(room, full)
                mine = self.open.setdefault(k, [])
            self.small += n
        mine.append(piece)
        if len(mine) == k < self.SMALL:
            del self.open[k]
            yield from self._begun(self.capacity - sum(len(p[2]) for p in mine), mine)

    def _begun(self, room: int, pieces: list[tuple]) -> Iterator[tuple]:
        """A bin with its fixed count: takes what waits in smaller classes, then waits itself."""
        while room >= self.least:
            piece = self._fitting(room)
            if not piece:
                break
            pieces.append(piece)
            room -= len(piece[2])
        if room < self.least:
            yield from self._done(room, pieces)
            return
        self.waiting.append([room, pieces])
        yield from self._served()
        if len(self.waiting) > self.WAIT:
            emptiest = max(self.waiting, key=lambda b: b[0])
            self.waiting.remove(emptiest)
            for piece in emptiest[1]:
                self._stock(piece)
            yield from self._served()

    def _fitting(self, room: int) -> tuple | None:
        """The largest piece, about, of those that wait in classes and fit."""
        for k in sorted(self.open):
            if k >= self.capacity // room:
                mine = self.open[k]
                at = max((i for i, p in enumerate(mine) if len(p[2]) <= room), key=lambda i: len(mine[i][2]), default=None)
                if at is not None:
                    piece = mine.pop(at)
                    self.small -= len(piece[2]) * (k == self.SMALL)
                    if not mine:
                        del self.open[k]
                    return piece
        return None

    def _stock(self, piece: tuple) -> None:
        self.stock.append(piece)
        self.stocked += len(piece[2])

    def _served(self) -> Iterator[tuple]:
        """Fills the waiting bins from the stock, fullest first."""
        for waiting in sorted(self.waiting, key=lambda b: b[0]):
            if not self.stock:
                return
            self._fill(waiting)
            if waiting[0] < self.least:
                self.waiting.remove(waiting)
                yield from self._done(*waiting)

    def _fill(self, waiting: list) -> None:
        """Takes pieces out of the stock into a bin: whole where they fit, else cut so that neither part is too short."""
        for i in range(len(self.stock) - 1, -1, -1):
            room = waiting[0]
            if room < self.least:
                return
            doc, start, ids, total = self.stock[i]
            take = len(ids) if len(ids) <= room else min(room, len(ids) - self.least)
            if take < min(self.least, len(ids)):
                continue
            waiting[1].append((doc, start, ids[:take], total))
            waiting[0] -= take
            self.stocked -= take
            if take == len(ids):
                del self.stock[i]
            else:
                self.stock[i] = (doc, start + take, ids[take:], total)

    def rest(self) -> Iterator[tuple]:
        """What is left when all documents are in: pieces go, largest first, where they fit best; then the emptiest bins are given up for the others, until one is left. That one is cut at powers of two, which need no padding; what remains of it fits into the bin that was kept, or goes on by powers of two. So a worker pads less than least ids a bin, and cuts a few documents at its end."""
        pieces = sorted([*self.stock, *(p for mine in self.open.values() for p in mine)], key=lambda p: -len(p[2]))
        self.stock, self.stocked, self.open, self.small = [], 0, {}, 0
        bins, self.waiting = self.waiting, []
        for piece in pieces:
            n = len(piece[2])
            best = min((b for b in bins if b[0] >= n), key=lambda b: b[0], default=None)
            if best is None:
                bins.append([self.capacity - n, [piece]])
            else:
                best[0] -= n
                best[1].append(piece)
        bins.sort(key=lambda b: b[0])
        while len(bins) > 1 and bins[-1][0] >= self.least:
            for piece in bins.pop()[1]:
                self._stock(piece)
            for b in bins:
                if b[0] >= self.least:
                    self._fill(b)
            if self.stock:  # the others are full, or so nearly that no cut fits
                left, self.stock, self.stocked = self.stock, [], 0
                bins = [*sorted(bins, key=lambda b: b[0]), [self.capacity - sum(len(p[2]) for p in left), left]]
                if bins[-1][0] < 0 or all(b[0] < 2 * self.least for b in bins[:-1]):
                    break
        last = bins.pop() if bins and bins[-1][0] >= self.least else [self.capacity, []]
        for b in bins:
            yield from self._done(*b)
        yield from self._tail(last[1])
        if self.spare:
            yield from self._closed(self.spare[1])

    def _tail(self, pieces: list[tuple]) -> Iterator[tuple]:
        left = sum(len(p[2]) for p in pieces)
        while left:
            if self.spare and left <= min(self.spare[0], self.least):
                self.spare[1] += pieces
                self.spare[0] -= left
                return
            size = min(self.capacity, 1 << (left.bit_length() - 1))
            left -= size
            out = []
            while size:
                fair = lambda n: (n == size or n >= size + self.least, n <= size - self.least, n)  # noqa: B023, E731
                doc, start, ids, total = pieces.pop(max(range(len(pieces)), key=lambda i: fair(len(pieces[i][2]))))
                out.append((doc, start, ids[:size], total))
                if len(ids) > size:
                    pieces.append((doc, start + size, ids[size:], total))
                size -= len(out[-1][2])
            yield from self._closed(out)


def pack(docs: DataFrame, *, tokenizer_path: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs all documents into sequences of at most capacity ids. One row for each piece: id_col, start, length, ids, doc_tokens, sequence_id, offset.

    Method: Harmonic packing (Bins). Documents of capacity / (k + 1) to capacity / k ids are a class, whose bins begin with k of them; the room that leaves is filled by smaller documents and, last, by cutting. Each worker fills its own bins, so that no rows move between workers; memory holds one open bin a class and those that wait to be filled.
    sequence_id is the worker's task number times 2**32 plus a count. Padding: less than capacity / 64 ids in a bin, none in the worker's last bins, whose lengths are powers of two.

    Null text counts as empty: its one id is end_id. A null id, and rows that repeat, are packed like any other, each once. An empty table gives no rows. Very long texts are cut into many pieces. Columns besides the two are not read.
    """
    ready(docs.sparkSession)
    ids_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, bins, schema = tokenizer(tokenizer_path), Bins(capacity, TaskContext.get().partitionId() << 32), None
        out: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            lists = pa.ListArray.from_arrays(np.cumsum([0, *(len(x[2]) for x in out)], dtype=np.int32), pa.array(np.concatenate([x[2] for x in out]), pa.int32()))
            long = lambda values: pa.array(values, pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], schema.field(0).type), long([x[1] for x in out]), long([len(x[2]) for x in out]), lists, long([x[3] for x in out]), long([x[4] for x in out]), long([x[5] for x in out])], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for rows in batches:
            schema = rows.schema
            for doc, ids in zip(rows.column(0).to_pylist(), encoded_parts(rows.column(1), encode)):
                for piece in bins.put(doc, np.append(ids, np.int32(end_id))):
                    out.append(piece)
                    held += len(piece[2])
                if len(out) >= BATCH_ROWS or held >= BATCH_IDS:
                    yield batch()
                    out, held = [], 0
        out += bins.rest()
        if out:
            yield batch()

    packed = rows.mapInArrow(lean(run), f"doc_id {ids_type.simpleString()}, start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long")
    return packed if id_col == "doc_id" else packed.withColumnRenamed("doc_id", id_col)


def with_crc32(pieces: DataFrame) -> DataFrame:
    """pieces with ids_crc32, of the ids as little-endian unsigned 32-bit numbers, instead of ids."""
    ready(pieces.sparkSession)
    at = pieces.columns.index("ids")
    fields = [f"{f.name} {f.dataType.simpleString()}" if f.name != "ids" else "ids_crc32 long" for f in pieces.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for rows in batches:
            lists = rows.column(at)
            flat, cut = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            crc = pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in itertools.pairwise(cut.tolist())], pa.int64())
            columns = [crc if i == at else c for i, c in enumerate(rows.columns)]
            yield pa.RecordBatch.from_arrays(columns, [n if n != "ids" else "ids_crc32" for n in rows.schema.names])

    return pieces.mapInArrow(lean(run), ", ".join(fields))
