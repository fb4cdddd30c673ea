"""Chunks: an ordered fold over an episode's segments, and sliding windows over a book's words."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.text import date_number, words
from ..session import prepared

MAX_WORDS, OVERLAP = 400, 50


_CUT = "array<struct<speaker:string,start_time:double,first:int,n_words:int>>"


def _fold(max_words: int, overlap: int):
    """The merge step, on numbers of words alone: an open chunk is always the last words so far, so that its first word's place tells all. State: speaker, start and first word of the open chunk, the words so far, and the cuts done.

    A change of speaker closes the open chunk under its speaker and keeps its last words, which then belong to the new one. A full chunk closes with its first max_words words and keeps the last `overlap` of all, so that words between are left out. Since the chunk is short afterwards, each segment closes at most one of either kind.
    """

    def step(a, s):
        cut = lambda speaker, start, first, n: F.array(F.struct(speaker.alias("speaker"), start.alias("start_time"), first.alias("first"), n.cast("int").alias("n_words")))
        none = F.array().cast(_CUT)
        held = a["upto"] - a["first"]
        turn = ~a["speaker"].eqNullSafe(s["speaker"]) & (held > 0)
        first = F.when(turn, F.greatest(a["first"], a["upto"] - overlap)).otherwise(a["first"])
        start = F.when(turn | (held == 0), s["start"]).otherwise(a["start"])
        upto = (a["upto"] + s["n"]).cast("int")
        full = upto - first >= max_words
        done = F.concat(a["done"], F.when(turn, cut(a["speaker"], a["start"], a["first"], held)).otherwise(none), F.when(full, cut(s["speaker"], start, first, F.lit(max_words))).otherwise(none))
        return F.struct(s["speaker"].alias("speaker"), F.when(full, s["start"]).otherwise(start).alias("start"), F.when(full, upto - overlap).otherwise(first).cast("int").alias("first"), upto.alias("upto"), done.alias("done"))

    return step


def _cuts(whole: DataFrame, keys: tuple[str, ...], max_words: int, overlap: int, *more: str) -> DataFrame:
    """keys, more and c, the cuts of an episode; whole has s: its segments (seq, speaker, start, n) in order."""
    zero = F.struct(F.lit(None).cast("string").alias("speaker"), F.lit(0.0).alias("start"), F.lit(0).alias("first"), F.lit(0).alias("upto"), F.array().cast(_CUT).alias("done"))
    state = whole.select(*keys, *more, F.aggregate("s", zero, _fold(max_words, overlap)).alias("a"))
    left = (F.col("a.upto") - F.col("a.first")).cast("int")
    rest = F.when(left > 0, F.array(F.struct(F.col("a.speaker").alias("speaker"), F.col("a.start").alias("start_time"), F.col("a.first").alias("first"), left.alias("n_words")))).otherwise(F.array().cast(_CUT))
    return state.select(*keys, *more, F.concat("a.done", rest).alias("c"))


def _segments(segments: DataFrame, keys: tuple[str, ...], *more: Column) -> DataFrame:
    return segments.select(*keys, "seq", F.coalesce("speaker", F.lit("UNKNOWN")).alias("speaker"), F.coalesce(F.col("start").cast("double"), F.lit(0.0)).alias("start"), words(F.col("text")).alias("w")).withColumn("n", F.size("w"))


class _Open:
    """The merge step, one segment after the other: what is open is a speaker, a start and the last words so far. A step gives the chunks (speaker, start, words) that it closes, two at most."""

    def __init__(self, max_words: int, overlap: int) -> None:
        self.most, self.overlap = max_words, overlap
        self.words: list = []
        self.speaker, self.start = None, 0.0

    def _close(self, speaker: str, start: float, n: int) -> tuple[str, float, list]:
        done = speaker, start, self.words[:n]
        self.words = self.words[max(0, len(self.words) - self.overlap) :]
        return done

    def step(self, speaker: str, start: float, words: list) -> Iterator[tuple[str, float, list]]:
        if not self.words:
            self.start = start
        elif speaker != self.speaker:
            yield self._close(self.speaker, self.start, len(self.words))
            self.start = start
        self.speaker = speaker
        self.words.extend(words)
        if len(self.words) >= self.most:
            yield self._close(speaker, self.start, self.most)
            self.start = start

    def end(self) -> Iterator[tuple[str, float, list]]:
        if self.words:
            yield self.speaker, self.start, self.words


def _closed(batches: Iterator[pa.RecordBatch], keys: int, max_words: int, overlap: int) -> Iterator[list[tuple]]:
    """The chunks (keys, index, speaker, start, words, whether it is the key's last) that each batch of sorted segments closes: keys, seq, speaker, start, and the text or its number of words. Held are an open chunk, the last closed one and a batch, whatever a key has."""
    key, open_, waiting, found = None, None, None, []

    def take(chunks: Iterator[tuple[str, float, list]]) -> None:
        nonlocal waiting
        for chunk in chunks:
            if waiting:
                found.append((*waiting, False))
            waiting = (*key, waiting[keys] + 1 if waiting else 0, *chunk)

    def end() -> None:
        nonlocal waiting
        if open_:
            take(open_.end())
        if waiting:
            found.append((*waiting, True))
        waiting = None

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            own, (_, speaker, start, text) = row[:keys], row[keys:]
            if own != key or open_ is None:
                end()
                key, open_ = own, _Open(max_words, overlap)
            take(open_.step(speaker, start, [None] * text if isinstance(text, int) else (text or "").split()))
        yield found
        found.clear()
    end()
    yield found


def _sorted(segments: DataFrame, keys: tuple[str, ...], what: Column) -> DataFrame:
    prepared(segments.sparkSession)
    rows = segments.select(*keys, "seq", F.coalesce("speaker", F.lit("UNKNOWN")).alias("speaker"), F.coalesce(F.col("start").cast("double"), F.lit(0.0)).alias("start"), what.alias("what"))
    return rows.repartition(*keys).sortWithinPartitions(*keys, "seq", "speaker", "start", "what")


def fold_chunks(segments: DataFrame, keys: tuple[str, ...] = ("episode",), *, max_words: int = MAX_WORDS, overlap: int = OVERLAP) -> DataFrame:
    """The chunks of build_chunks, for episodes of any length: segments stream through the merge step in order, sorted by Spark, which spills. A task holds an open chunk and a batch. n_chunks is counted over the chunks afterwards."""
    kinds = ", ".join(f"`{k}` {segments.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _closed(batches, len(keys), max_words, overlap):
            rows = [(*r[:-2], f"[{r[-4]}] {' '.join(r[-2])}", len(r[-2])) for r in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    names = [*keys, "chunk_index", "speaker", "start_time", "text", "n_words"]
    rows = _sorted(segments, keys, F.col("text"))
    types = [*(to_arrow_type(segments.schema[k].dataType) for k in keys), pa.int32(), pa.string(), pa.float64(), pa.string(), pa.int32()]
    chunks = rows.mapInArrow(run, f"{kinds}, chunk_index int, speaker string, start_time double, text string, n_words int")
    counted = chunks.withColumn("n_chunks", F.count("*").over(Window.partitionBy(*keys)).cast("int"))
    return counted.select(*keys, "chunk_index", "n_chunks", "speaker", "start_time", "text", "n_words")


def fold_counts(segments: DataFrame, keys: tuple[str, ...] = ("episode",), *, max_words: int = MAX_WORDS, overlap: int = OVERLAP) -> DataFrame:
    """expected_chunks for episodes of any length: numbers of words stream through the merge step. No text is moved."""
    kinds = ", ".join(f"`{k}` {segments.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _closed(batches, len(keys), max_words, overlap):
            rows = [(*r[: len(keys)], r[len(keys)] + 1) for r in found if r[-1]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], [*keys, "n_chunks"])

    types = [*(to_arrow_type(segments.schema[k].dataType) for k in keys), pa.int64()]
    return _sorted(segments, keys, F.size(words(F.col("text")))).mapInArrow(run, f"{kinds}, n_chunks long")


def build_chunks(segments: DataFrame, keys: tuple[str, ...] = ("episode",), *, max_words: int = MAX_WORDS, overlap: int = OVERLAP) -> DataFrame:
    """One row per chunk: keys, chunk_index, n_chunks, speaker, start_time, text ("[speaker] words"), n_words. Segments need seq, speaker, start and text. An episode's segments meet in one row, in order; chunks are cut from its words once all cuts are known. One without words has no chunks. For episodes too long for a row there is build_chunks_streamed."""
    rows = _segments(segments, keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("seq", "speaker", "start", "n", "w"))).alias("s"))
    rows = _cuts(rows.select(*keys, "s", F.flatten(F.transform("s", lambda x: x["w"])).alias("w")), keys, max_words, overlap, "w")
    each = rows.select(*keys, "w", F.size("c").alias("n_chunks"), F.posexplode("c").alias("chunk_index", "k"))
    body = F.array_join(F.slice("w", F.col("k.first") + 1, F.col("k.n_words")), " ")
    return each.select(*keys, "chunk_index", "n_chunks", "k.speaker", "k.start_time", F.concat(F.lit("["), F.col("k.speaker"), F.lit("] "), body).alias("text"), "k.n_words")


def expected_chunks(segments: DataFrame, keys: tuple[str, ...] = ("episode",), *, max_words: int = MAX_WORDS, overlap: int = OVERLAP) -> DataFrame:
    """How many chunks each episode should have, from its segments' numbers of words: no text is moved. Episodes without any have no row."""
    rows = _segments(segments, keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("seq", "speaker", "start", "n"))).alias("s"))
    return _cuts(rows, keys, max_words, overlap).select(*keys, F.size("c").cast("long").alias("n_chunks")).where("n_chunks > 0")


def _between(body: Column, a: Column, b: Column) -> Column:
    """The words from place a (from 0) up to b of a text whose words have one space between them."""
    upto = F.call_function("substring_index", body, F.lit(" "), b.cast("int"))
    return F.call_function("substring_index", upto, F.lit(" "), -(b - a).cast("int"))


def build_chunks_streamed(segments: DataFrame, keys: tuple[str, ...] = ("episode",), *, max_words: int = MAX_WORDS, overlap: int = OVERLAP) -> DataFrame:
    """The same chunks for episodes too long for one row. Cuts and places of segments are found from numbers of words, and meet in a join by stretches of max_words words, which tells which words of a segment go to which cuts. Only then do texts move, as strings: to the cuts' places, and what is cut from them to its chunk, which is put together by itself. So a row holds an episode's numbers, a segment or a chunk."""
    rows = _segments(segments, keys).withColumn("h", F.xxhash64("w"))
    own = F.struct(*keys, "seq", "h").alias("own")  # equal where keys are null too; segments alike in it have one text
    before = Window.partitionBy(*keys).orderBy("seq", "speaker", "start", "n", "h").rowsBetween(Window.unboundedPreceding, -1)
    numbers = rows.select(*keys, "seq", "speaker", "start", "n", "h").withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0)))
    whole = numbers.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("seq", "speaker", "start", "n", "h", "at"))).alias("s"))  # with all columns, so that both uses read one shuffle
    cuts = _cuts(whole, keys, max_words, overlap).select(*keys, F.size("c").alias("n_chunks"), F.posexplode("c").alias("chunk_index", "k"))
    stretch = lambda first, n: F.sequence(F.floor(first / max_words), F.floor((first + n - 1) / max_words))
    cuts = cuts.select(*(F.col(k).alias(f"{k}_c") for k in keys), "chunk_index", "n_chunks", "k.*").withColumn("stretch_c", F.explode(stretch(F.col("first"), F.col("n_words"))))
    held = numbers.where("n > 0").select(*keys, own, "n", "at")
    held = held.withColumn("stretch", F.explode(stretch(F.col("at"), F.col("n"))))
    on = [F.col(k).eqNullSafe(F.col(f"{k}_c")) for k in keys] + [F.col("stretch") == F.col("stretch_c")]
    lo, hi = F.greatest("at", "first"), F.least(F.col("at") + F.col("n"), F.col("first") + F.col("n_words"))
    once = F.col("stretch") == F.floor(lo / max_words)  # two that meet in several stretches count where their common words begin
    parts = held.join(cuts, on).where(once & (lo < hi)).select("own", "chunk_index", "n_chunks", "speaker", "start_time", "n_words", lo.alias("lo"), (lo - F.col("at")).alias("a"), (hi - F.col("at")).alias("b"))
    texts = rows.where("n > 0").select(own, F.array_join("w", " ").alias("body")).groupBy("own").agg(F.first("body").alias("body"))
    pieces = parts.join(texts, "own").select(*(F.col(f"own.{k}").alias(k) for k in keys), "chunk_index", "n_chunks", "speaker", "start_time", "n_words", F.struct("lo", _between(F.col("body"), F.col("a"), F.col("b")).alias("t")).alias("p"))
    put = pieces.groupBy(*keys, "chunk_index", "n_chunks", "speaker", "start_time", "n_words").agg(F.array_sort(F.collect_list("p")).alias("p"))
    body = F.array_join(F.transform("p", lambda x: x["t"]), " ")
    return put.select(*keys, "chunk_index", "n_chunks", "speaker", "start_time", F.concat(F.lit("["), F.col("speaker"), F.lit("] "), body).alias("text"), "n_words")


def chunk_metadata(chunks: DataFrame, rules_version: str = "1") -> DataFrame:
    """chunks, with show, episode_number and date, and the columns that a stored record carries."""
    from ..functions.text import chunk_id, id_prefix

    prefix = id_prefix(F.col("show"), F.col("episode_number"), F.col("date"))
    return chunks.withColumns({"id": chunk_id(prefix, F.col("chunk_index")), "date_ts": date_number(F.col("date")), "rules_version": F.lit(rules_version)})


def book_chunks(pages: DataFrame, book: str = "book", page: str = "page", text: str = "text", *, size: int = MAX_WORDS, overlap: int = OVERLAP) -> DataFrame:
    """Windows of `size` words every size - overlap words over a book's pages laid end to end: book, chunk_index, page (of its first word), n_words, text.

    Words are numbered by running sums over the pages' numbers of words; the pages' texts, as strings, then meet these sums by page. Each page's words go to the windows that hold them, and windows are put together. So a task gets a book's numbers, a page or a window. Of pages with one number, the order is that of a hash of their texts; those alike in that too stand one after the other.
    """
    step = size - overlap
    w = words(F.col(text))
    df = pages.select(F.col(book).alias("book"), F.col(page).alias("page"), w.alias("w")).withColumn("n", F.size("w")).where("n > 0").withColumn("h", F.xxhash64("w"))
    own = F.struct("book", "page", "h").alias("own")  # equal where book or page are null too
    by = Window.partitionBy("book").orderBy("page", "h").rowsBetween(Window.unboundedPreceding, -1)
    places = df.groupBy("book", "page", "h").agg(F.first("n").alias("n"), F.count("*").alias("copies"))
    places = places.select(own, "n", "copies", F.coalesce(F.sum(F.col("n") * F.col("copies")).over(by), F.lit(0)).alias("before"))
    texts = df.select(own, F.array_join("w", " ").alias("body")).groupBy("own").agg(F.first("body").alias("body"))
    df = texts.join(places, "own").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).withColumn("upto", F.col("before") + F.col("k") * F.col("n"))
    first = F.col("upto") - F.col("n")
    lo = F.greatest(F.floor((first - size) / step) + 1, F.lit(0)).cast("long")
    hi = F.floor((F.col("upto") - 1) / step).cast("long")
    part = df.withColumn("first", first).withColumn("i", F.explode(F.sequence(lo, hi)))
    a = F.greatest(F.col("i") * step - F.col("first"), F.lit(0)).cast("int")
    b = F.least(F.col("i") * step + size - F.col("first"), F.col("n")).cast("int")
    part = part.select(F.col("own.book").alias("book"), F.col("own.page").alias("page"), "i", (b - a).alias("n"), F.struct("first", _between(F.col("body"), a, b).alias("t")).alias("p"))
    got = part.groupBy("book", "i").agg(F.array_sort(F.collect_list("p")).alias("p"), F.min("page").alias("page"), F.sum("n").cast("int").alias("n_words"))
    return got.select("book", F.col("i").alias("chunk_index"), "page", "n_words", F.array_join(F.transform("p", lambda x: x["t"]), " ").alias("text"))
