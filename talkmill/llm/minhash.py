"""Near duplicates by SuperMinHash signatures, banding, verification on full sets and union-find grouping."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from . import common
from .components import components

#: Slots of a signature, and those in a band: a pair at similarity 0.75 shares no band with probability (1 - 0.75**4)**32 = 5e-6.
SLOTS, BAND = 128, 4
#: Members of a band key up to which pairs are compared one by one.
FEW = 8
_GOLDEN = 0x9E3779B97F4A7C15
_MULTIPLIERS = np.random.default_rng(77).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the size-word shingles of a text with A-Z in lower case; a text with fewer words is one shingle."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    upper = (raw >= 65) & (raw <= 90)
    raw = raw + upper.astype(np.uint8) * np.uint8(32)
    starts, ends = common.spans((raw == 32) | ((raw >= 9) & (raw <= 13)))
    n = len(starts)
    if not n:
        return np.empty(0, np.uint64)
    hashed = common.span_hashes(raw, starts, ends)
    width = min(size, n)
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out = common.mix(out * _MULTIPLIERS[0] + hashed[i : n - width + 1 + i] * _MULTIPLIERS[i + 1])
    return np.unique(out)


def superminhash(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """The SuperMinHash signature of a set of 64-bit hashes.

    An element's random stream permutes the slots (Fisher-Yates, one step a layer); in layer j it offers the value j + r to the slot that its permutation has there. Slots keep the least offer. All elements take a layer at once; layers end as soon as each slot holds an offer, for later ones are larger.
    """
    best = np.full(slots, np.iinfo(np.uint64).max, np.uint64)
    n = len(elements)
    if not n:
        return best
    rows, order = np.arange(n), None
    for j in range(slots):
        stream = common.mix(elements + np.uint64((j + 1) * _GOLDEN & (2**64 - 1)))
        pick = j + (((stream >> np.uint64(32)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.intp)
        if order is None:
            first, slot = pick, pick
        else:
            slot = order[rows, pick]
            order[rows, pick] = order[:, j]
        np.minimum.at(best, slot, (np.uint64(j) << np.uint64(32)) | (stream & np.uint64(0xFFFFFFFF)))
        if best.max() >> np.uint64(32) <= j:
            break
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.int16), (n, 1))
            order[rows, first] = 0
    return best


def band_keys(signature: np.ndarray, band: int = BAND) -> np.ndarray:
    """One 64-bit key for each band, which holds the band's number too."""
    parts = signature.reshape(-1, band)
    out = np.arange(len(parts), dtype=np.uint64)
    for i in range(band):
        out = common.mix(out * _MULTIPLIERS[40] + parts[:, i] * _MULTIPLIERS[41 + i])
    return out


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, parts)], dtype=np.int32), pa.array(np.concatenate([np.empty(0, np.uint64), *parts]).view(np.int64)))


def _each(rows: DataFrame, make, schema: str) -> DataFrame:
    """make(list of whole texts) gives Arrow columns to stand after doc_id; texts go in pieces of a few MB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part, size = [], 0
                for text in batch.column(1)[at:]:
                    part.append(text.as_py())
                    size += len(part[-1] or "")
                    if size >= 4 << 20 or len(part) >= 2048:
                        break
                columns = make(part)
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + len(part)], *columns.values()], ["doc_id", *columns])
                at += len(part)

    return rows.mapInArrow(common.lean(run), schema)


def _signed(texts: list) -> dict:
    sizes, bands, keys = [], [], []
    for text in texts:
        found = shingles(text)
        sizes.append(len(found))
        bands.append(band_keys(superminhash(found)) if len(found) else found)
        keys.append((int((found * _MULTIPLIERS[60]).sum(dtype=np.uint64)), int(common.mix(found + _MULTIPLIERS[61]).sum(dtype=np.uint64))))
    keys = np.array(keys, np.uint64).view(np.int64)
    return {"n_shingles": pa.array(sizes, pa.int64()), "set_a": pa.array(keys[:, 0]), "set_b": pa.array(keys[:, 1]), "bands": _lists(bands)}


def _sets(texts: list) -> dict:
    return {"shingles": _lists([shingles(t) for t in texts])}


def similar(n_a: Column, n_b: Column, common_: Column, threshold: int) -> Column:
    """100 * intersection >= threshold * union, in whole numbers."""
    return 100 * common_ >= threshold * (n_a + n_b - common_)


#: Sizes of sets that differ by less than this factor fall in one class.
WIDTH = 1.05


def formed(rows: DataFrame, on: list[str], threshold: int, written: Callable[[DataFrame, str], DataFrame] = common.written) -> DataFrame:
    """Pairs of rows equal in on, in different components, that can make a link; each pair once, the second row's columns with an underscore behind.

    rows have doc_id, component_id, n_shingles and bound: how many shingles a row can share, at most, with another one here. That gives the largest size of a set that it can be linked with. Pairs are brought together only so far as they have a chance:
    - One of the two must be open to sets of its own size or larger; if neither is, each would have to be smaller than the other.
    - Rows go by classes of size to the classes that they can be linked with, and meet only where each goes to the other's class.
    - Of the rows with a common key, those of the component that has most there aren't paired with each other.
    So neither a family that is one component nor one whose members share too little gives pairs, whatever its size. Rows are written as they are dealt, and read for both sides of a pair.
    """
    t, step = threshold / 100, math.log(WIDTH)
    place = lambda x: F.floor(F.log(x) / step + 1e-9).cast("int")
    n, most = F.col("n_shingles"), F.floor(F.col("bound") * (100 + threshold) / threshold + 1e-9) - F.col("n_shingles")
    able = rows.withColumn("most", most).where((F.col("most") >= 1) & (F.col("most") >= t * n))
    sizes = rows.groupBy(*on, "component_id").agg(F.count("*").alias("k"))
    main = sizes.groupBy(*on).agg(F.max(F.struct("k", "component_id"))["component_id"].alias("main"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    able = able.join(main, on).withColumn("is_main", F.col("component_id") == F.col("main")).withColumn("wide", F.col("most") >= n).drop("main")
    dealt = able.withColumn("mine", place(n)).withColumn("theirs", F.explode(F.sequence(place(F.greatest(t * n, F.lit(1.0))), F.least(place(n / t), place(F.col("most"))))))
    dealt = written(dealt, "dealt")
    right = dealt.select(*on, F.col("mine").alias("theirs"), F.col("theirs").alias("mine"), "is_main", "wide", *(F.col(c).alias(f"{c}_") for c in rows.columns if c not in on))
    apart, flags = F.col("component_id") != F.col("component_id_"), ["mine", "theirs", "is_main", "wide", "most"]
    others = dealt.where("not is_main")
    first = others.where("wide").drop("is_main", "wide").join(right, [*on, "mine", "theirs"]).where(apart & (F.col("is_main") | ~F.col("wide") | (F.col("doc_id") < F.col("doc_id_"))))
    second = others.where("not wide").drop("is_main", "wide").join(right.where("is_main and wide"), [*on, "mine", "theirs"]).where(apart)
    return first.drop(*flags).unionByName(second.drop(*flags))


def near_duplicates(docs: DataFrame, *, threshold: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups documents whose sets of five-word shingles have a Jaccard similarity of threshold/100 or more, or that are joined by a chain of such.

    Returns one row per distinct id: doc_id (as long; ids that are no whole numbers keep their type), n_shingles, component_id (the least id of its group, itself included), kept (doc_id = component_id). It is written; the tables on the way to it are deleted.

    1. One pass over the texts gives each set's size, two 64-bit sums that name the set, and the band keys of its SuperMinHash signature.
    2. Equal sets form a class, which its least id stands for from here on. Copies are never paired.
    3. Where classes share a band key, all are compared with one of them, the centre: that which shares most keys with others, as the text does that edited copies go back to. Links inside a group would change nothing, so only pairs that these links leave in different groups are looked at again:
       - under keys of up to FEW members, each such pair;
       - under other keys, a pair of which both share so many shingles with the centre that these alone could make a link;
       - and a pair that shares a shingle that the centre lacks. Any other pair shares at most what both have of the centre, which is too little. Of these shingles, those are left out that no other document has; with the others sorted, a pair counts only if what both have of the centre and, from the shared one on, beside it can make a link (prefix and positional filter: the first shingle that a linked pair shares passes).
       No pair with a link under a common key is lost. formed() sees to it that only pairs that can make a link are brought together at all: neither those of one group nor those that share no more than a template, however many use it.
    4. Links are confirmed on full sets. Union-find groups what is linked (components.py).

    Null ids belong to no row of the result. Null, empty and blank texts have no shingles and no links. Rows with equal ids and different texts count as one document with the larger set. An empty table gives no rows. Columns besides the two are not read, so that their names don't matter.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        return _by_number(docs, threshold, id_col, text_col)
    spark, tables = common.ready(docs.sparkSession), []

    def written(df: DataFrame, name: str) -> DataFrame:
        tables.append(common.written(df, name))
        return tables[-1]

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("doc_id is not null")
    signed = written(_each(rows, _signed, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"), "signed")

    sized = signed.groupBy("doc_id").agg(F.max(F.struct("n_shingles", "set_a", "set_b")).alias("s")).select("doc_id", "s.*")
    classes = sized.where("n_shingles > 0").groupBy("n_shingles", "set_a", "set_b").agg(F.min("doc_id").alias("class_id"))
    classes = written(classes, "classes")
    stands = classes.select(F.col("class_id").alias("doc_id"), "n_shingles", "set_a", "set_b")
    banded = signed.join(stands, ["doc_id", "n_shingles", "set_a", "set_b"]).dropDuplicates(["doc_id"]).select("doc_id", "n_shingles", F.explode("bands").alias("key"))

    shared = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    live = written(banded.join(shared, "key"), "live")
    scores = live.groupBy("doc_id").agg(F.sum("n").alias("score"))
    live_scored = live.drop("n").join(scores, "doc_id")
    centres = live_scored.groupBy("key").agg(F.max(F.struct("score", -F.col("doc_id"))).alias("c"), F.count("*").alias("members")).select("key", (-F.col("c.col2")).alias("centre"), "members")
    starred = written(live.drop("n").join(centres, "key"), "starred")

    wanted = written(live.select("doc_id").distinct(), "wanted")  # its size is known, so that texts aren't shuffled to meet it while it is small
    sets = _each(rows.join(wanted, "doc_id", "left_semi"), _sets, "doc_id long, shingles array<long>").select("doc_id", F.size("shingles").cast("long").alias("n"), "shingles")
    sets = written(sets.join(stands.select("doc_id", F.col("n_shingles").alias("n")), ["doc_id", "n"]).dropDuplicates(["doc_id"]), "sets")

    def with_sets(pairs: DataFrame, a: str, b: str) -> DataFrame:
        left, right = (sets.select(F.col("doc_id").alias(k), F.col("n").alias(f"n_{k}"), F.col("shingles").alias(f"set_{k}")) for k in (a, b))
        return pairs.join(left, a).join(right, b)

    inter = lambda a, b: F.size(F.array_intersect(f"set_{a}", f"set_{b}")).cast("long")
    stars = written(starred.where("doc_id != centre").select("doc_id", "centre").distinct(), "pairs")  # as the other lists of pairs: small ones then meet the sets without a shuffle of these
    stars = written(with_sets(stars, "doc_id", "centre").select("doc_id", "centre", F.col("n_doc_id").alias("n"), F.col("n_centre").alias("n_c"), inter("doc_id", "centre").alias("held")), "stars")
    links = stars.where(similar(F.col("n"), F.col("n_c"), F.col("held"), threshold)).select(F.col("doc_id").alias("a"), F.col("centre").alias("b"))
    grouped = components(links)
    tables.append(grouped)

    of = lambda df: df.join(grouped.select(F.col("id").alias("doc_id"), "component_id"), "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    placed = written(of(starred), "placed")
    mixed = placed.groupBy("key").agg(F.min("component_id").alias("lo"), F.max("component_id").alias("hi")).where("lo < hi").select("key")
    rest = placed.join(mixed, "key").join(stars.select("doc_id", "centre", "held"), ["doc_id", "centre"], "left")
    rest = written(rest.withColumn("held", F.coalesce("held", "n_shingles")), "rest")  # the centre holds itself

    def crossing(rows: DataFrame, on: list[str], common_: Column) -> DataFrame:
        """Pairs as formed() gives them that could make a link with common_ shingles in common."""
        pairs = formed(rows, on, threshold, written).where((100 + threshold) * common_ >= threshold * (F.col("n_shingles") + F.col("n_shingles_")))
        return pairs.select(F.least("doc_id", "doc_id_").alias("a"), F.greatest("doc_id", "doc_id_").alias("b"))

    few, many = rest.where(F.col("members") <= FEW), rest.where(F.col("members") > FEW)
    pair = few.select("key", "doc_id", "n_shingles", "component_id")
    pair = pair.join(pair.select("key", *(F.col(c).alias(f"{c}_") for c in ("doc_id", "n_shingles", "component_id"))), "key")
    near = (100 * F.col("n_shingles") >= threshold * F.col("n_shingles_")) & (100 * F.col("n_shingles_") >= threshold * F.col("n_shingles"))
    in_few = pair.where((F.col("doc_id") < F.col("doc_id_")) & (F.col("component_id") != F.col("component_id_")) & near).select(F.col("doc_id").alias("a"), F.col("doc_id_").alias("b"))
    by_held = crossing(many.select("key", "doc_id", "n_shingles", "component_id", F.col("held").alias("bound")), ["key"], F.least("bound", "bound_"))
    apart = written(many.where("doc_id != centre").select("doc_id", "centre", "n_shingles", "component_id", "held").distinct(), "apart")
    outside = F.explode(F.array_except("set_doc_id", "set_centre")).alias("shingle")
    spelled = written(with_sets(apart, "doc_id", "centre").select("doc_id", "centre", "n_shingles", "component_id", "held", outside), "spelled")
    twice = spelled.groupBy("centre", "shingle").agg(F.count("*").alias("k")).where("k > 1").drop("k")
    of_doc = Window.partitionBy("doc_id", "centre")
    beside = spelled.join(twice, ["centre", "shingle"]).withColumn("left", F.count("*").over(of_doc) - F.row_number().over(of_doc.orderBy("shingle")))
    beside = written(beside.withColumn("bound", F.col("held") + F.col("left") + 1), "beside")
    by_shingle = crossing(beside, ["centre", "shingle"], F.least("held", "held_") + F.least("left", "left_") + 1)
    candidates = written(in_few.union(by_held).union(by_shingle).distinct(), "candidates")
    more = with_sets(candidates, "a", "b").where(similar(F.col("n_a"), F.col("n_b"), inter("a", "b"), threshold)).select("a", "b")
    more = written(more, "links")
    if not more.isEmpty():
        before = grouped.select(F.col("component_id").alias("a"), F.col("id").alias("b")).where("a < b")
        grouped = components(before.unionByName(more))
        tables.append(grouped)

    by_class = of(classes.select(F.col("class_id").alias("doc_id"), "n_shingles", "set_a", "set_b")).select("n_shingles", "set_a", "set_b", "component_id")
    out = sized.join(by_class, ["n_shingles", "set_a", "set_b"], "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    out = common.written(out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")), "near")
    for table in tables:
        common.drop_written(table)
    return out


def _by_number(docs: DataFrame, threshold: int, id_col: str, text_col: str) -> DataFrame:
    """near_duplicates for ids of any type that can be sorted: they are numbered in their order, so that the least number is the least id's."""
    (no,) = common.unused(docs, "id_no")
    ids = docs.select(common.col(id_col).alias("id")).where("id is not null").distinct().orderBy("id")
    ids = common.written(ids.withColumn("no", F.monotonically_increasing_id()), "numbers")
    numbered = docs.select(common.col(id_col).alias("id"), common.col(text_col).alias("text")).join(ids.withColumnRenamed("no", no), "id")
    found = near_duplicates(numbered, threshold=threshold, id_col=no, text_col="text")
    named = lambda c, to: ids.select(F.col("no").alias(c), F.col("id").alias(to))
    out = found.join(named("doc_id", "own_id"), "doc_id").join(named("component_id", "group_id"), "component_id")
    return out.select(F.col("own_id").alias("doc_id"), "n_shingles", F.col("group_id").alias("component_id"), "kept")


def keep_one(docs: DataFrame, *, threshold: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near duplicates: of each group the row of the least id stays, with all its columns. Rows with a null id stay.

    Where ids repeat, each text is judged by itself: an id keeps all its texts that are no near duplicates of another that stays; of rows with equal id and equal set (blank texts have the empty one), one stays.
    """
    named, text = common.col(id_col), common.col(text_col).cast("string")
    with_id = docs.where(named.isNotNull())
    repeated = with_id.groupBy(named.alias("id")).agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        (mark,) = common.unused(docs, "kept_id")
        kept = near_duplicates(docs, threshold=threshold, id_col=id_col, text_col=text_col).where("kept").select(F.col("doc_id").alias(mark))
        stay = with_id.join(kept, named == F.col(mark), "left_semi")
    else:  # each row has a number of its own, written so that it stays
        (row,) = common.unused(docs, "kept_row")
        numbered = common.written(with_id.withColumn(row, F.monotonically_increasing_id()), "numbered")
        of_row = numbered.select(F.col(row).alias("doc_id"), named.alias("id"), F.xxhash64(text).alias("hash"))
        judged = near_duplicates(numbered, threshold=threshold, id_col=row, text_col=text_col).join(of_row, "doc_id")
        blank = F.col("n_shingles") == 0
        first = judged.groupBy(blank.alias("blank"), F.when(blank, F.col("id")).otherwise(F.col("component_id")).alias("group")).agg(F.min(F.struct("id", "hash", "doc_id")).alias("s"))
        stay = numbered.join(first.select(F.col("s.doc_id").alias(row)), row, "left_semi").select(*map(common.col, docs.columns))
    return stay.unionByName(docs.where(named.isNull()))
