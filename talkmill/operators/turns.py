"""Turns, speech shares and what is picked from turns."""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_cluster, words
from ..session import prepared

GAP_CAP_S, MIN_TURN_S, LEAD_IN_S, CLIP_S = 30.0, 1.5, 2.0, 10.0


def _by_seq(*keys: str) -> Window:
    return Window.partitionBy(*keys).orderBy("seq")


def segment_gaps(segments: DataFrame, cap: float, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """segments with raw_gap (to the next start, null on the last) and duration_s (clamped to 0..cap, 0 on the last)."""
    gap = F.lead("start").over(_by_seq(*keys)) - F.col("start")
    return segments.withColumn("raw_gap", gap).withColumn("duration_s", F.coalesce(F.least(F.greatest(F.col("raw_gap"), F.lit(0.0)), F.lit(cap)), F.lit(0.0)))


def merge_turns(segments: DataFrame, cap: float = GAP_CAP_S, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """Runs of segments of one speaker: turn_idx, speaker, start, duration_s, n_words, n_segments. One shuffle by episode serves gaps, runs and sums."""
    w = _by_seq(*keys)
    speaker = F.coalesce("speaker", F.lit("UNKNOWN"))
    df = segment_gaps(segments.withColumn("speaker", speaker), cap, keys)
    changed = F.when(F.lag("speaker").over(w).eqNullSafe(F.col("speaker")), 0).otherwise(1)
    df = df.withColumn("run", F.sum(changed).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    sums = [F.sum("duration_s").alias("duration_s"), F.sum(F.size(words(F.col("text")))).alias("n_words"), F.count("*").alias("n_segments")]
    return df.groupBy(*keys, "run").agg(F.min_by("speaker", "seq").alias("speaker"), F.min_by("start", "seq").alias("start"), *sums).withColumn("turn_idx", F.col("run") - 1).drop("run")


def non_monotonic(segments: DataFrame, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """How many segments of each episode have a successor that starts before them."""
    back = F.lead("start").over(_by_seq(*keys)) < F.col("start")
    return segments.select(*keys, back.alias("back")).groupBy(*keys).agg(F.count_if("back").alias("non_monotonic"))


def by_speaker(turns: DataFrame, min_turn_s: float = MIN_TURN_S, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """Seconds, words and turns of each speaker, without turns under min_turn_s; first_turn breaks ties."""
    kept = turns.where(F.col("duration_s") >= min_turn_s)
    return kept.groupBy(*keys, "speaker").agg(F.sum("duration_s").alias("seconds"), F.sum("n_words").alias("words"), F.count("*").alias("turns"), F.min("turn_idx").alias("first_turn"))


def speech_shares(turns: DataFrame, min_turn_s: float = MIN_TURN_S, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """Totals and the shares of the one and two largest speakers of each episode; zeros where no turn is long enough. Short turns leave numerator and denominator."""
    each = by_speaker(turns, min_turn_s, keys)
    top = lambda c: F.sort_array(F.collect_list(c), asc=False)
    sums = each.groupBy(*keys).agg(F.sum("seconds").alias("total_s"), F.sum("words").alias("total_words"), F.count("*").alias("n_speakers"), F.sum("turns").alias("n_turns"), top("seconds").alias("s_"), top("words").alias("w_"), F.max_by("speaker", F.struct("seconds", -F.col("first_turn"))).alias("dominant"))
    out = turns.select(*keys).distinct().join(sums, list(keys), "left")
    zero = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind)
    share = lambda x, t: F.coalesce(F.try_divide(x, F.col(t)), F.lit(0.0))
    first = lambda a, i: F.coalesce(F.get(a, F.lit(i)), F.lit(0))
    return out.select(*keys, zero(F.col("total_s"), "double").alias("total_s"), zero(F.col("total_words"), "long").alias("total_words"), zero(F.col("n_speakers"), "long").alias("n_speakers"), zero(F.col("n_turns"), "long").alias("n_turns"), share(first("s_", 0), "total_s").alias("top1_s_share"), share(first("s_", 0) + first("s_", 1), "total_s").alias("top2_s_share"), share(first("w_", 0), "total_words").alias("top1_words_share"), "dominant")


def longest_turns(turns: DataFrame, k: int = 3, min_turn_s: float = LEAD_IN_S + CLIP_S, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """The k longest turns of each speaker that are long enough, ties by start, as draw 0, 1 ..."""
    w = Window.partitionBy(*keys, "speaker").orderBy(F.desc("duration_s"), "start", "turn_idx")
    return turns.where(F.col("duration_s") >= min_turn_s).withColumn("draw", F.row_number().over(w) - 1).where(F.col("draw") < k)


def clip_window(start: Column, duration: Column, length: Column, lead_in: float = LEAD_IN_S) -> Column:
    """(start, length) of the audio to cut from a turn, which it never overruns."""
    late = duration > lead_in
    return F.struct(F.when(late, start + lead_in).otherwise(start).alias("start"), F.when(late, F.least(length, duration - lead_in)).otherwise(F.least(length, duration)).alias("length"))


def crop_plan(turns: DataFrame, k: int = 3, lengths: tuple[float, ...] = (10.0, 30.0), min_turn_s: float = LEAD_IN_S + CLIP_S, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """Each crop that is owed: the longest turns of each identified cluster at each length."""
    chosen = longest_turns(turns.where(is_cluster(F.col("speaker"))), k, min_turn_s, keys)
    each = chosen.withColumn("length_s", F.explode(F.array(*map(F.lit, lengths)))).withColumn("w_", clip_window(F.col("start"), F.col("duration_s"), F.col("length_s")))
    return each.select(*keys, F.col("speaker").alias("cluster"), "draw", "length_s", F.col("start").alias("turn_start"), F.col("duration_s").alias("turn_duration_s"), F.col("w_.start").alias("crop_start_s"), F.col("w_.length").alias("crop_length_s"))


def permuted(seed: Column, n: Column) -> Column:
    """The numbers 0 to n - 1 in the order that the seed, a string, gives: that of the standard library's generator (Mersenne Twister), so that draws made elsewhere by the same seed are the same."""

    def orders(seeds: pd.Series, sizes: pd.Series) -> pd.Series:
        out = []
        for seed, n in zip(seeds, sizes):
            order = list(range(int(n)))
            random.Random(seed).shuffle(order)
            out.append(order)
        return pd.Series(out, dtype=object)

    return F.pandas_udf("array<int>")(orders)(seed, n)


def drawn_turns(turns: DataFrame, wanted: DataFrame, min_turn_s: float = LEAD_IN_S + CLIP_S, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """wanted (keys, speaker, seed, draw ...) with the turn at place draw of the order that the seed alone fixes, among the speaker's turns of min_turn_s or more; draws don't repeat before all turns had theirs. A speaker without such turns has no row. Orders are of numbers: the turns themselves stay in Spark."""
    prepared(turns.sparkSession)
    w = Window.partitionBy(*keys, "speaker")
    able = turns.where(F.col("duration_s") >= min_turn_s).withColumn("place_", F.row_number().over(w.orderBy("turn_idx")) - 1).withColumn("n_", F.count("*").over(w))
    sizes = able.where("place_ = 0").select(*keys, "speaker", "n_")
    places = wanted.join(sizes, [*keys, "speaker"])
    places = places.withColumn("place_", F.get(permuted(F.col("seed"), F.col("n_")), (F.col("draw") % F.col("n_")).cast("int"))).drop("n_")
    found = able.select(*keys, "speaker", "place_", *(c for c in turns.columns if c not in wanted.columns))
    return places.join(found, [*keys, "speaker", "place_"]).drop("place_")


def drawn_turn(turns: DataFrame, seed: str | Column, draw: int = 0, min_turn_s: float = LEAD_IN_S + CLIP_S, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """One eligible turn of each speaker (drawn_turns). seed: one for all, or an expression of keys and speaker."""
    seeds = seed if isinstance(seed, Column) else F.lit(seed)
    wanted = turns.select(*keys, "speaker").distinct().withColumns({"seed": seeds, "draw": F.lit(draw)})
    return drawn_turns(turns, wanted, min_turn_s, keys).drop("seed")


#: Seconds of a stretch of an episode, at least: long episodes are laid in stretches, so that no task gets one whole.
STRETCH_S = 3600.0
#: Times beyond this don't count as times.
LAST_S = 1e12


def _visible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sweep over turns (i_, b_, e_, s_ behind any keys), sorted by keys and start: what is seen of each, where of overlapping turns the first one hides the others. Held are the turns that are open at a moment."""
    key, now, opened, open_, out = None, 0.0, 0, [], []

    def until(time: float) -> None:
        nonlocal now
        while open_ and now < time:
            _, _, end, speaker = open_[0]
            if end <= now:
                heapq.heappop(open_)
                continue
            out.append((*key, now, min(end, time), speaker))
            now = min(end, time)
        now = time

    def taken(fields: list[pa.Field]) -> pa.RecordBatch:
        found = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(fields)], [f.name for f in fields])
        out.clear()
        return found

    fields: list[pa.Field] = []
    for batch in batches:
        fields = [f for f in batch.schema if f.name != "i_"]
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            *own, place, start, end, speaker = row
            if own != key:
                until(math.inf)
                key, open_[:] = own, []
            until(start)
            opened += 1
            heapq.heappush(open_, (place, opened, end, speaker))
        yield taken(fields)
    until(math.inf)
    if out:
        yield taken(fields)


def speaker_at(points: DataFrame, turns: DataFrame, at: str = "t", keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """points with speaker_at: the speaker of the first turn (by turn_idx) that holds their time, null if none does.

    An as-of join. Episodes are laid in stretches of STRETCH_S seconds, or of as many as their turns last on average; a turn goes to the stretches that it touches, twice as many rows as turns at most. A sweep makes what is seen of turns: pieces that don't overlap. Points and pieces then stand in one order by time in each stretch, and the last piece that began is carried to the point. So rows grow with points plus turns, and no task gets a long episode whole.
    Points without a time or with a null key have no speaker. Turns that last no time hold none; ends count up to LAST_S.
    """
    prepared(turns.sparkSession)
    keyed = lambda df: [df[k].alias(f"{k}_k") for k in keys]
    names = [f"{k}_k" for k in keys]
    ends = F.least(F.col("start").cast("double") + F.col("duration_s").cast("double"), F.lit(LAST_S))
    t = turns.select(*keyed(turns), F.col("turn_idx").alias("i_"), F.col("start").cast("double").alias("b_"), ends.alias("e_"), F.col("speaker").alias("s_"))
    t = t.where(F.col("b_") < F.col("e_")).dropna(subset=names)
    width = t.groupBy(*names).agg(F.greatest(F.lit(STRETCH_S), F.sum(F.col("e_") - F.col("b_")) / F.count("*")).alias("width_"))
    stretch = lambda c: F.floor(F.col(c) / F.col("width_"))
    laid = t.join(width, names).withColumn("stretch_", F.explode(F.sequence(stretch("b_"), stretch("e_"))))
    laid = laid.select(*names, "stretch_", "i_", "b_", "e_", "s_").repartition(*names, "stretch_").sortWithinPartitions(*names, "stretch_", "b_", "i_")
    pieces = laid.mapInArrow(_visible, laid.drop("i_").schema)
    own = F.struct(*(F.col(f"`{c}`") for c in points.columns)).alias("p_")
    time = F.when(F.abs(F.col(at).cast("double")) <= LAST_S, F.col(at).cast("double"))
    pts = points.select(*keyed(points), own, time.alias("b_")).join(width, names, "left").select(*names, stretch("b_").alias("stretch_"), "b_", "p_")
    none = F.lit(None).cast(pts.schema["p_"].dataType)
    both = pieces.select(*names, "stretch_", "b_", none.alias("p_"), F.struct("e_", "s_").alias("piece_")).unionByName(pts.withColumn("piece_", F.lit(None).cast("struct<e_:double,s_:string>")))
    order = Window.partitionBy(*names, "stretch_").orderBy("b_", F.col("p_").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    last = both.withColumn("piece_", F.last("piece_", ignorenulls=True).over(order)).where("p_ is not null")
    return last.select("p_.*", F.when(F.col("b_") < F.col("piece_.e_"), F.col("piece_.s_")).alias("speaker_at"))
