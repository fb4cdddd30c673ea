"""Figures over a corpus of turns and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import exact_percentiles
from . import turns as T

CAPS = (10, 15, 20, 30, 60, 120)


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def gap_percentiles(segments: DataFrame, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """One row: count, percentiles and maximum of the gaps that don't run backwards."""
    gaps = T.segment_gaps(segments, 0.0, keys).where("raw_gap >= 0").select("raw_gap")
    q = exact_percentiles(gaps, [], "raw_gap", {"p50": 0.5, "p90": 0.9, "p99": 0.99, "p999": 0.999})
    return q.crossJoin(gaps.agg(F.count("*").alias("gaps"), F.max("raw_gap").alias("max_gap"), F.sum("raw_gap").alias("total_s")))  # one row each


def gap_caps(segments: DataFrame, caps: tuple[int, ...] = CAPS, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """For each candidate cap the seconds that it would trim and the gaps over it, in one pass."""
    gaps = T.segment_gaps(segments, 0.0, keys).where("raw_gap >= 0")
    sums = gaps.agg(*(F.sum(F.greatest(F.col("raw_gap") - c, F.lit(0.0))).alias(f"s{c}") for c in caps), *(F.count_if(F.col("raw_gap") > c).alias(f"n{c}") for c in caps))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("cap"), F.col(f"s{c}").alias("trimmed_s"), F.col(f"n{c}").alias("over_cap")) for c in caps)))
    return sums.select(each.alias("c")).select("c.*")


def clusters_per_episode(turns: DataFrame, show: str = "show", keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """Median, mean and range of distinct speakers per episode, by show and for all (show ALL)."""
    each = turns.groupBy(*keys, show).agg(F.countDistinct("speaker").alias("n"))
    out = each.rollup(show).agg(F.median("n").alias("median"), F.avg("n").alias("mean"), F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("episodes"))
    return out.withColumn(show, F.coalesce(show, F.lit("ALL")))


def cluster_histogram(turns: DataFrame, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    return turns.groupBy(*keys).agg(F.countDistinct("speaker").alias("clusters")).groupBy("clusters").agg(F.count("*").alias("episodes"))


def segments_and_turns(segments: DataFrame, cap: float = T.GAP_CAP_S, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """One row: how many segments and turns, the median duration of each, and their ratio."""
    gaps = T.segment_gaps(segments, cap, keys)
    s = gaps.agg(F.count("*").alias("segments"), F.median(F.when(F.col("raw_gap").isNotNull(), F.col("duration_s"))).alias("median_segment_s"))
    t = T.merge_turns(segments, cap, keys).agg(F.count("*").alias("turns"), F.median("duration_s").alias("median_turn_s"))
    return s.crossJoin(t).withColumn("ratio", F.try_divide("segments", "turns"))  # one row each


def concentration(shares: DataFrame, show: str = "show", floor: float = 0.7) -> DataFrame:
    """Shares pooled by duration, and medians over episodes, by show and for all (show ALL); episodes without speech don't count."""
    pooled = lambda c: F.try_divide(F.sum(F.col(c) * F.col("total_s")), F.sum("total_s"))
    out = shares.where("total_s > 0").rollup(show).agg(F.count("*").alias("episodes"), pooled("top1_s_share").alias("pooled_top1"), pooled("top2_s_share").alias("pooled_top2"), F.median("top1_s_share").alias("median_top1"), F.count_if(F.col("top1_s_share") < floor).alias("below_floor"), F.count_if(F.col("top1_s_share") > 0.5).alias("majority"))
    return out.where("episodes > 0").withColumn(show, F.coalesce(show, F.lit("ALL")))


def words_cross_check(shares: DataFrame, show: str = "show") -> DataFrame:
    """The pooled top share by seconds and by words, and the difference, by show and for all."""
    s = F.try_divide(F.sum(F.col("top1_s_share") * F.col("total_s")), F.sum("total_s"))
    w = F.try_divide(F.sum(F.col("top1_words_share") * F.col("total_words")), F.sum("total_words"))
    out = shares.where("total_s > 0").rollup(show).agg(s.alias("by_seconds"), w.alias("by_words"), F.count("*").alias("episodes"))
    return out.where("episodes > 0").withColumn("delta", F.col("by_words") - F.col("by_seconds")).withColumn(show, F.coalesce(show, F.lit("ALL")))


def by_year(turns: DataFrame, shares: DataFrame, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """Drift by show and year: episodes, median clusters, pooled shares, median turn. Both frames hold show and year."""
    each = turns.groupBy("show", "year", *keys).agg(F.countDistinct("speaker").alias("clusters"))
    rows = shares.where("total_s > 0").join(each, ["show", "year", *keys])
    pooled = lambda c: F.try_divide(F.sum(F.col(c) * F.col("total_s")), F.sum("total_s"))
    a = rows.groupBy("show", "year").agg(F.count("*").alias("episodes"), F.median("clusters").alias("median_clusters"), pooled("top1_s_share").alias("pooled_top1"), pooled("top2_s_share").alias("pooled_top2"))
    spoken = shares.where("total_s > 0").select("show", "year", *keys)
    b = turns.join(spoken, ["show", "year", *keys], "left_semi").groupBy("show", "year").agg(F.median("duration_s").alias("median_turn_s"))
    return a.join(b, ["show", "year"])


def clippable(turns: DataFrame, shares: DataFrame, stratum: str = "show", min_turn_s: float = T.LEAD_IN_S + T.CLIP_S, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """By stratum: episodes with speech, those whose dominant speaker has a turn to clip, those with just one such, the median of such turns, the share of clusters to clip, and the share of seconds of those without."""
    long = F.count_if(F.col("duration_s") >= min_turn_s).alias("eligible")
    each = turns.groupBy(*keys, "speaker").agg(long)
    spoken = T.by_speaker(turns, keys=keys).join(each, [*keys, "speaker"])
    rows = spoken.join(shares.where("total_s > 0").select(*keys, stratum, "dominant"), list(keys))
    per = rows.groupBy(stratum, *keys).agg(F.max(F.when(F.col("speaker") == F.col("dominant"), F.col("eligible"))).alias("dominant_turns"), F.count("*").alias("clusters"), F.count_if(F.col("eligible") > 0).alias("ok"), F.sum("seconds").alias("seconds"), F.sum(F.when(F.col("eligible") == 0, F.col("seconds")).otherwise(0.0)).alias("lost"))
    return per.groupBy(stratum).agg(F.count("*").alias("episodes"), F.count_if(F.col("dominant_turns") > 0).alias("dominant_ok"), F.count_if(F.col("dominant_turns") == 1).alias("one_turn"), F.median("dominant_turns").alias("median_turns"), F.try_divide(F.sum("ok"), F.sum("clusters")).alias("clusters_ok"), _ratio(F.sum("lost"), F.sum("seconds")).alias("lost_share"))


def availability(checks: DataFrame, show: str = "show", verdict: str = "verdict") -> DataFrame:
    """Verdicts (OK, ABSENT, DEAD, UNKNOWN) by show and in all (show TOTAL)."""
    count = lambda v: F.count_if(F.col(verdict) == v).alias(v.lower())
    return checks.rollup(show).agg(F.count("*").alias("total"), *map(count, ("OK", "ABSENT", "DEAD", "UNKNOWN"))).withColumn(show, F.coalesce(show, F.lit("TOTAL")))


def vector_profile(df: DataFrame, vector: str = "vector") -> DataFrame:
    """By vector size: rows, and the least, largest and mean length."""
    from ..functions.vectors import norm

    sized = df.where(F.col(vector).isNotNull()).select(F.size(vector).alias("dim"), norm(F.col(vector)).alias("n"))
    return sized.groupBy("dim").agg(F.count("*").alias("vectors"), F.min("n").alias("least"), F.max("n").alias("most"), F.avg("n").alias("mean"))


def rate_histogram(files: DataFrame, target: int = 16000) -> DataFrame:
    """Sample rates of files (episode, rate): files, episodes that hold just this rate, and target / rate."""
    kinds = files.groupBy("episode").agg(F.countDistinct("rate").alias("rates"))
    rows = files.join(kinds, "episode")
    single = F.countDistinct(F.when(F.col("rates") == 1, F.col("episode")))
    return rows.groupBy("rate").agg(F.count("*").alias("files"), single.alias("single_rate_episodes")).withColumn("implied_ratio", F.try_divide(F.lit(float(target)), F.col("rate")))


def same_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: the counts of two derivations of one thing, and whether they agree."""
    return a.agg(F.count("*").alias("first")).crossJoin(b.agg(F.count("*").alias("second"))).withColumn("agree", F.col("first") == F.col("second"))
