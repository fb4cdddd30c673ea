"""Samples: evenly spaced picks, substitutes, and the stratified plan of clips to label."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .turns import CLIP_S, LEAD_IN_S, clip_window, drawn_turns

#: What is skipped of a turn of the impurity probe, how much is cut, and how short it may be.
IMPURITY_LEAD_IN_S, IMPURITY_CLIP_S = 1.0, 5.0
IMPURITY_MIN_S = IMPURITY_LEAD_IN_S + IMPURITY_CLIP_S


def numbered(df: DataFrame, order: list[str], by: list[str] | None = None, index: str = "index", count: str = "n_") -> DataFrame:
    """df with the place of each row in its stratum, from 0, and the stratum's rows. Rows are dealt by ranges of stratum and order, numbered within a range, and ranges are put in order by their counts, so that no task gets a stratum whole."""
    by = by or []
    ranged = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    ranged = written(ranged.withColumn("range_", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy(*by, "range_").agg(F.count("*").alias("k_"))
    of = Window.partitionBy(*(by or [F.lit(1)]))  # as many rows as ranges
    sizes = sizes.select(*(F.col(k).alias(f"{k}_b") for k in by), F.col("range_").alias("range_b"), F.coalesce(F.sum("k_").over(of.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_"), F.sum("k_").over(of).alias(count))
    own = ranged.withColumn("no_", F.row_number().over(Window.partitionBy(*by, "range_").orderBy(*order)) - 1)
    on = [F.col(k).eqNullSafe(F.col(f"{k}_b")) for k in by] + [F.col("range_") == F.col("range_b")]
    return own.join(sizes, on).select(*df.columns, (F.col("no_") + F.col("before_")).alias(index), count)


def spread(df: DataFrame, target: int, index: str = "index", count: str = "n_") -> DataFrame:
    """Of numbered rows, those at int(i * n / target); all, if there are no more than target."""
    if target <= 0:
        return df.where(F.lit(False))
    step = F.col(count) / F.lit(float(target))
    # a row is picked if some i has int(i * step) = index: the least i at or past it decides
    i = F.ceil(F.col(index) / step)
    near = lambda j: (j >= 0) & (j < target) & (F.floor(j * step) == F.col(index))
    return df.where((F.col(count) <= target) | near(i) | near(i - 1) | near(i + 1))


def evenly_spaced(df: DataFrame, order: list[str], target: int, by: list[str] | None = None) -> DataFrame:
    """`target` rows spread over the whole of each stratum, in order: those at int(i * n / target); all, if there are no more. index: the row's place in its stratum."""
    return spread(numbered(df, order, by), target).drop("n_")


def substitute_unavailable(picks: DataFrame, by: str = "stratum") -> DataFrame:
    """picks (by, index, count, unavailable: array of places) to (by, index, chosen): each pick that is unavailable gives way to the next place that is neither picked nor unavailable; null if there is none.

    Picks that wait for a place are served in their order. Along the places of a stratum, the line of those that wait grows by one at an unavailable pick and shrinks by one at a free place, if any wait; so the place that ends the i-th wait is the i-th pick's. Two running sums find these places, and a join by number hands them out.
    """
    lost = picks.select(by, F.explode("unavailable").alias("index")).select(by, F.col("index").cast("long").alias("index")).distinct()
    rows = picks.select(by, F.col("index").cast("long").alias("index")).join(lost.withColumn("gone", F.lit(True)), [by, "index"], "left").withColumn("gone", F.coalesce("gone", F.lit(False)))
    of = picks.groupBy(by).agg(F.max("count").alias("count"))
    every = of.where("count > 0").select(by, F.explode(F.sequence(F.lit(0).cast("long"), F.col("count").cast("long") - 1)).alias("index"))
    free = every.join(lost, [by, "index"], "left_anti").join(rows.select(by, "index"), [by, "index"], "left_anti")
    steps = rows.where("gone").select(by, "index", F.lit(1).alias("step")).unionByName(free.select(by, "index", F.lit(-1).alias("step")))
    along = Window.partitionBy(by).orderBy("index")
    steps = steps.withColumn("sum_", F.sum("step").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    low = F.least(F.min("sum_").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    waiting = F.col("sum_") - F.col("step") - F.coalesce(low, F.lit(0))  # before this step
    steps = steps.withColumn("serves", (F.col("step") < 0) & (waiting > 0)).withColumn("no", F.when(F.col("step") > 0, F.sum(F.when(F.col("step") > 0, 1)).over(along.rowsBetween(Window.unboundedPreceding, 0))))
    steps = steps.withColumn("no", F.coalesce("no", F.when(F.col("serves"), F.sum(F.when(F.col("serves"), 1)).over(along.rowsBetween(Window.unboundedPreceding, 0)))))
    places = steps.where("serves").select(by, "no", F.col("index").alias("place"))
    moved = steps.where("step > 0").join(places, [by, "no"], "left").select(by, "index", "place")
    return rows.join(moved, [by, "index"], "left").select(by, "index", F.when(F.col("gone"), F.col("place")).otherwise(F.col("index")).alias("chosen"))


def clip_parts(turns: DataFrame, episodes: DataFrame, *, seed: str, unavailable: DataFrame | None = None, recent: str = "2026", sample: int = 150, coverage_old: int = 20, coverage_new: int = 10, impurity: int = 15, draws: int = 10, min_turn_s: float = LEAD_IN_S + CLIP_S) -> dict[str, DataFrame]:
    """The clips to cut and label, and what became of the pools. episodes: episode (a file's name), show, date, year, dominant, second_tier; unavailable: episodes whose audio is gone.

    Episodes of the second tier, and those without a dominant speaker or a turn of that one to clip, are left out. Years before `recent` are sampled evenly over (show, date), and a pick without audio gives way to a neighbour (substitute_unavailable); later ones are taken whole, but for those without audio.
    Purposes: precision, the dominant speaker's first draw of each chosen episode; coverage, the first draw of each speaker of some of these; impurity, many draws of shorter turns from some of the speakers covered, of those that have enough. A clip wanted for several purposes stands once.

    plan: clip_id, episode, show, date, stratum, cluster, purposes, seed, draw, turn_start, turn_duration_s, clip_start_s, clip_length_s. substitutions: replaced, by. lost: episode, of the recent ones. counts: one row.
    """
    order = ["show", "date", "episode"]
    long = turns.where(F.col("duration_s") >= min_turn_s)
    some = episodes.where(~F.col("second_tier") & F.col("dominant").isNotNull())
    pool = some.join(long.select("episode", F.col("speaker").alias("dominant")).distinct(), ["episode", "dominant"], "left_semi")
    gone = (unavailable.select("episode").distinct() if unavailable is not None else episodes.select("episode").limit(0)).withColumn("gone", F.lit(True))
    pool = pool.join(gone, "episode", "left").withColumn("gone", F.coalesce("gone", F.lit(False))).withColumn("recent", F.col("year") >= recent)
    old = written(numbered(pool.where("not recent"), order), "old")
    picks = spread(old, sample).select(F.lit("old").alias("stratum"), "index", F.col("n_").alias("count"))
    missing = old.where("gone").agg(F.collect_set("index").alias("unavailable"))  # places of episodes without audio
    chosen = written(substitute_unavailable(picks.crossJoin(F.broadcast(missing))), "chosen")  # one row
    new = pool.where("recent")
    drawn = old.join(chosen.where("chosen is not null").select(F.col("chosen").alias("index")), "index", "left_semi").select(*pool.columns).unionByName(new.where("not gone"))
    drawn = written(drawn.withColumn("seed", F.concat(F.lit(f"{seed}:"), "episode")).withColumn("stratum", F.when(F.col("recent"), F.lit(recent)).otherwise(F.lit(f"pre-{recent}"))), "drawn")
    covered = evenly_spaced(drawn.where("not recent"), order, coverage_old).unionByName(evenly_spaced(drawn.where("recent"), order, coverage_new)).drop("index")
    covered = written(covered.join(long.select("episode", F.col("speaker").alias("cluster")).distinct(), "episode"), "covered")
    short = turns.where(F.col("duration_s") >= IMPURITY_MIN_S).groupBy("episode", F.col("speaker").alias("cluster")).agg(F.count("*").alias("k_")).where(F.col("k_") >= draws).drop("k_")
    able = written(covered.join(short, ["episode", "cluster"], "left_semi"), "able")
    probed = evenly_spaced(able, ["recent", *order, "cluster"], impurity).drop("index")

    kept = ["episode", "show", "date", "stratum", "cluster", "seed", "draw", "purpose"]
    clips = drawn.withColumn("cluster", F.col("dominant")).withColumns({"draw": F.lit(0), "purpose": F.lit("precision")}).select(*kept).unionByName(covered.withColumns({"draw": F.lit(0), "purpose": F.lit("coverage")}).select(*kept))
    clips = clips.groupBy(*kept[:-1]).agg(F.sort_array(F.collect_set("purpose"), asc=False).alias("purposes"))
    many = probed.withColumns({"seed": F.concat("seed", F.lit(":"), "cluster"), "draw": F.explode(F.sequence(F.lit(0), F.lit(draws - 1))), "purposes": F.array(F.lit("impurity"))}).select(*clips.columns)

    def cut(wanted: DataFrame, least: float, lead_in: float, length: float, mark: str) -> DataFrame:
        found = drawn_turns(turns, wanted.withColumnRenamed("cluster", "speaker"), least).withColumnRenamed("speaker", "cluster")
        found = found.withColumn("w_", clip_window(F.col("start"), F.col("duration_s"), F.lit(length), lead_in))
        id_ = F.concat(F.regexp_replace("episode", "\\.[^.]*$", ""), F.lit("--"), "cluster", F.lit(f"--{mark}"), F.col("draw").cast("string"))
        return found.select(id_.alias("clip_id"), *kept[:5], "purposes", "seed", "draw", F.col("start").alias("turn_start"), F.col("duration_s").alias("turn_duration_s"), F.col("w_.start").alias("clip_start_s"), F.col("w_.length").alias("clip_length_s"))

    plan = cut(clips, min_turn_s, LEAD_IN_S, CLIP_S, "d").unionByName(cut(many, IMPURITY_MIN_S, IMPURITY_LEAD_IN_S, IMPURITY_CLIP_S, "i"))
    named = old.select("index", "episode")
    subs = chosen.where("chosen is null or chosen != index").join(named.withColumnRenamed("episode", "replaced"), "index").join(named.select(F.col("index").alias("chosen"), F.col("episode").alias("by")), "chosen", "left").select("replaced", "by")
    n = lambda df, name, test="true": df.agg(F.count_if(F.expr(test)).alias(name))
    rows = [
        n(old, "old_pool"), n(drawn, "old_selected", "not recent"), n(subs, "substituted", "by is not null"), n(subs, "not_substituted", "by is null"),
        n(new, "recent_lost", "gone"), n(drawn, "recent_selected", "recent"), n(episodes, "second_tier", "second_tier"), n(some.join(pool, "episode", "left_anti"), "no_clippable_turn"),
        covered.agg(F.countDistinct("episode").alias("coverage_episodes")), n(covered, "coverage_clusters"), n(probed, "impurity_clusters"), n(covered.join(able, ["episode", "cluster"], "left_anti"), "impurity_too_short"),
    ]
    counts = rows[0]
    for row in rows[1:]:
        counts = counts.crossJoin(F.broadcast(row))  # one row each
    counts = counts.withColumn("old_stride", F.coalesce(F.try_divide(F.col("old_pool").cast("double"), F.col("old_selected")), F.lit(0.0)))
    return {"plan": plan, "substitutions": subs, "lost": new.where("gone").select("episode"), "counts": counts}


def clip_plan(turns: DataFrame, episodes: DataFrame, **more) -> DataFrame:
    """The plan of clip_parts()."""
    return clip_parts(turns, episodes, **more)["plan"]


def plan_counts(turns: DataFrame, episodes: DataFrame, **more) -> DataFrame:
    """One row: sizes of the pools, what was selected, substituted and lost, the stride, and how much is covered and probed."""
    return clip_parts(turns, episodes, **more)["counts"]


def ledger_merge(ledger: DataFrame, more: DataFrame) -> DataFrame:
    """What couldn't be had, by clip_id; entries never leave, later ones (more) replace earlier ones."""
    both = ledger.withColumn("turn_", F.lit(0)).unionByName(more.withColumn("turn_", F.lit(1)), allowMissingColumns=True)
    last = Window.partitionBy("clip_id").orderBy(F.desc("turn_"))
    return both.withColumn("no_", F.row_number().over(last)).where("no_ = 1").drop("no_", "turn_")


def resolved_urls(plan: DataFrame, feed: DataFrame, least: float = 0.9) -> DataFrame:
    """plan (show, episode_number, date ...) with audio_url, null where the feed has none; refuses if under `least` of a show's rows have one."""
    urls = feed.where("coalesce(audio_url, '') != ''").groupBy("show", "episode_number", "date").agg(F.max_by("audio_url", "feed_pos").alias("audio_url"))
    out = plan.join(urls, ["show", "episode_number", "date"], "left")
    short = [r["show"] for r in out.groupBy("show").agg((F.count("audio_url") < least * F.count("*")).alias("short")).where("short").limit(100).collect()]
    if short:
        raise RuntimeError(f"too few audio addresses for {', '.join(sorted(short))}")
    return out


def batches(rows: Iterator, size: int) -> Iterator[list]:
    """Lists of `size` items, for sinks outside Spark that take no more at once."""
    part: list = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part
