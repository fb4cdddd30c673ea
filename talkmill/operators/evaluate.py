"""How well voices are told apart: leave-one-out, precision against truth, cohesion, offset scans."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.vectors import at_ranks, centroids, cosine, dot, doubles, exact_percentiles, norm, percentile_rank, unit
from ..session import prepared
from .identity import assign
from .turns import speaker_at


def leave_one_out_scores(labelled: DataFrame) -> DataFrame:
    """labelled (clip_id, person, vector) to (clip_id, truth, person, score, rank): each clip against all people, its own person's centroid built without it. The own sum is S - v, so that nothing is rebuilt; a person with one clip has no centroid for it, and such clips have no rows.
    """
    rows = labelled.where("vector is not null").select("clip_id", F.col("person").alias("truth"), doubles(F.col("vector")).alias("v"))
    dims = rows.select("truth", F.posexplode("v").alias("i", "x")).groupBy("truth", "i").agg(F.sum("x").alias("s"))
    sums = dims.groupBy("truth").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda e: e["s"]).alias("sum"))
    people = sums.join(rows.groupBy("truth").agg(F.count("*").alias("clips")), "truth").select(F.col("truth").alias("person"), "sum", "clips")
    each = rows.join(people.select(F.col("person").alias("truth"), F.col("clips").alias("own")), "truth").where("own > 1")
    pairs = each.crossJoin(F.broadcast(people))  # enrolled people
    rest = F.when(F.col("person") == F.col("truth"), F.zip_with("sum", "v", lambda a, b: a - b)).otherwise(F.col("sum"))
    scored = pairs.select("clip_id", "truth", "person", "v", rest.alias("c")).select("clip_id", "truth", "person", F.try_divide(dot(F.col("v"), F.col("c")), norm(F.col("v")) * norm(F.col("c"))).alias("score"))
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("clip_id", "truth").orderBy(F.desc("score"), "person")))


def leave_one_out(labelled: DataFrame, threshold: float, margin: float) -> DataFrame:
    """One row: clips scored, correct and skipped, accuracy, percentiles of scores of the same and of other people, and the threshold and margin that they suggest."""
    scores = leave_one_out_scores(labelled)
    predicted = assign(scores, ["clip_id", "truth"], threshold, margin)
    right = predicted.agg(F.count("*").alias("scored"), F.count_if(F.col("person") == F.col("truth")).alias("correct"))
    kind = F.when(F.col("person") == F.col("truth"), "same").otherwise("other")
    q = exact_percentiles(scores.select(kind.alias("kind"), "score"), ["kind"], "score", {"p05": 0.05, "p50": 0.5, "p95": 0.95})
    at = lambda k, p: F.coalesce(F.max(F.when(F.col("kind") == k, F.col(p))), F.lit(0.0))
    q = q.agg(at("same", "p05").alias("same_p05"), at("same", "p50").alias("same_median"), at("other", "p95").alias("other_p95"), at("other", "p50").alias("other_median"))
    everyone = labelled.agg(F.count("*").alias("labels"))
    out = right.crossJoin(q).crossJoin(everyone)  # one row each
    return out.select("scored", "correct", (F.col("labels") - F.col("scored")).alias("skipped"), F.coalesce(F.try_divide("correct", "scored"), F.lit(0.0)).alias("accuracy"), "same_p05", "same_median", "other_p95", "other_median", ((F.col("same_p05") + F.col("other_p95")) / 2).alias("suggested_threshold"), F.greatest(F.lit(0.0), (F.col("same_p05") - F.col("other_p95")) / 4).alias("suggested_margin"))


def confusions(labelled: DataFrame, threshold: float, margin: float) -> DataFrame:
    """(truth, predicted: "None" if refused, clips) of clips that weren't named right."""
    predicted = assign(leave_one_out_scores(labelled), ["clip_id", "truth"], threshold, margin)
    wrong = predicted.where(~F.col("person").eqNullSafe(F.col("truth")))
    return wrong.groupBy("truth", F.coalesce("person", F.lit("None")).alias("predicted")).agg(F.count("*").alias("clips"))


def score_matrix(labelled: DataFrame) -> DataFrame:
    """(truth, person, median): the median leave-one-out score of each person's clips against each of the people."""
    return leave_one_out_scores(labelled).groupBy("truth", "person").agg(F.median("score").alias("median"))


def centroid_cosines(people: DataFrame) -> DataFrame:
    """(p, q, cosine) of each two centroids."""
    a, b = people.select(F.col("person").alias("p"), F.col("centroid").alias("a")), people.select(F.col("person").alias("q"), F.col("centroid").alias("b"))
    return a.join(F.broadcast(b), F.col("p") < F.col("q")).select("p", "q", dot(F.col("a"), F.col("b")).alias("cosine"))  # enrolled people


def cosine_to_mean(people: DataFrame, vectors: DataFrame, vector: str = "vector") -> DataFrame:
    """(person, cosine) of each centroid to the mean of all vectors, each made of unit length first."""
    mean = centroids(vectors.select(F.lit(1).alias("one"), unit(F.col(vector)).alias("u")), ["one"], "u").select(F.col("centroid").alias("m"))
    return people.crossJoin(F.broadcast(mean)).select("person", dot(F.col("centroid"), F.col("m")).alias("cosine"))  # one row


def precision(assigned: DataFrame, truth: DataFrame, keys: list[str]) -> DataFrame:
    """One row: clusters whose clips name one person alone, and how many of these were named right, refused and named wrong."""
    clear = truth.where("person is not null").groupBy(*keys).agg(F.countDistinct("person").alias("n"), F.max("person").alias("truth")).where("n = 1")
    rows = assigned.join(clear, keys)
    same = F.col("person") == F.col("truth")
    return rows.agg(F.count("*").alias("clusters"), F.count_if(same).alias("correct"), F.count_if(F.col("person").isNull()).alias("refused"), F.count_if(~same).alias("wrong"))


#: Rows of a cluster's draws that are multiplied with as many others at a time.
BLOCK = 1000


def _cosines(a: pa.Table, b: pa.Table) -> np.ndarray:
    """cosine() of each row of a with each of b, as a matrix: products of vectors over products of lengths, 0 where there is no length or sizes differ."""
    out = np.zeros((a.num_rows, b.num_rows))
    of = []
    for t in (a, b):
        length = t["length"].to_numpy(zero_copy_only=False).astype(float)  # null as nan
        fine = t["length"].is_valid().to_numpy(zero_copy_only=False) & (length != 0)
        of.append((t["vector"].combine_chunks(), t["size"].to_numpy(zero_copy_only=False), length, fine))
    (va, sa, la, fa), (vb, sb, lb, fb) = of
    for size in np.intersect1d(sa[fa], sb[fb]):
        i, j = np.flatnonzero(fa & (sa == size)), np.flatnonzero(fb & (sb == size))
        matrix = lambda v, at: v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), int(size))
        with np.errstate(all="ignore"):
            lengths = la[i][:, None] * lb[j][None, :]
            found = (matrix(va, i) @ matrix(vb, j).T) / lengths
        out[np.ix_(i, j)] = np.where(lengths == 0, 0.0, found)
    return out


def draw_pairs(crops: DataFrame, keys: tuple[str, ...] = ("episode", "cluster")) -> DataFrame:
    """(keys, a, b, cosine) of each two draws of a cluster. A cluster's draws lie in blocks of some BLOCK rows, of which each two are multiplied as matrices in a task; so a large cluster is many tasks, and a task holds two blocks and their product."""
    prepared(crops.sparkSession)
    there = F.col("draw").isNotNull()
    for k in keys:
        there = there & F.col(k).isNotNull()
    rows = crops.where(there).select(*keys, "draw", "vector", norm(F.col("vector")).alias("length"), F.size("vector").alias("size"))
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).alias("of"))
    rows = rows.join(sizes, list(keys)).withColumn("block", F.pmod(F.xxhash64("draw"), "of")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    met = rows.select(*keys, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), (F.col("block") > F.col("other")).alias("second"), "draw", "vector", "length", "size")

    def pairs(met: pa.Table) -> pa.Table:
        first, second = met.filter(pc.invert(met["second"])), met.filter(met["second"])
        same = met["lo"][0] == met["hi"][0]
        second = first if same else second
        x, y = (t["draw"].to_numpy(zero_copy_only=False) for t in (first, second))
        less = x[:, None] < y[None, :]
        i, j = np.nonzero(less if same else x[:, None] != y[None, :])
        values, up = _cosines(first, second)[i, j] if len(i) else np.zeros(0), less[i, j].astype(bool)
        draws = pa.concat_arrays([c for t in (first, second) for c in t["draw"].chunks]) if first.num_rows + second.num_rows else pa.array([], types[-3])
        j = j + first.num_rows
        columns = [*(pa.repeat(met[k][0], len(i)) for k in keys), draws.take(pa.array(np.where(up, i, j))), draws.take(pa.array(np.where(up, j, i))), pa.array(values)]
        return pa.Table.from_arrays([c.cast(t) for c, t in zip(columns, types)], names)

    kinds = [*(crops.schema[k].dataType for k in keys), crops.schema["draw"].dataType, crops.schema["draw"].dataType, T.DoubleType()]
    names, types = [*keys, "a", "b", "cosine"], [to_arrow_type(k) for k in kinds]
    return met.groupBy(*keys, "lo", "hi").applyInArrow(pairs, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))


def cluster_pairs(clusters: DataFrame) -> DataFrame:
    """(episode, a, b, cosine) of each two clusters of an episode."""
    a = clusters.select("episode", F.col("cluster").alias("a"), F.col("centroid").alias("va"))
    b = clusters.select("episode", F.col("cluster").alias("b"), F.col("centroid").alias("vb"))
    return a.join(b, "episode").where("a < b").select("episode", "a", "b", cosine(F.col("va"), F.col("vb")).alias("cosine"))


def cohesion(pairs: DataFrame, threshold: float, value: str = "cosine") -> DataFrame:
    """One row: how many pairs, percentiles of their cosine, and the share below the threshold."""
    qs = {name: percentile_rank(q) for name, q in (("p05", 0.05), ("p50", 0.5), ("p95", 0.95))}
    out = at_ranks(pairs, value, qs, {"pairs": F.count("*"), "below": F.count_if(F.col(value) < threshold)})
    return out.select(F.coalesce("pairs", F.lit(0)).cast("long").alias("pairs"), F.coalesce(F.try_divide("below", "pairs"), F.lit(0.0)).alias("below"), *qs)


def lengths_agree(crops: DataFrame, short: float = 10.0, long: float = 30.0) -> DataFrame:
    """(episode, cluster, draw, cosine) of a crop at two lengths."""
    of = lambda length, name: crops.where(F.col("length_s") == length).select("episode", "cluster", "draw", F.col("vector").alias(name))
    return of(short, "va").join(of(long, "vb"), ["episode", "cluster", "draw"]).select("episode", "cluster", "draw", cosine(F.col("va"), F.col("vb")).alias("cosine"))


def conflict_verdict(same_person: DataFrame, control: DataFrame) -> DataFrame:
    """One row: conflicting cluster pairs, those whose cosine is under the median of the control's, and that median."""
    middle = at_ranks(control, "cosine", {"lo": lambda n: F.floor((n - 1) / 2), "hi": lambda n: F.floor(n / 2)})
    median = middle.select((F.col("lo") * 0.5 + F.col("hi") * 0.5).alias("control_median"))
    return same_person.crossJoin(F.broadcast(median)).groupBy("control_median").agg(F.count("*").alias("pairs"), F.count_if(F.col("cosine") < F.col("control_median")).alias("below"))  # one row


def nearest_clusters(clips: DataFrame, clusters: DataFrame) -> DataFrame:
    """(episode, cluster, nearest, cosine, swapped): for each clip cluster the nearest archive cluster of its episode; swapped: of an episode with two clusters each is nearest to the other."""
    a = clips.select("episode", "cluster", F.col("centroid").alias("va"))
    b = clusters.select("episode", F.col("cluster").alias("nearest"), F.col("centroid").alias("vb"))
    pairs = a.join(b, "episode").select("episode", "cluster", "nearest", cosine(F.col("va"), F.col("vb")).alias("cosine"))
    best = pairs.groupBy("episode", "cluster").agg(F.min_by(F.struct("nearest", "cosine"), F.struct(-F.col("cosine"), "nearest")).alias("n")).select("episode", "cluster", "n.*")
    w = Window.partitionBy("episode")
    other = F.count_if(F.col("nearest") != F.col("cluster")).over(w)
    return best.withColumn("swapped", (F.count("*").over(w) == 2) & (other == 2))


def offset_scan(crops: DataFrame, turns: DataFrame, references: DataFrame, ratios: list[float], split: str | None = None) -> DataFrame:
    """By ratio r (and the column split): crops whose likeliest reference cluster speaks at r times their start (hit) or doesn't (miss), that no turn covers, that have no reference; accuracy; peak on the first ratio with the best accuracy.

    The likeliest cluster is found once per crop; ratios then multiply rows of crops, not vectors.
    """
    kept = ["crop_id", "episode", "crop_start_s", *([split] if split else [])]
    best = crops.select(*kept, "vector").join(references.select("episode", "cluster", "centroid"), "episode").select(*kept, "cluster", dot(unit(F.col("vector")), F.col("centroid")).alias("s"))
    best = best.groupBy(*kept).agg(F.min_by("cluster", F.struct(-F.col("s"), "cluster")).alias("best"))
    points = best.withColumn("r", F.explode(F.array(*(F.lit(float(r)) for r in ratios)))).withColumn("t", F.col("crop_start_s") * F.col("r"))
    heard = speaker_at(points, turns).join(references.select("episode", F.col("cluster").alias("speaker_at"), F.lit(True).alias("known")), ["episode", "speaker_at"], "left")
    by = ["r", *([split] if split else [])]
    known = F.coalesce(F.col("known"), F.lit(False))
    out = heard.groupBy(*by).agg(F.count_if(known & (F.col("best") == F.col("speaker_at"))).alias("hit"), F.count_if(known & (F.col("best") != F.col("speaker_at"))).alias("miss"), F.count_if(F.col("speaker_at").isNull()).alias("uncovered"), F.count_if(F.col("speaker_at").isNotNull() & ~known).alias("no_reference"))
    out = out.withColumn("accuracy", F.coalesce(F.try_divide("hit", F.col("hit") + F.col("miss")), F.lit(0.0)))
    place = F.array_position(F.array(*(F.lit(float(r)) for r in ratios)), F.col("r"))
    w = Window.partitionBy(*([split] if split else [F.lit(1)])).orderBy(F.desc("accuracy"), place)
    return out.withColumn("peak", F.row_number().over(w) == 1)


