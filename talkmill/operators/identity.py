"""Who speaks: scoring against centroids, assignments, and how identity is stamped, carried and repaired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_cluster, is_non_episode
from ..functions.vectors import centroids, dot, norm

#: Centroids that may be broadcast, at most; enrolled people are counted before.
MAX_PEOPLE = 20_000
#: And bytes of their centroids.
MAX_BYTES = 64 << 20


def voice_labels(labels: DataFrame, vectors: DataFrame) -> DataFrame:
    """Labels that a voice was heard for and that name a person, with their vector."""
    return labels.where("basis = 'voice' and person is not null").join(vectors, "clip_id")


def person_centroids(labels: DataFrame, vectors: DataFrame, weight: str | None = None) -> DataFrame:
    return centroids(voice_labels(labels, vectors), ["person"], "vector", weight)


def cluster_centroids(crops: DataFrame) -> DataFrame:
    """By (episode, cluster), weighted by the turns' true durations; crops without a vector don't count."""
    return centroids(crops.where("vector is not null"), ["episode", "cluster"], "vector", "turn_duration_s")


def _few(people: DataFrame) -> bool:
    """Whether the people's centroids can be sent to all executors: no more than MAX_PEOPLE, of no more than MAX_BYTES."""
    n = people.limit(MAX_PEOPLE + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("centroid")), F.lit(0)).alias("numbers")).first()
    return n["n"] <= MAX_PEOPLE and 8 * n["numbers"] <= MAX_BYTES


def _with_length(vectors: DataFrame, keys: list[str], vector: str) -> DataFrame:
    rows = vectors.select(*keys, F.col(vector).alias("v_")).withColumn("n_", norm(F.col("v_")))
    return rows.withColumn("n_", F.when(F.col("n_") == 0, F.raise_error(F.lit("a vector has no length"))).otherwise(F.col("n_")))


def score(vectors: DataFrame, people: DataFrame, keys: list[str], vector: str = "vector") -> DataFrame:
    """Each vector against each centroid: keys, person, score, rank (by falling score, then name). The vector need not have unit length; one without length raises. For names alone there is assign_vectors(), which ranks no rows.

    People are broadcast if they are few (_few), else joined by Spark's own choice.
    """
    right = people.select("person", F.col("centroid").alias("c_"))
    rows = _with_length(vectors, keys, vector)
    scored = rows.crossJoin(F.broadcast(right) if _few(people) else right).select(*keys, "person", (dot(F.col("v_"), F.col("c_")) / F.col("n_")).alias("score"))
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "person")))


def assign_vectors(vectors: DataFrame, people: DataFrame, keys: list[str], threshold: float, margin: float, vector: str = "vector") -> DataFrame:
    """What assign() gives for these vectors' scores, vector by vector: few people go to each row as one array, whose scores' first two decide, without a shuffle. Many are scored and ranked as rows. Vectors are told apart by keys. Without people there are no rows."""
    if not _few(people):
        return assign(score(vectors, people, keys, vector), keys, threshold, margin)
    every = people.agg(F.collect_list(F.struct("person", "centroid")).alias("p_")).where(F.size("p_") > 0)
    rows = _with_length(vectors, keys, vector).crossJoin(F.broadcast(every))  # one row
    scored = F.array_sort(F.transform("p_", lambda p: F.struct((-dot(F.col("v_"), p["centroid"]) / F.col("n_")).alias("s"), p["person"].alias("person"))))
    top = rows.select(*keys, F.slice(scored, 1, 2).alias("t_"))
    best, second = -F.get("t_", F.lit(0))["s"], -F.get("t_", F.lit(1))["s"]
    refused = (best < threshold) | F.coalesce(best - second < margin, F.lit(False))
    return top.select(*keys, F.when(~refused, F.get("t_", F.lit(0))["person"]).alias("person"), best.alias("best"), second.alias("second"))


def assign(scores: DataFrame, keys: list[str], threshold: float, margin: float) -> DataFrame:
    """The best person, or null: below the threshold, or with a second one closer than the margin. Equality passes; a sole candidate has no margin to hold."""
    best = scores.where("rank <= 2").groupBy(*keys).agg(F.max(F.when(F.col("rank") == 1, F.struct("score", "person"))).alias("b"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("second"))
    refused = (F.col("b.score") < threshold) | F.coalesce(F.col("b.score") - F.col("second") < margin, F.lit(False))
    return best.select(*keys, F.when(~refused, F.col("b.person")).alias("person"), F.col("b.score").alias("best"), "second")


def conflicts(assignments: DataFrame) -> DataFrame:
    """(episode, person) to whom more than one cluster was assigned, with the clusters sorted."""
    named = assignments.where("person is not null")
    return named.groupBy("episode", "person").agg(F.sort_array(F.collect_list("cluster")).alias("clusters")).where(F.size("clusters") > 1)


def assignment_counts(assignments: DataFrame) -> DataFrame:
    """Clusters by person (null: unmatched)."""
    return assignments.groupBy("person").agg(F.count("*").alias("clusters"))


def conflict_rate(assignments: DataFrame, gate: float = 0.05) -> DataFrame:
    """One row: matched and unmatched clusters, conflicting pairs, their rate, and whether it clears the gate."""
    a = assignments.agg(F.count("person").alias("matched"), F.count_if(F.col("person").isNull()).alias("unmatched"))
    b = conflicts(assignments).agg(F.count("*").alias("conflicts"))
    return a.crossJoin(b).withColumn("rate", F.coalesce(F.try_divide("conflicts", "matched"), F.lit(0.0))).withColumn("clears", F.col("rate") <= gate)  # one row each


def usable_segments(segments: DataFrame) -> DataFrame:
    """Segments whose start is a number."""
    return segments.where(F.col("start").isNotNull())


def dropped_segments(segments: DataFrame, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    return segments.groupBy(*keys).agg(F.count_if(F.col("start").isNull()).alias("dropped"), F.count("*").alias("segments"))


def has_identity(records: DataFrame, keys: list[str]) -> DataFrame:
    """Whether any record of an episode carries a name; an empty one is none."""
    named = F.coalesce(F.col("speaker_id"), F.lit("")) != ""
    return records.where(~is_non_episode(F.col("source"))).groupBy(*keys).agg(F.bool_or(named).alias("has_identity"))


def stamp(chunks: DataFrame, identified: DataFrame, version: str | None, keys: list[str]) -> DataFrame:
    """chunks with the person identified for their speaker, and the version on every chunk: unless it is withheld, or people were identified for the episode and none of its chunks matched. What chunks carried stays where nothing new is said."""
    people = identified.select(*keys, "speaker", F.col("person").alias("p_"))
    heard = identified.select(*keys).distinct().withColumn("heard_", F.lit(True))
    df = chunks.join(people, [*keys, "speaker"], "left").join(heard, keys, "left")
    matched = F.count("p_").over(Window.partitionBy(*keys))
    broken = F.coalesce(F.col("heard_"), F.lit(False)) & (matched == 0)
    new = F.when(broken | F.lit(version is None), F.col("identity_version")).otherwise(F.lit(version))
    return df.withColumn("identity_version", new).withColumn("speaker_id", F.coalesce("p_", "speaker_id")).select(*chunks.columns)


def label_map(stored: DataFrame, keys: list[str]) -> DataFrame:
    """By episode and cluster label: the name that its stored records carry, and whether two different ones do. A present name beats an absent one; an empty one is a name here."""
    rows = stored.where(~is_non_episode(F.col("source")) & is_cluster(F.col("speaker")))
    return rows.groupBy(*keys, "speaker").agg(F.max("speaker_id").alias("person"), (F.countDistinct("speaker_id") > 1).alias("conflict"))


def carry_verdicts(stored: DataFrame, chunks: DataFrame, keys: list[str]) -> DataFrame:
    """By episode of chunks: refused (labels with two names) and unmapped (labels that no stored record has), sorted."""
    mapped = label_map(stored, keys)
    coming = chunks.where(is_cluster(F.col("speaker"))).select(*keys, "speaker").distinct()
    unmapped = coming.join(mapped, [*keys, "speaker"], "left_anti").groupBy(*keys).agg(F.sort_array(F.collect_list("speaker")).alias("unmapped"))
    refused = mapped.where("conflict").groupBy(*keys).agg(F.sort_array(F.collect_list("speaker")).alias("refused"))
    out = chunks.select(*keys).distinct().join(refused, keys, "left").join(unmapped, keys, "left")
    empty = F.array().cast("array<string>")
    return out.select(*keys, F.coalesce("refused", empty).alias("refused"), F.coalesce("unmapped", empty).alias("unmapped"))


def carry(stored: DataFrame, chunks: DataFrame, version: str, keys: list[str]) -> DataFrame:
    """chunks with the names of their labels' stored records and the version, for episodes with nothing refused or unmapped; others as they are."""
    verdicts = carry_verdicts(stored, chunks, keys).select(*keys, ((F.size("refused") == 0) & (F.size("unmapped") == 0)).alias("ok_"))
    people = label_map(stored, keys).select(*keys, "speaker", F.col("person").alias("p_"))
    df = chunks.join(verdicts, keys).join(people, [*keys, "speaker"], "left")
    return df.withColumn("speaker_id", F.when(F.col("ok_"), F.coalesce("p_", "speaker_id")).otherwise(F.col("speaker_id"))).withColumn("identity_version", F.when(F.col("ok_"), F.lit(version)).otherwise(F.col("identity_version"))).select(*chunks.columns)


def repair_refusals(records: DataFrame, identified: DataFrame, keys: list[str]) -> DataFrame:
    """By episode, of records or identified: reason (null: go on) and the contradicted labels. Reasons: no_records, broken_join, contradiction."""
    rows = records.where(~is_non_episode(F.col("source"))).join(identified.select(*keys, "speaker", F.col("person").alias("p_")), [*keys, "speaker"], "left")
    named = F.coalesce(F.col("speaker_id"), F.lit("")) != ""
    against = named & is_cluster(F.col("speaker")) & ~F.col("p_").eqNullSafe(F.col("speaker_id"))
    each = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count("p_").alias("matched"), F.sort_array(F.collect_set(F.when(against, F.col("speaker")))).alias("labels"))
    heard = identified.groupBy(*keys).agg(F.count("*").alias("heard"))
    both = each.join(heard, keys, "full_outer").join(records.select(*keys).distinct(), keys, "full_outer")
    reason = F.when(F.coalesce("n", F.lit(0)) == 0, "no_records").when((F.coalesce("heard", F.lit(0)) > 0) & (F.col("matched") == 0), "broken_join").when(F.size("labels") > 0, "contradiction")
    return both.select(*keys, reason.alias("reason"), F.when(reason == "contradiction", F.col("labels")).otherwise(F.array().cast("array<string>")).alias("labels"))


def repair_updates(records: DataFrame, identified: DataFrame, version: str, keys: list[str]) -> DataFrame:
    """(id, speaker_id, identity_version) to merge into the records of episodes that nothing refuses; a null speaker_id changes nothing."""
    fine = repair_refusals(records, identified, keys).where("reason is null").select(*keys)
    rows = records.where(~is_non_episode(F.col("source"))).join(fine, keys, "left_semi")
    people = identified.where(is_cluster(F.col("speaker"))).select(*keys, "speaker", F.col("person").alias("p_"))
    return rows.join(people, [*keys, "speaker"], "left").select("id", F.col("p_").alias("speaker_id"), F.lit(version).alias("identity_version"))


def backfill_updates(assignments: DataFrame, records: DataFrame) -> DataFrame:
    """(id, speaker_id) of the records of each assigned cluster."""
    named = assignments.where("person is not null").select("show", "episode_number", "date", F.col("cluster").alias("speaker"), "person")
    return records.join(named, ["show", "episode_number", "date", "speaker"]).select("id", F.col("person").alias("speaker_id"))


def incomplete_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of which a key is missing; none may be for a plan to hold."""
    missing: Column = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.where(missing)


def stamp_set(assignments: DataFrame, records: DataFrame, version: str) -> DataFrame:
    """(id, identity_version) of all episode records of the assigned episodes, whoever speaks in them."""
    triple = ["show", "episode_number", "date"]
    rows = records.where(~is_non_episode(F.col("source"))).join(assignments.select(*triple).distinct(), triple, "left_semi")
    return rows.select("id", F.lit(version).alias("identity_version"))


def version_to_write(fresh: DataFrame, stored: DataFrame, version: str, keys: list[str]) -> DataFrame:
    """The version for newly transcribed episodes: withheld where stored records already carry a name."""
    named = has_identity(stored, keys)
    return fresh.join(named, keys, "left").withColumn("identity_version", F.when(~F.coalesce("has_identity", F.lit(False)), F.lit(version))).drop("has_identity")
