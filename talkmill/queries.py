"""Queries over the driver's tables that apply the library's operators, and SQL that gives the same rows.

"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import prepared

#: Column names that SQL wants quoted.
KEYWORDS = re.compile(r"(?<!['\"\w])(show|over_cap)(?!['\"\w])")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query and the SQL that gives its rows, where SQL can."""

    def take(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(prepared(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = KEYWORDS.sub(r'"\1"', sql)
        return f

    return take


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adapter(name: str, columns: list[str], where: str | None = None) -> tuple[Callable[[SparkSession, str], DataFrame], str]:
    """A projection of a table for both engines: a reader for Spark, and a SELECT for SQL."""

    sql = f"SELECT {', '.join(columns)} FROM {{}}" + (f" WHERE {where}" if where else "")

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(sql.format("{t}"), t=table(spark, sf_dir, name))

    return read, sql.format(name)


# ---- segments and turns: a user's events are an episode, event types its speakers ----

CAP = 3600.0
_SEQ = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq"
SEG_SQL = f"seg AS (SELECT user_id AS episode, concat('show', user_id % 3) AS show, CASE WHEN user_id % 4 = 0 THEN '2026' ELSE '2025' END AS year, {_SEQ}, event_type AS speaker, epoch_us(ts) / 1000000.0 AS start, props AS text FROM events)"
TURN_SQL = f"""{SEG_SQL}, gap AS (SELECT *, lead(start) OVER w - start AS raw_gap, CASE WHEN lag(speaker) OVER w IS NOT DISTINCT FROM speaker THEN 0 ELSE 1 END AS changed FROM seg WINDOW w AS (PARTITION BY episode ORDER BY seq)),
run AS (SELECT *, sum(changed) OVER (PARTITION BY episode ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run, CASE WHEN raw_gap IS NULL THEN 0.0 ELSE least(greatest(raw_gap, 0.0), {CAP}) END AS dur FROM gap),
turn AS (SELECT episode, show, year, CAST(run - 1 AS BIGINT) AS turn_idx, arg_min(speaker, seq) AS speaker, arg_min(start, seq) AS start, sum(dur) AS duration_s, CAST(sum(len(regexp_extract_all(text, '\\S+'))) AS BIGINT) AS n_words, count(*) AS n_segments FROM run GROUP BY episode, show, year, run)"""
SHARE_SQL = f"""{TURN_SQL}, spk AS (SELECT episode, show, year, speaker, sum(duration_s) AS seconds, sum(n_words) AS words, count(*) AS turns, min(turn_idx) AS first_turn FROM turn WHERE duration_s >= 1.5 GROUP BY episode, show, year, speaker),
rk AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY seconds DESC, first_turn) AS r, row_number() OVER (PARTITION BY episode ORDER BY words DESC) AS rw FROM spk),
tot AS (SELECT episode, sum(seconds) AS total_s, sum(words) AS total_words, count(*) AS n_speakers, sum(turns) AS n_turns, sum(CASE WHEN r = 1 THEN seconds ELSE 0 END) AS t1, sum(CASE WHEN r <= 2 THEN seconds ELSE 0 END) AS t2, sum(CASE WHEN rw = 1 THEN words ELSE 0 END) AS w1, max(CASE WHEN r = 1 THEN speaker END) AS dominant FROM rk GROUP BY episode),
share AS (SELECT e.episode, e.show, e.year, coalesce(total_s, 0.0) AS total_s, CAST(coalesce(total_words, 0) AS BIGINT) AS total_words, CAST(coalesce(n_speakers, 0) AS BIGINT) AS n_speakers, CAST(coalesce(n_turns, 0) AS BIGINT) AS n_turns, coalesce(t1 / nullif(total_s, 0), 0.0) AS top1_s_share, coalesce(t2 / nullif(total_s, 0), 0.0) AS top2_s_share, coalesce(w1 / nullif(CAST(total_words AS DOUBLE), 0), 0.0) AS top1_words_share, dominant
  FROM (SELECT DISTINCT episode, show, year FROM turn) e LEFT JOIN tot ON tot.episode = e.episode)"""
KEYS = ("episode", "show", "year")


def event_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0).alias("start")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("episode"), F.concat(F.lit("show"), F.col("user_id") % 3).alias("show"), F.when(F.col("user_id") % 4 == 0, "2026").otherwise("2025").alias("year"), F.expr(_SEQ), F.col("event_type").alias("speaker"), start, F.col("props").alias("text"))


def event_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.turns import merge_turns

    return merge_turns(event_segments(spark, sf_dir), CAP, KEYS)


def event_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.turns import speech_shares

    return speech_shares(event_turns(spark, sf_dir), keys=KEYS)


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("a1_turn_merge", f"WITH {TURN_SQL} SELECT episode, turn_idx, speaker, round(start, 3) AS start, round(duration_s, 3) AS duration_s, n_words, n_segments FROM turn")
def a1(spark, d):
    out = event_turns(spark, d).select("episode", "turn_idx", "speaker", "start", "duration_s", "n_words", "n_segments")
    return rounded(out, "start", "duration_s", digits=3)


@query("a2_speech_shares", f"WITH {SHARE_SQL} SELECT episode, round(total_s, 3) AS total_s, total_words, n_speakers, n_turns, round(top1_s_share, 6) AS top1_s_share, round(top2_s_share, 6) AS top2_s_share, round(top1_words_share, 6) AS top1_words_share FROM share")
def a2(spark, d):
    out = event_shares(spark, d).drop("show", "year", "dominant")
    return rounded(rounded(out, "total_s", digits=3), "top1_s_share", "top2_s_share", "top1_words_share", digits=6)


@query("a3_dominant_speaker", f"WITH {SHARE_SQL} SELECT episode, dominant FROM share")
def a3(spark, d):
    return event_shares(spark, d).select("episode", "dominant")


@query("a11_non_monotonic", "WITH s AS (SELECT user_id AS episode, value, lead(value) OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) SELECT episode, CAST(count(*) FILTER (WHERE n < value) AS BIGINT) AS non_monotonic FROM s GROUP BY episode")
def a11(spark, d):
    from .operators.turns import non_monotonic

    return non_monotonic(table(spark, d, "events").select(F.col("user_id").alias("episode"), F.col("event_id").alias("seq"), F.col("value").alias("start")))


@query("w1_w2_gaps_and_runs", f"WITH {TURN_SQL} SELECT episode, seq, CAST(run AS BIGINT) AS run, round(dur, 3) AS duration_s FROM run")
def w1(spark, d):
    from pyspark.sql import Window

    from .operators.turns import segment_gaps

    w = Window.partitionBy("episode").orderBy("seq")
    df = segment_gaps(event_segments(spark, d), CAP)
    changed = F.when(F.lag("speaker").over(w).eqNullSafe(F.col("speaker")), 0).otherwise(1)
    return rounded(df.select("episode", F.col("seq").cast("long").alias("seq"), F.sum(changed).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long").alias("run"), "duration_s"), "duration_s", digits=3)


_LONG = "long AS (SELECT *, row_number() OVER (PARTITION BY episode, speaker ORDER BY duration_s DESC, start, turn_idx) - 1 AS draw FROM turn WHERE duration_s >= 12)"


@query("w5_longest_turns", f"WITH {TURN_SQL}, {_LONG} SELECT episode, speaker, CAST(draw AS BIGINT) AS draw, turn_idx FROM long WHERE draw < 3")
def w5(spark, d):
    from .operators.turns import longest_turns

    return longest_turns(event_turns(spark, d), keys=KEYS).select("episode", "speaker", F.col("draw").cast("long").alias("draw"), "turn_idx")


@query(
    "c13_c14_crop_plan",
    f"""WITH {TURN_SQL}, named AS (SELECT * REPLACE (concat('SPEAKER_', speaker) AS speaker) FROM turn WHERE speaker <> 'error'),
long AS (SELECT *, row_number() OVER (PARTITION BY episode, speaker ORDER BY duration_s DESC, start, turn_idx) - 1 AS draw FROM named WHERE duration_s >= 12)
SELECT episode, speaker AS cluster, CAST(draw AS BIGINT) AS draw, length_s, round(start + 2, 3) AS crop_start_s, round(least(length_s, duration_s - 2), 3) AS crop_length_s FROM long CROSS JOIN (SELECT unnest([10.0, 30.0]) AS length_s) WHERE draw < 3""",
)
def c14(spark, d):
    from .operators.turns import crop_plan

    named = event_turns(spark, d).withColumn("speaker", F.when(F.col("speaker") == "error", "UNKNOWN").otherwise(F.concat(F.lit("SPEAKER_"), "speaker")))
    out = crop_plan(named, keys=KEYS).select("episode", "cluster", F.col("draw").cast("long").alias("draw"), "length_s", "crop_start_s", "crop_length_s")
    return rounded(out, "crop_start_s", "crop_length_s", digits=3)


@query("w10_seeded_draw")
def w10(spark, d):
    from .operators.turns import drawn_turn

    return drawn_turn(event_turns(spark, d), "campaign-1", 1, keys=KEYS).select("episode", "speaker", "turn_idx", "draw")


@query(
    "j15_w7_speaker_at",
    f"""WITH {TURN_SQL}, pt AS (SELECT user_id AS episode, event_id, epoch_us(ts) / 1000000.0 + 600 AS t FROM events),
hit AS (SELECT event_id, arg_min(speaker, turn_idx) AS s FROM pt JOIN turn ON turn.episode = pt.episode AND start <= t AND t < start + duration_s GROUP BY event_id)
SELECT pt.event_id, s AS speaker_at FROM pt LEFT JOIN hit ON hit.event_id = pt.event_id""",
)
def j15(spark, d):
    from .operators.turns import speaker_at

    pts = table(spark, d, "events").select(F.col("user_id").alias("episode"), "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0 + 600).alias("t"))
    return speaker_at(pts, event_turns(spark, d)).select("event_id", "speaker_at")


_GAPS = f"WITH {TURN_SQL}, g AS (SELECT raw_gap FROM gap WHERE raw_gap >= 0), o AS (SELECT raw_gap, row_number() OVER (ORDER BY raw_gap) - 1 AS i, count(*) OVER () AS n FROM g)"


def _pct(q: float) -> str:
    return f"max(CASE WHEN i = least(CAST(floor({q} * n) AS BIGINT), n - 1) THEN raw_gap END)"


@query("a16_gap_percentiles", f"{_GAPS} SELECT count(*) AS gaps, round({_pct(0.5)}, 6) AS p50, round({_pct(0.9)}, 6) AS p90, round({_pct(0.99)}, 6) AS p99, round({_pct(0.999)}, 6) AS p999, round(max(raw_gap), 6) AS max_gap, round(sum(raw_gap), 3) AS total_s FROM o")
def a16(spark, d):
    from .operators.stats import gap_percentiles

    return rounded(rounded(gap_percentiles(event_segments(spark, d)), "total_s", digits=3), "p50", "p90", "p99", "p999", "max_gap", digits=6)


@query("a16_gap_caps", f"WITH {TURN_SQL} SELECT CAST(cap AS BIGINT) AS cap, round(sum(greatest(raw_gap - cap, 0.0)), 3) AS trimmed_s, CAST(count(*) FILTER (WHERE raw_gap > cap) AS BIGINT) AS over_cap FROM gap CROSS JOIN (SELECT unnest([600, 3600, 86400]) AS cap) WHERE raw_gap >= 0 GROUP BY cap")
def a16c(spark, d):
    from .operators.stats import gap_caps

    return rounded(gap_caps(event_segments(spark, d), (600, 3600, 86400)).withColumn("cap", F.col("cap").cast("long")), "trimmed_s", digits=3)


_PER = "per AS (SELECT episode, show, count(DISTINCT speaker) AS n FROM turn GROUP BY episode, show)"


@query("a17_clusters_per_episode", f"WITH {TURN_SQL}, {_PER} SELECT coalesce(show, 'ALL') AS show, median(n) AS median, round(avg(n), 6) AS mean, min(n) AS least, max(n) AS most, count(*) AS episodes FROM per GROUP BY GROUPING SETS ((show), ())")
def a17(spark, d):
    from .operators.stats import clusters_per_episode

    return rounded(clusters_per_episode(event_turns(spark, d)), "mean", digits=6)


@query("a17_cluster_histogram", f"WITH {TURN_SQL}, {_PER} SELECT n AS clusters, count(*) AS episodes FROM per GROUP BY n")
def a17h(spark, d):
    from .operators.stats import cluster_histogram

    return cluster_histogram(event_turns(spark, d))


@query("a18_segments_and_turns", f"WITH {TURN_SQL}, s AS (SELECT count(*) AS segments, median(CASE WHEN raw_gap IS NOT NULL THEN dur END) AS ms FROM run), t AS (SELECT count(*) AS turns, median(duration_s) AS mt FROM turn) SELECT segments, turns, round(ms, 3) AS median_segment_s, round(mt, 3) AS median_turn_s, round(segments / CAST(turns AS DOUBLE), 6) AS ratio FROM s CROSS JOIN t")
def a18(spark, d):
    from .operators.stats import segments_and_turns

    return rounded(rounded(segments_and_turns(event_segments(spark, d), CAP), "median_segment_s", "median_turn_s", digits=3), "ratio", digits=6)


@query(
    "a19_concentration",
    f"WITH {SHARE_SQL} SELECT coalesce(show, 'ALL') AS show, count(*) AS episodes, round(sum(top1_s_share * total_s) / sum(total_s), 6) AS pooled_top1, round(sum(top2_s_share * total_s) / sum(total_s), 6) AS pooled_top2, round(median(top1_s_share), 6) AS median_top1, CAST(count(*) FILTER (WHERE top1_s_share < 0.7) AS BIGINT) AS below_floor, CAST(count(*) FILTER (WHERE top1_s_share > 0.5) AS BIGINT) AS majority FROM share WHERE total_s > 0 GROUP BY GROUPING SETS ((show), ())",
)
def a19(spark, d):
    from .operators.stats import concentration

    return rounded(concentration(event_shares(spark, d)), "pooled_top1", "pooled_top2", "median_top1", digits=6)


@query("a22_words_cross_check", f"WITH {SHARE_SQL}, x AS (SELECT coalesce(show, 'ALL') AS show, count(*) AS episodes, sum(top1_s_share * total_s) / sum(total_s) AS s, sum(top1_words_share * total_words) / sum(total_words) AS w FROM share WHERE total_s > 0 GROUP BY GROUPING SETS ((show), ())) SELECT show, episodes, round(s, 6) AS by_seconds, round(w, 6) AS by_words, round(w - s, 6) AS delta FROM x")
def a22(spark, d):
    from .operators.stats import words_cross_check

    return rounded(words_cross_check(event_shares(spark, d)), "by_seconds", "by_words", "delta", digits=6)


@query(
    "a23_by_year",
    f"""WITH {SHARE_SQL}, c AS (SELECT episode, show, year, count(DISTINCT speaker) AS clusters FROM turn GROUP BY episode, show, year),
a AS (SELECT s.show, s.year, count(*) AS episodes, median(clusters) AS median_clusters, round(sum(top1_s_share * total_s) / sum(total_s), 6) AS pooled_top1, round(sum(top2_s_share * total_s) / sum(total_s), 6) AS pooled_top2 FROM share s JOIN c ON c.episode = s.episode WHERE total_s > 0 GROUP BY s.show, s.year),
b AS (SELECT t.show, t.year, round(median(duration_s), 3) AS median_turn_s FROM turn t JOIN share s ON s.episode = t.episode WHERE total_s > 0 GROUP BY t.show, t.year)
SELECT a.show, a.year, episodes, median_clusters, pooled_top1, pooled_top2, median_turn_s FROM a JOIN b ON a.show = b.show AND a.year = b.year""",
)
def a23(spark, d):
    from .operators.stats import by_year

    return rounded(rounded(by_year(event_turns(spark, d), event_shares(spark, d)), "pooled_top1", "pooled_top2", digits=6), "median_turn_s", digits=3)


@query(
    "a24_clippable",
    f"""WITH {SHARE_SQL}, e AS (SELECT episode, speaker, CAST(count(*) FILTER (WHERE duration_s >= 12) AS BIGINT) AS eligible FROM turn GROUP BY episode, speaker),
p AS (SELECT spk.show, spk.episode, max(CASE WHEN spk.speaker = dominant THEN eligible END) AS dt, count(*) AS clusters, count(*) FILTER (WHERE eligible > 0) AS ok, sum(seconds) AS seconds, sum(CASE WHEN eligible = 0 THEN seconds ELSE 0 END) AS lost FROM spk JOIN e ON e.episode = spk.episode AND e.speaker = spk.speaker JOIN share ON share.episode = spk.episode WHERE total_s > 0 GROUP BY spk.show, spk.episode)
SELECT show, count(*) AS episodes, CAST(count(*) FILTER (WHERE dt > 0) AS BIGINT) AS dominant_ok, CAST(count(*) FILTER (WHERE dt = 1) AS BIGINT) AS one_turn, median(dt) AS median_turns, round(sum(ok) / CAST(sum(clusters) AS DOUBLE), 6) AS clusters_ok, round(coalesce(sum(lost) / nullif(sum(seconds), 0), 0), 6) AS lost_share FROM p GROUP BY show""",
)
def a24(spark, d):
    from .operators.stats import clippable

    return rounded(clippable(event_turns(spark, d), event_shares(spark, d), keys=KEYS), "clusters_ok", "lost_share", digits=6)


# ---- vectors: labels are people, even ids are enrolled, odd ones are heard ----

VECTOR_SQL = """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, concat('p', label) AS person FROM embeddings),
dim AS (SELECT vec_id, person, i, e[i] AS x FROM (SELECT vec_id, person, e, unnest(range(1, len(e) + 1)) AS i FROM v))"""
CENTROID_SQL = f"""{VECTOR_SQL}, mean AS (SELECT person, i, avg(x) AS m FROM dim WHERE vec_id % 2 = 0 GROUP BY person, i),
len_ AS (SELECT person, sqrt(sum(m * m)) AS n FROM mean GROUP BY person), cent AS (SELECT mean.person, i, m / n AS c FROM mean JOIN len_ ON mean.person = len_.person)"""
SCORE_SQL = f"""{CENTROID_SQL}, nrm AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM dim GROUP BY vec_id),
sc AS (SELECT dim.vec_id, cent.person, sum(x * c) / max(nrm.n) AS score FROM dim JOIN cent ON cent.i = dim.i JOIN nrm ON nrm.vec_id = dim.vec_id WHERE dim.vec_id % 2 = 1 GROUP BY dim.vec_id, cent.person),
rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, person) AS r FROM sc)"""
ASSIGN_SQL = f"""{SCORE_SQL}, asg AS (SELECT vec_id, CASE WHEN b < 0.2 OR coalesce(b - s < 0.02, false) THEN NULL ELSE p END AS person, b AS best, s AS second FROM (SELECT vec_id, max(CASE WHEN r = 1 THEN score END) AS b, max(CASE WHEN r = 2 THEN score END) AS s, max(CASE WHEN r = 1 THEN person END) AS p FROM rk GROUP BY vec_id)),
cl AS (SELECT CAST(vec_id % 50 AS VARCHAR) AS episode, vec_id AS cluster, person FROM asg)"""


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.concat(F.lit("p"), "label").alias("person"), F.col("embedding").alias("vector"))


def clip_labels(spark: SparkSession, d: str) -> DataFrame:
    """Even ids are heard as voices; a few labels rest on context or were skipped."""
    basis = F.when(F.col("vec_id") % 2 == 1, "context").otherwise("voice")
    return vectors(spark, d).select(F.col("vec_id").alias("clip_id"), basis.alias("basis"), "person")


def clip_vectors(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select(F.col("vec_id").alias("clip_id"), "vector")


def people(spark: SparkSession, d: str) -> DataFrame:
    from .operators.identity import person_centroids

    return person_centroids(clip_labels(spark, d), clip_vectors(spark, d))


def scores(spark: SparkSession, d: str) -> DataFrame:
    from .operators.identity import score

    return score(vectors(spark, d).where("vec_id % 2 = 1").drop("person"), people(spark, d), ["vec_id"])


def assigned(spark: SparkSession, d: str, threshold: float = 0.2, margin: float = 0.02) -> DataFrame:
    from .operators.identity import assign_vectors

    return assign_vectors(vectors(spark, d).where("vec_id % 2 = 1").drop("person"), people(spark, d), ["vec_id"], threshold, margin)


def clusters(spark: SparkSession, d: str) -> DataFrame:
    return assigned(spark, d).select((F.col("vec_id") % 50).cast("string").alias("episode"), F.col("vec_id").alias("cluster"), "person")


def flat(df: DataFrame, keys: list[str], array: str = "centroid", digits: int = 6) -> DataFrame:
    """An array column as rows (i, x), for comparison."""
    return df.select(*keys, F.posexplode(array).alias("i", "x")).select(*keys, (F.col("i") + 1).cast("long").alias("i"), F.round("x", digits).alias("x"))


@query("a6_f10_person_centroids", f"WITH {CENTROID_SQL} SELECT person, i, round(c, 6) AS x FROM cent")
def a6(spark, d):
    return flat(people(spark, d), ["person"])


@query(
    "a4_a5_weighted_centroids",
    f"""WITH {VECTOR_SQL}, m AS (SELECT vec_id % 50 AS episode, person AS cluster, i, sum(x * (1 + vec_id % 7)) / sum(1 + vec_id % 7) AS m FROM dim WHERE vec_id % 11 <> 0 GROUP BY vec_id % 50, person, i),
n AS (SELECT episode, cluster, sqrt(sum(m * m)) AS n FROM m GROUP BY episode, cluster)
SELECT m.episode, m.cluster, i, round(m / n, 6) AS x FROM m JOIN n ON m.episode = n.episode AND m.cluster = n.cluster""",
)
def a5(spark, d):
    from .operators.identity import cluster_centroids

    crops = vectors(spark, d).select((F.col("vec_id") % 50).alias("episode"), F.col("person").alias("cluster"), F.when(F.col("vec_id") % 11 != 0, F.col("vector")).alias("vector"), (1 + F.col("vec_id") % 7).cast("double").alias("turn_duration_s"))
    return flat(cluster_centroids(crops), ["episode", "cluster"])


@query("j13_score", f"WITH {SCORE_SQL} SELECT vec_id, person, round(score, 6) AS score, r AS rank FROM rk")
def j13(spark, d):
    return rounded(scores(spark, d).withColumn("rank", F.col("rank").cast("long")), "score", digits=6)


@query("w4_assign", f"WITH {ASSIGN_SQL} SELECT vec_id, person, round(best, 6) AS best, round(second, 6) AS second FROM asg")
def w4(spark, d):
    return rounded(assigned(spark, d), "best", "second", digits=6)


@query("w4_assign_control", f"WITH {SCORE_SQL} SELECT count(*) AS named FROM rk WHERE r = 1 AND score >= 0.516")
def w4c(spark, d):
    return assigned(spark, d, 0.516, 0.074).agg(F.count("person").alias("named"))


@query("a12_conflicts", f"WITH {ASSIGN_SQL} SELECT episode, person, count(*) AS n, array_to_string(list_sort(list(cluster)), ',') AS clusters FROM cl WHERE person IS NOT NULL GROUP BY episode, person HAVING count(*) > 1")
def a12(spark, d):
    from .operators.identity import conflicts

    return conflicts(clusters(spark, d)).select("episode", "person", F.size("clusters").cast("long").alias("n"), F.array_join("clusters", ",").alias("clusters"))


@query("a13_assignment_counts", f"WITH {ASSIGN_SQL} SELECT person, count(*) AS clusters FROM cl GROUP BY person")
def a13(spark, d):
    from .operators.identity import assignment_counts

    return assignment_counts(clusters(spark, d))


@query("a13_conflict_rate", f"WITH {ASSIGN_SQL}, k AS (SELECT count(*) AS conflicts FROM (SELECT 1 FROM cl WHERE person IS NOT NULL GROUP BY episode, person HAVING count(*) > 1)), m AS (SELECT count(person) AS matched, CAST(count(*) FILTER (WHERE person IS NULL) AS BIGINT) AS unmatched FROM cl) SELECT matched, unmatched, conflicts, round(conflicts / CAST(matched AS DOUBLE), 6) AS rate, conflicts / CAST(matched AS DOUBLE) <= 0.05 AS clears FROM m CROSS JOIN k")
def a13r(spark, d):
    from .operators.identity import conflict_rate

    return rounded(conflict_rate(clusters(spark, d)), "rate", digits=6)


PAIR_SQL = f"""{VECTOR_SQL}, u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v), pr AS (SELECT a.vec_id AS a, b.vec_id AS b, list_dot_product(a.e, b.e) / (a.n * b.n) AS s FROM u a JOIN u b ON a.vec_id < b.vec_id)"""


def pairs(spark: SparkSession, d: str, threshold: float = 0.4) -> DataFrame:
    from .operators.cluster import similar_pairs

    return similar_pairs(vectors(spark, d), "vec_id", "vector", threshold)


@query("j14_similar_pairs", f"WITH {PAIR_SQL} SELECT a, b, round(s, 6) AS similarity FROM pr WHERE s >= 0.4")
def j14(spark, d):
    return rounded(pairs(spark, d), "similarity", digits=6)


@query("j14_similar_pairs_control", f"WITH {PAIR_SQL} SELECT count(*) AS pairs FROM pr WHERE s >= 0.95")
def j14c(spark, d):
    return pairs(spark, d, 0.95).agg(F.count("*").alias("pairs"))


GROUP_SQL = f"""{PAIR_SQL}, ed AS (SELECT a AS x, b AS y FROM pr WHERE s >= 0.4 UNION SELECT b, a FROM pr WHERE s >= 0.4),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT reach.x, ed.y FROM reach JOIN ed ON ed.x = reach.y), comp AS (SELECT x AS vec_id, min(y) AS component FROM reach GROUP BY x)"""


def grouped(spark: SparkSession, d: str) -> DataFrame:
    from .operators.cluster import groups

    return groups(vectors(spark, d), "vec_id", pairs(spark, d))


@query("a14_groups", f"WITH RECURSIVE {GROUP_SQL} SELECT vec_id, component FROM comp")
def a14(spark, d):
    return grouped(spark, d)


@query("a15_group_sizes", f"WITH RECURSIVE {GROUP_SQL}, sz AS (SELECT component, count(DISTINCT vec_id % 50) AS episodes FROM comp GROUP BY component) SELECT episodes, count(*) AS groups, (SELECT count(*) FROM sz WHERE episodes >= 5) AS qualifying, (SELECT count(*) FROM sz WHERE episodes >= 5) >= 15 AS clears FROM sz GROUP BY episodes")
def a15(spark, d):
    from .operators.cluster import group_sizes

    return group_sizes(grouped(spark, d).withColumn("episode", F.col("vec_id") % 50), "episode")


LOO_SQL = f"""{VECTOR_SQL}, tot AS (SELECT person, i, sum(x) AS s FROM dim WHERE vec_id % 2 = 0 GROUP BY person, i), cnt AS (SELECT person, count(DISTINCT vec_id) AS k FROM dim WHERE vec_id % 2 = 0 GROUP BY person),
own AS (SELECT dim.* FROM dim JOIN cnt ON cnt.person = dim.person WHERE vec_id % 2 = 0 AND k > 1),
pp AS (SELECT own.vec_id, own.person AS truth, tot.person, own.x, tot.s - CASE WHEN tot.person = own.person THEN own.x ELSE 0 END AS c FROM own JOIN tot ON tot.i = own.i),
loo AS (SELECT vec_id, truth, person, sum(x * c) / (sqrt(sum(x * x)) * sqrt(sum(c * c))) AS score FROM pp GROUP BY vec_id, truth, person),
lr AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, person) AS r FROM loo),
la AS (SELECT vec_id, truth, CASE WHEN b < 0.1 OR coalesce(b - s < 0.01, false) THEN NULL ELSE p END AS person FROM (SELECT vec_id, truth, max(CASE WHEN r = 1 THEN score END) AS b, max(CASE WHEN r = 2 THEN score END) AS s, max(CASE WHEN r = 1 THEN person END) AS p FROM lr GROUP BY vec_id, truth)),
lo AS (SELECT score, person = truth AS same, row_number() OVER (PARTITION BY person = truth ORDER BY score) - 1 AS i, count(*) OVER (PARTITION BY person = truth) AS n FROM loo)"""


def _at(same: str, q: float) -> str:
    return f"max(CASE WHEN {same} AND i = least(CAST(floor({q} * n) AS BIGINT), n - 1) THEN score END)"


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).where("vec_id % 2 = 0").withColumnRenamed("vec_id", "clip_id")


@query(
    "a26_leave_one_out",
    f"""WITH {LOO_SQL}, p AS (SELECT {_at("same", 0.05)} AS s5, {_at("same", 0.5)} AS s50, {_at("NOT same", 0.95)} AS o95, {_at("NOT same", 0.5)} AS o50 FROM lo), c AS (SELECT count(*) AS scored, CAST(count(*) FILTER (WHERE person = truth) AS BIGINT) AS correct FROM la)
SELECT scored, correct, (SELECT count(*) FROM embeddings WHERE vec_id % 2 = 0) - scored AS skipped, round(correct / CAST(scored AS DOUBLE), 6) AS accuracy, round(s5, 6) AS same_p05, round(s50, 6) AS same_median, round(o95, 6) AS other_p95, round(o50, 6) AS other_median, round((s5 + o95) / 2, 6) AS suggested_threshold, round(greatest(0.0, (s5 - o95) / 4), 6) AS suggested_margin FROM c CROSS JOIN p""",
)
def a26(spark, d):
    from .operators.evaluate import leave_one_out

    out = leave_one_out(labelled(spark, d), 0.1, 0.01)
    return rounded(out, *(c for c in out.columns if c not in ("scored", "correct", "skipped")), digits=6)


@query("a26_confusions", f"WITH {LOO_SQL} SELECT truth, coalesce(person, 'None') AS predicted, count(*) AS clips FROM la WHERE person IS DISTINCT FROM truth GROUP BY truth, coalesce(person, 'None')")
def a26c(spark, d):
    from .operators.evaluate import confusions

    return confusions(labelled(spark, d), 0.1, 0.01)


@query("a28_score_matrix", f"WITH {LOO_SQL} SELECT truth, person, round(median(score), 6) AS median FROM loo GROUP BY truth, person")
def a28(spark, d):
    from .operators.evaluate import score_matrix

    return rounded(score_matrix(labelled(spark, d)), "median", digits=6)


@query("a30_centroid_cosines", f"WITH {CENTROID_SQL} SELECT a.person AS p, b.person AS q, round(sum(a.c * b.c), 6) AS cosine FROM cent a JOIN cent b ON a.i = b.i AND a.person < b.person GROUP BY a.person, b.person")
def a30(spark, d):
    from .operators.evaluate import centroid_cosines

    return rounded(centroid_cosines(people(spark, d)), "cosine", digits=6)


@query(
    "a29_cosine_to_mean",
    f"""WITH {CENTROID_SQL}, nn AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM dim GROUP BY vec_id), g AS (SELECT i, avg(x / n) AS m FROM dim JOIN nn ON nn.vec_id = dim.vec_id GROUP BY i), gl AS (SELECT sqrt(sum(m * m)) AS n FROM g)
SELECT person, round(sum(c * m / gl.n), 6) AS cosine FROM cent JOIN g ON g.i = cent.i CROSS JOIN gl GROUP BY person""",
)
def a29(spark, d):
    from .operators.evaluate import cosine_to_mean

    return rounded(cosine_to_mean(people(spark, d), vectors(spark, d)), "cosine", digits=6)


@query("a27_j22_precision", f"WITH {ASSIGN_SQL}, tr AS (SELECT vec_id % 50 AS episode, max(person) AS truth FROM v WHERE vec_id % 2 = 1 AND vec_id % 50 < 40 GROUP BY vec_id % 50 HAVING count(DISTINCT person) = 1), x AS (SELECT cl.person, truth FROM cl JOIN tr ON CAST(tr.episode AS VARCHAR) = cl.episode) SELECT count(*) AS clusters, CAST(count(*) FILTER (WHERE person = truth) AS BIGINT) AS correct, CAST(count(*) FILTER (WHERE person IS NULL) AS BIGINT) AS refused, CAST(count(*) FILTER (WHERE person <> truth) AS BIGINT) AS wrong FROM x")
def a27(spark, d):
    from .operators.evaluate import precision

    truth = vectors(spark, d).where("vec_id % 2 = 1 and vec_id % 50 < 40").select((F.col("vec_id") % 50).cast("string").alias("episode"), "person")
    return precision(clusters(spark, d), truth, ["episode"])


DRAW_SQL = f"""{VECTOR_SQL}, un AS (SELECT vec_id, person, e, sqrt(list_dot_product(e, e)) AS n FROM v), dp AS (SELECT a.vec_id % 50 AS episode, a.person AS cluster, a.vec_id AS a, b.vec_id AS b, list_dot_product(a.e, b.e) / (a.n * b.n) AS cosine FROM un a JOIN un b ON a.vec_id % 50 = b.vec_id % 50 AND a.person = b.person AND a.vec_id < b.vec_id)"""


def draws(spark: SparkSession, d: str) -> DataFrame:
    from .operators.evaluate import draw_pairs

    return draw_pairs(vectors(spark, d).select((F.col("vec_id") % 50).alias("episode"), F.col("person").alias("cluster"), F.col("vec_id").alias("draw"), "vector"))


@query("j20_draw_pairs", f"WITH {DRAW_SQL} SELECT episode, cluster, a, b, round(cosine, 6) AS cosine FROM dp")
def j20(spark, d):
    return rounded(draws(spark, d), "cosine", digits=6)


@query("a31_cohesion", f"WITH {DRAW_SQL}, o AS (SELECT cosine AS score, row_number() OVER (ORDER BY cosine) - 1 AS i, count(*) OVER () AS n FROM dp) SELECT count(*) AS pairs, round(count(*) FILTER (WHERE score < 0.1) / CAST(count(*) AS DOUBLE), 6) AS below, round({_at('true', 0.05)}, 6) AS p05, round({_at('true', 0.5)}, 6) AS p50, round({_at('true', 0.95)}, 6) AS p95 FROM o")
def a31(spark, d):
    from .operators.evaluate import cohesion

    return rounded(cohesion(draws(spark, d), 0.1), "below", "p05", "p50", "p95", digits=6)


@query("a39_conflict_verdict", f"WITH {DRAW_SQL}, ct AS (SELECT median(cosine) AS m FROM dp WHERE episode % 2 = 0) SELECT round(m, 6) AS control_median, count(*) AS pairs, CAST(count(*) FILTER (WHERE cosine < m) AS BIGINT) AS below FROM dp CROSS JOIN ct WHERE episode % 2 = 1 GROUP BY m")
def a39(spark, d):
    from .operators.evaluate import conflict_verdict

    p = draws(spark, d)
    return rounded(conflict_verdict(p.where("episode % 2 = 1"), p.where("episode % 2 = 0")), "control_median", digits=6)


@query("a42_vector_profile", f"WITH {VECTOR_SQL}, z AS (SELECT len(e) AS dim, sqrt(list_dot_product(e, e)) AS n FROM v) SELECT CAST(dim AS INTEGER) AS dim, count(*) AS vectors, round(min(n), 6) AS least, round(max(n), 6) AS most, round(avg(n), 6) AS mean FROM z GROUP BY dim")
def a42(spark, d):
    from .operators.stats import vector_profile

    return rounded(vector_profile(vectors(spark, d)), "least", "most", "mean", digits=6)


@query("j18_lengths_agree", f"WITH {VECTOR_SQL}, un AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v) SELECT a.vec_id % 50 AS episode, a.vec_id AS draw, round(list_dot_product(a.e, b.e) / (a.n * b.n), 6) AS cosine FROM un a JOIN un b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0")
def j18(spark, d):
    from .operators.evaluate import lengths_agree

    even = (F.col("vec_id") - F.col("vec_id") % 2).alias("draw")
    crops = vectors(spark, d).select((F.col("vec_id") - F.col("vec_id") % 2).alias("k"), F.lit("c").alias("cluster"), even, F.when(F.col("vec_id") % 2 == 0, 10.0).otherwise(30.0).alias("length_s"), "vector").withColumn("episode", F.col("k") % 50)
    return rounded(lengths_agree(crops).select("episode", "draw", "cosine"), "cosine", digits=6)


#: Even ids are clips, odd ones archive clusters; of each sixteen vectors in turn one half makes episodes of two clusters, the other of four.
_SIDE = "CAST(floor(vec_id / 2) AS BIGINT)"
_EPISODE = f"CAST(floor({_SIDE} / 8) AS BIGINT) * 10 + CAST(floor(({_SIDE} % 8) / (CASE WHEN CAST(floor({_SIDE} / 8) AS BIGINT) % 2 = 0 THEN 2 ELSE 4 END)) AS BIGINT)"
_MEMBER = f"{_SIDE} % (CASE WHEN CAST(floor({_SIDE} / 8) AS BIGINT) % 2 = 0 THEN 2 ELSE 4 END)"
NEAR_SQL = f"{VECTOR_SQL}, c1 AS (SELECT {_EPISODE} AS episode, {_MEMBER} AS cluster, e FROM v WHERE vec_id % 2 = 0), c2 AS (SELECT {_EPISODE} AS episode, {_MEMBER} AS nearest, e FROM v WHERE vec_id % 2 = 1), q AS (SELECT c1.episode, cluster, nearest, list_dot_product(c1.e, c2.e) / (sqrt(list_dot_product(c1.e, c1.e)) * sqrt(list_dot_product(c2.e, c2.e))) AS cosine FROM c1 JOIN c2 ON c1.episode = c2.episode), b AS (SELECT *, row_number() OVER (PARTITION BY episode, cluster ORDER BY cosine DESC, nearest) AS r FROM q) SELECT episode, cluster, nearest, round(cosine, 6) AS cosine, count(*) OVER (PARTITION BY episode) = 2 AND count(*) FILTER (WHERE nearest <> cluster) OVER (PARTITION BY episode) = 2 AS swapped FROM b WHERE r = 1"


@query("j21_w9_nearest_clusters", "WITH " + NEAR_SQL)
def j21(spark, d):
    from .operators.evaluate import nearest_clusters

    of = lambda side: vectors(spark, d).where(F.col("vec_id") % 2 == side).select(F.expr(_EPISODE).alias("episode"), F.expr(_MEMBER).alias("cluster"), F.col("vector").alias("centroid"))
    return rounded(nearest_clusters(of(0), of(1)), "cosine", digits=6)


# ---- records, volume and feed: orders are episodes, line items their records ----

_KEY = "concat('Show ', {k} % 3) AS show, CASE WHEN {k} % 41 = 0 THEN 'Unknown' ELSE CAST({k} AS STRING) END AS episode_number, concat('2024-', lpad(CAST(1 + {k} % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + {k} % 28 AS STRING), 2, '0')) AS date"
RECORDS, RECORDS_SQL = adapter(
    "lineitem",
    [
        _KEY.format(k="l_orderkey"),
        "CASE WHEN l_orderkey % 59 = 0 THEN concat('Show_0-ep', l_orderkey % 4, '-', l_linenumber - 1) WHEN l_orderkey % 97 = 0 THEN concat('loose', CAST(l_linenumber AS STRING), 'x', CAST(l_orderkey AS STRING)) WHEN l_orderkey % 53 = 0 THEN concat('Show_', l_orderkey % 3, '-ep', CAST(l_orderkey AS STRING), '-', l_linenumber - 1) ELSE concat('Show_', l_orderkey % 3, '-ep', CASE WHEN l_orderkey % 41 = 0 THEN 'Unknown' ELSE CAST(l_orderkey AS STRING) END, '-2024-', lpad(CAST(1 + l_orderkey % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + l_orderkey % 28 AS STRING), 2, '0'), '-', l_linenumber - 1) END AS id",
        "l_orderkey * 100 + l_partkey % 100 AS pos",
        "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE 4 END AS n_chunks",
        "CASE WHEN l_orderkey % 17 = 0 THEN 'book' WHEN l_orderkey % 3 = 0 THEN 'podcast' ELSE NULL END AS source",
        "CASE WHEN l_linenumber % 7 = 6 THEN 'UNKNOWN' ELSE concat('SPEAKER_0', l_linenumber % 3) END AS speaker",
        "CASE WHEN l_suppkey % 4 = 0 THEN concat('P', l_suppkey % 3) WHEN l_suppkey % 9 = 0 THEN '' ELSE NULL END AS speaker_id",
        "CASE WHEN l_orderkey % 11 = 0 THEN '0' ELSE '1' END AS rules_version",
        "CASE WHEN l_orderkey % 6 = 0 THEN '0@1' WHEN l_orderkey % 13 = 0 THEN NULL ELSE '1@1' END AS identity_version",
        "CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE concat('g', CAST(l_orderkey AS STRING)) END AS episode_guid",
    ],
)
VOLUME, VOLUME_SQL = adapter("orders", [_KEY.format(k="o_orderkey")], "o_orderkey % 7 <> 3")
FEED, FEED_SQL = adapter("orders", [_KEY.format(k="o_orderkey"), "o_orderkey AS feed_pos", "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('g', CAST(o_orderkey AS STRING)) END AS guid"], "o_orderstatus <> 'P'")
EXCLUDED, EXCLUDED_SQL = adapter("orders", [_KEY.format(k="o_orderkey"), "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('g', CAST(o_orderkey AS STRING)) END AS guid"], "o_orderkey % 301 = 5")
_BASE = f"rec AS ({RECORDS_SQL}), vol AS (SELECT DISTINCT * FROM ({VOLUME_SQL})), feed AS ({FEED_SQL}), exc AS ({EXCLUDED_SQL}), ep AS (SELECT *, CASE WHEN regexp_matches(id, '-[0-9]+$') THEN CAST(regexp_extract(id, '-([0-9]+)$', 1) AS BIGINT) END AS i FROM rec WHERE coalesce(source, 'podcast') = 'podcast')"
_K = "show, episode_number, date"
_SAME = "a.show = b.show AND a.episode_number = b.episode_number AND a.date = b.date"


def anti(a: str, b: str, on: str = _SAME) -> str:
    return f"SELECT a.* FROM ({a}) a WHERE NOT EXISTS (SELECT 1 FROM ({b}) b WHERE {on})"


def semi(a: str, b: str, on: str = _SAME) -> str:
    return f"SELECT a.* FROM ({a}) a WHERE EXISTS (SELECT 1 FROM ({b}) b WHERE {on})"


_EXCLUDES = f"(({_SAME}) OR (a.show = b.show AND a.episode_guid = b.guid))"
_STORED = f"SELECT DISTINCT {_K} FROM ep"
_PRESENT = f"SELECT DISTINCT {_K} FROM ({semi(f'SELECT DISTINCT {_K}, episode_guid FROM ep', 'SELECT * FROM exc', _EXCLUDES)})"
FAULTS_SQL = {
    "missing": anti(anti("SELECT * FROM vol", "SELECT * FROM exc"), _STORED),
    "extra": anti(anti(_STORED, "SELECT * FROM vol"), _PRESENT),
    "excluded_with_records": _PRESENT,
    "feed_unreachable": anti("SELECT * FROM vol", "SELECT * FROM feed"),
    "incomplete": f"SELECT {_K} FROM (SELECT {_K}, count(*) AS ids, arg_max(n_chunks, id) AS n FROM ep GROUP BY {_K}) WHERE n IS NOT NULL AND ids <> n",
    "non_contiguous": f"SELECT {_K} FROM ep WHERE i IS NOT NULL GROUP BY {_K} HAVING min(i) <> 0 OR max(i) <> count(*) - 1 OR count(DISTINCT i) <> count(*)",
}
REPORT_SQL = f"WITH {_BASE}, rep AS (" + " UNION ALL ".join(f"SELECT '{name}' AS fault_class, {_K}, NULL AS prefix FROM ({sql})" for name, sql in FAULTS_SQL.items())
REPORT_SQL += f" UNION ALL SELECT 'shared_prefixes', NULL, NULL, NULL, prefix FROM (SELECT regexp_replace(id, '-[0-9]+$', '') AS prefix FROM ep WHERE i IS NOT NULL GROUP BY regexp_replace(id, '-[0-9]+$', '') HAVING count(DISTINCT concat({_K.replace(', ', chr(44) + chr(39) + '|' + chr(39) + chr(44))})) > 1))"


def report(spark: SparkSession, d: str) -> DataFrame:
    from .operators.reconcile import report

    return report(VOLUME(spark, d), RECORDS(spark, d), FEED(spark, d), EXCLUDED(spark, d))


@query("j7_reconcile", f"{REPORT_SQL} SELECT * FROM rep")
def j7(spark, d):
    return report(spark, d)


@query("j7_is_clean", f"{REPORT_SQL} SELECT CAST(count(*) FILTER (WHERE fault_class <> 'feed_unreachable') AS BIGINT) AS faults, CAST(count(*) FILTER (WHERE fault_class = 'feed_unreachable') AS BIGINT) AS informative, count(*) FILTER (WHERE fault_class <> 'feed_unreachable') = 0 AS is_clean FROM rep")
def j7c(spark, d):
    from .operators.reconcile import is_clean

    return is_clean(report(spark, d))


for _name, _id in (("missing", "u3"), ("extra", "u4"), ("feed_unreachable", "u5"), ("incomplete", "a8"), ("non_contiguous", "a9")):

    def _fault(spark, d, name=_name):
        return report(spark, d).where(F.col("fault_class") == name).select("show", "episode_number", "date")

    query(f"{_id}_{_name}", f"WITH {_BASE} SELECT {_K} FROM ({FAULTS_SQL[_name]})")(_fault)


@query("a7_shared_prefixes", f"WITH {_BASE} SELECT regexp_replace(id, '-[0-9]+$', '') AS prefix, count(DISTINCT concat(show, '|', episode_number, '|', date)) AS episodes FROM ep WHERE i IS NOT NULL GROUP BY regexp_replace(id, '-[0-9]+$', '') HAVING count(DISTINCT concat(show, '|', episode_number, '|', date)) > 1")
def a7(spark, d):
    from .operators.reconcile import shared_prefixes

    return shared_prefixes(RECORDS(spark, d))


@query("f4_f5_j8_not_excluded", f"WITH {_BASE} SELECT id, {_K} FROM ({anti('SELECT * FROM ep', 'SELECT * FROM exc', _EXCLUDES)})")
def j8(spark, d):
    from .operators.reconcile import episodes_of, not_excluded

    return not_excluded(episodes_of(RECORDS(spark, d)), EXCLUDED(spark, d)).select("id", "show", "episode_number", "date")


@query("a10_complete", f"WITH {_BASE}, c AS (SELECT {_K}, count(*) AS ids, count(i) AS ix, count(DISTINCT i) AS dx, min(i) AS lo, max(i) AS hi, max(n_chunks) AS n FROM rec2 GROUP BY {_K}) SELECT {_K}, coalesce(CASE WHEN n = 0 THEN ids = 0 ELSE ids = ix AND dx = n AND lo = 0 AND hi = n - 1 END, false) AS complete FROM c".replace("rec2", "(SELECT *, CASE WHEN regexp_matches(id, '-[0-9]+$') THEN CAST(regexp_extract(id, '-([0-9]+)$', 1) AS BIGINT) END AS i FROM rec) z"))
def a10(spark, d):
    from .operators.reconcile import completeness, is_complete

    return completeness(RECORDS(spark, d)).select("show", "episode_number", "date", is_complete(F.col("stored_n")).alias("complete"))


@query("j23_u9_multiset_difference", f"WITH {_BASE}, x AS (SELECT episode_number, count(*) AS a FROM vol GROUP BY episode_number), y AS (SELECT episode_number, count(*) AS b FROM feed GROUP BY episode_number) SELECT coalesce(x.episode_number, y.episode_number) AS episode_number, CAST(coalesce(a, 0) AS BIGINT) AS in_first, CAST(coalesce(b, 0) AS BIGINT) AS in_second FROM x FULL OUTER JOIN y ON x.episode_number = y.episode_number WHERE coalesce(a, 0) <> coalesce(b, 0)")
def j23(spark, d):
    from .operators.reconcile import multiset_difference

    return multiset_difference(VOLUME(spark, d).distinct(), FEED(spark, d), "episode_number")


_WROTE = f"SELECT *, concat('Show_', substr(show, 6, 1), '-ep', episode_number, '-', date, '-', CAST(k AS VARCHAR)) AS id FROM (SELECT DISTINCT {_K}, concat('g', episode_number) AS episode_guid FROM ep WHERE date < '2024-03' AND episode_number <> 'Unknown') CROSS JOIN (SELECT unnest(range(3)) AS k)"


def _wrote(spark: SparkSession, d: str) -> DataFrame:
    from .functions.text import chunk_id, id_prefix
    from .operators.reconcile import episodes_of

    e = episodes_of(RECORDS(spark, d)).where("date < '2024-03' and episode_number != 'Unknown'").select("show", "episode_number", "date", F.concat(F.lit("g"), "episode_number").alias("episode_guid")).distinct()
    return e.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn("id", chunk_id(id_prefix(F.col("show"), F.col("episode_number"), F.col("date")), F.col("k")))


@query("u1_u2_prune_set", f"WITH {_BASE}, wr AS ({_WROTE}) SELECT DISTINCT id FROM ep a WHERE (EXISTS (SELECT 1 FROM wr b WHERE {_SAME}) OR EXISTS (SELECT 1 FROM wr b WHERE b.show = a.show AND b.episode_guid = a.episode_guid)) AND NOT EXISTS (SELECT 1 FROM wr b WHERE b.id = a.id)")
def u2(spark, d):
    from .operators.reconcile import prune_set

    return prune_set(RECORDS(spark, d), _wrote(spark, d))


_STATE = f"st AS (SELECT {_K}, count(*) AS ids, count(i) AS ix, count(DISTINCT i) AS dx, min(i) AS lo, max(i) AS hi, arg_max(rules_version, id) AS rv, arg_max(identity_version, id) AS iv FROM ep GROUP BY {_K})"
EXPECTED, EXPECTED_SQL = adapter("orders", [_KEY.format(k="o_orderkey"), "CASE WHEN o_orderkey % 19 = 0 THEN 0 ELSE 1 + o_orderkey % 3 END AS n_expected"], "o_orderkey % 7 <> 3 AND o_orderkey % 41 <> 0")
PLAN_SQL = f"""{_BASE}, {_STATE}, xp AS ({EXPECTED_SQL}), plan AS (SELECT f.show, f.episode_number, f.date, f.guid, f.feed_pos, CASE WHEN EXISTS (SELECT 1 FROM exc b WHERE (b.show = f.show AND b.episode_number = f.episode_number AND b.date = f.date) OR (b.show = f.show AND b.guid = f.guid)) THEN 'EXCLUDE' WHEN n_expected IS NULL THEN 'TRANSCRIBE' WHEN n_expected = 0 THEN 'UNPARSEABLE'
  WHEN NOT coalesce(ids = ix AND dx = n_expected AND lo = 0 AND hi = n_expected - 1, false) THEN 'EMBED_ONLY' WHEN rv IS DISTINCT FROM '1' THEN 'EMBED_ONLY' WHEN iv IS DISTINCT FROM '1@1' THEN 'IDENTIFY_ONLY' ELSE 'SKIP' END AS action
  FROM feed f LEFT JOIN xp ON xp.show = f.show AND xp.episode_number = f.episode_number AND xp.date = f.date LEFT JOIN st ON st.show = f.show AND st.episode_number = f.episode_number AND st.date = f.date WHERE f.episode_number <> 'Unknown')"""


def planned(spark: SparkSession, d: str) -> DataFrame:
    from .plans.planning import episode_state, plan_show

    return plan_show(FEED(spark, d).where("episode_number != 'Unknown'"), EXPECTED(spark, d), episode_state(RECORDS(spark, d)), EXCLUDED(spark, d), current_rules="1", current_identity="1@1")


@query("p1_p2_j6_plan", f"WITH {PLAN_SQL} SELECT {_K}, guid, feed_pos, action FROM plan")
def p1(spark, d):
    return planned(spark, d)


@query("h4_cap_work", f"WITH {PLAN_SQL}, e AS (SELECT show, episode_number, feed_pos, row_number() OVER (PARTITION BY show ORDER BY feed_pos) AS r, count(*) OVER (PARTITION BY show) AS n FROM plan WHERE action = 'EMBED_ONLY') SELECT show, episode_number, feed_pos, CAST(greatest(n - 5, 0) AS BIGINT) AS left_over FROM e WHERE r <= 5")
def h4(spark, d):
    from .plans.planning import cap_work

    return cap_work(planned(spark, d).where("action = 'EMBED_ONLY'"), 5).select("show", "episode_number", "feed_pos", F.col("left_over").cast("long").alias("left_over"))


@query("h5_guard", f"WITH {PLAN_SQL} SELECT show, action, episode_number, count(*) OVER (PARTITION BY show, action) AS n, count(*) OVER (PARTITION BY show, action) > 40 AS refused FROM plan")
def h5(spark, d):
    from .plans.planning import guard

    return guard(planned(spark, d).withColumn("k", F.concat_ws("|", "show", "action")), 40, "k").select("show", "action", "episode_number", "n", "refused")


@query("a36_guid_sets", f"WITH {_BASE} SELECT episode_guid, array_to_string(list_sort(list(DISTINCT concat(episode_number, '@', date))), ',') AS stored FROM ep WHERE episode_guid IS NOT NULL GROUP BY episode_guid")
def a36(spark, d):
    from .operators.reconcile import episodes_of

    rows = episodes_of(RECORDS(spark, d)).where("episode_guid is not null")
    return rows.groupBy("episode_guid").agg(F.array_join(F.array_sort(F.collect_set(F.concat("episode_number", F.lit("@"), "date"))), ",").alias("stored"))


MAP_SQL = f"""{_BASE}, px AS (SELECT *, regexp_extract(id, '^(.*)-([0-9]+)$', 1) AS prefix, replace(concat(show, '-ep', episode_number), ' ', '_') AS old_p, replace(concat(show, '-ep', episode_number, '-', date), ' ', '_') AS new_p FROM rec),
mp AS (SELECT *, CASE WHEN coalesce(source, 'podcast') <> 'podcast' OR NOT regexp_matches(id, '^(.*)-([0-9]+)$') THEN 'passthrough_non_episode' WHEN prefix = new_p OR prefix = old_p THEN 'remapped' ELSE 'passthrough_unmatched' END AS classification FROM px),
nw AS (SELECT *, CASE WHEN classification = 'remapped' AND prefix = old_p THEN concat(new_p, '-', regexp_extract(id, '^(.*)-([0-9]+)$', 2)) ELSE id END AS new_id FROM mp)"""


@query("c9_remap_ids", f"WITH {MAP_SQL} SELECT pos, id, new_id, classification FROM nw")
def c9(spark, d):
    from .operators.migrate import remap_ids

    return remap_ids(RECORDS(spark, d)).select("pos", "id", "new_id", "classification")


@query("a37_classification", f"WITH {MAP_SQL}, r AS (SELECT classification, id, row_number() OVER (PARTITION BY classification ORDER BY id) AS r FROM nw) SELECT classification, count(*) AS records, array_to_string(list_sort(list(CASE WHEN r <= 5 THEN id END) FILTER (WHERE r <= 5)), ',') AS sample FROM r GROUP BY classification")
def a37(spark, d):
    from .operators.migrate import classification_counts, remap_ids

    return classification_counts(remap_ids(RECORDS(spark, d))).withColumn("sample", F.array_join("sample", ","))


@query("c10_enriched", f"WITH {_BASE}, xp AS ({EXPECTED_SQL}) SELECT r.pos, r.id, CAST(coalesce(n_expected, r.n_chunks, -1) AS BIGINT) AS n_chunks, CASE WHEN n_expected IS NULL THEN r.rules_version ELSE '2' END AS rules_version, CASE WHEN n_expected IS NULL THEN r.episode_guid ELSE coalesce(f.guid, r.episode_guid) END AS episode_guid FROM rec r LEFT JOIN xp ON xp.show = r.show AND xp.episode_number = r.episode_number AND xp.date = r.date LEFT JOIN feed f ON f.show = r.show AND f.episode_number = r.episode_number AND f.date = r.date AND f.episode_number <> 'Unknown'")
def c10(spark, d):
    from .operators.migrate import enriched, episode_facts

    facts = episode_facts(EXPECTED(spark, d), FEED(spark, d).where("episode_number != 'Unknown'"), "2")
    return enriched(RECORDS(spark, d), facts).select("pos", "id", F.coalesce("n_chunks", F.lit(-1)).cast("long").alias("n_chunks"), "rules_version", "episode_guid")


@query("c11_k12_rekey", f"WITH {_BASE} SELECT pos, concat('Show_', substr(show, 6, 1), '-epN', episode_number, '-', date, '-', i) AS id, concat('N', episode_number) AS episode_number FROM ep WHERE id LIKE '%2024-%' AND i IS NOT NULL AND id LIKE concat('%-ep', episode_number, '-2024%')")
def c11(spark, d):
    from .operators.migrate import rekey
    from .operators.reconcile import episodes_of

    rows = episodes_of(RECORDS(spark, d)).where(F.expr("id like '%2024-%' and id rlike '-[0-9]+$' and id like concat('%-ep', episode_number, '-2024%')"))
    return rekey(rows.withColumn("old", F.col("episode_number")), F.concat(F.lit("N"), "old"), F.col("old")).select("pos", "id", "episode_number")


RENUM, RENUM_SQL = adapter("orders", ["concat('Show ', o_orderkey % 3) AS show", "CASE WHEN o_orderkey % 3 = 0 THEN concat('R', CAST(o_orderkey AS STRING)) ELSE CAST(o_orderkey AS STRING) END AS episode_number", "concat('2024-', lpad(CAST(1 + o_orderkey % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + (o_orderkey + CASE WHEN o_orderkey % 15 = 0 THEN 1 ELSE 0 END) % 28 AS STRING), 2, '0')) AS date", "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat('g', CAST(o_orderkey - o_orderkey % 2 AS STRING)) END AS guid"], "o_orderkey % 2 = 1 OR o_orderkey % 3 = 0")
STORED, STORED_SQL = adapter("orders", ["concat('Show ', o_orderkey % 3) AS show", "CAST(o_orderkey AS STRING) AS episode_number", "concat('2024-', lpad(CAST(1 + o_orderkey % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + o_orderkey % 28 AS STRING), 2, '0')) AS date", "concat('g', CAST(o_orderkey - CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS STRING)) AS guid"], "o_orderkey % 4 <> 1")
HELD, HELD_SQL = adapter("orders", ["concat('Show ', o_orderkey % 3) AS show", "CAST(o_orderkey AS STRING) AS episode_number", "concat('2024-', lpad(CAST(1 + o_orderkey % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + o_orderkey % 28 AS STRING), 2, '0')) AS date"], "o_orderkey % 9 <> 0")
VERDICT_SQL = f"""fe AS ({RENUM_SQL}), st AS ({STORED_SQL}), vo AS ({HELD_SQL}), exc AS ({EXCLUDED_SQL}),
en AS (SELECT * FROM fe a WHERE NOT EXISTS (SELECT 1 FROM vo b WHERE {_SAME}) AND NOT EXISTS (SELECT 1 FROM exc b WHERE {_SAME}) AND NOT EXISTS (SELECT 1 FROM exc b WHERE b.show = a.show AND b.guid = a.guid)),
ol AS (SELECT DISTINCT show, guid, episode_number AS o_n, date AS o_d FROM st WHERE guid IS NOT NULL),
pe AS (SELECT en.show, en.episode_number, en.date, en.guid, count(o_n) AS olds, max(o_n) AS old_number, max(o_d) AS old_date FROM en LEFT JOIN ol ON ol.show = en.show AND ol.guid = en.guid AND NOT (o_n = en.episode_number AND o_d = en.date) GROUP BY en.show, en.episode_number, en.date, en.guid),
ve AS (SELECT pe.*, CASE WHEN coalesce(guid, '') = '' THEN 'no_guid' WHEN olds = 0 THEN 'new' WHEN olds > 1 THEN 'several' WHEN old_date <> date THEN 'date_moved' WHEN NOT EXISTS (SELECT 1 FROM vo b WHERE b.show = pe.show AND b.episode_number = pe.old_number AND b.date = pe.old_date) THEN 'no_file' WHEN EXISTS (SELECT 1 FROM fe b WHERE b.show = pe.show AND b.episode_number = pe.old_number AND b.date = pe.old_date) THEN 'still_in_feed' ELSE 'rename' END AS verdict FROM pe)"""


@query("j9_renumber_plan", f"WITH {VERDICT_SQL} SELECT {_K}, guid, verdict, CASE WHEN verdict = 'rename' THEN old_number END AS old_number FROM ve")
def j9(spark, d):
    from .operators.migrate import renumber_verdicts

    return renumber_verdicts(RENUM(spark, d), HELD(spark, d), STORED(spark, d), EXCLUDED(spark, d))


@query("j9_orphans", f"WITH {VERDICT_SQL} SELECT * FROM (SELECT DISTINCT * FROM vo) a WHERE NOT EXISTS (SELECT 1 FROM fe b WHERE {_SAME}) AND NOT EXISTS (SELECT 1 FROM st b WHERE {_SAME}) AND NOT EXISTS (SELECT 1 FROM ve b WHERE verdict = 'rename' AND b.show = a.show AND b.old_number = a.episode_number AND b.date = a.date) AND NOT EXISTS (SELECT 1 FROM exc b WHERE {_SAME})")
def j9o(spark, d):
    from .operators.migrate import orphans, renumber_verdicts

    v = renumber_verdicts(RENUM(spark, d), HELD(spark, d), STORED(spark, d), EXCLUDED(spark, d))
    return orphans(RENUM(spark, d), HELD(spark, d), STORED(spark, d), EXCLUDED(spark, d), v)


# ---- identity over records: clusters of an order were identified by the supplier's number ----

IDENT, IDENT_SQL = adapter("orders", [_KEY.format(k="o_orderkey"), "concat('SPEAKER_0', o_custkey % 4) AS speaker", "concat('P', o_custkey % 3) AS person"], "o_orderkey % 2 = 0 AND o_orderkey % 41 <> 0")
_IDJ = "LEFT JOIN idn ON idn.show = e.show AND idn.episode_number = e.episode_number AND idn.date = e.date AND idn.speaker = e.speaker"
ID_SQL = f"{_BASE}, idn AS ({IDENT_SQL})"
TRIPLE = ["show", "episode_number", "date"]


@query(
    "j1_stamp",
    f"""WITH {ID_SQL}, j AS (SELECT e.*, idn.person, count(idn.person) OVER (PARTITION BY e.show, e.episode_number, e.date) AS m, EXISTS (SELECT 1 FROM idn q WHERE q.show = e.show AND q.episode_number = e.episode_number AND q.date = e.date) AS heard FROM rec e {_IDJ})
SELECT pos, id, coalesce(person, speaker_id) AS speaker_id, CASE WHEN heard AND m = 0 THEN identity_version ELSE '2@1' END AS identity_version FROM j""",
)
def j1(spark, d):
    from .operators.identity import stamp

    return stamp(RECORDS(spark, d), IDENT(spark, d), "2@1", TRIPLE).select("pos", "id", "speaker_id", "identity_version")


_LM = f"lm AS (SELECT {_K}, speaker, max(speaker_id) AS person, count(DISTINCT speaker_id) > 1 AS conflict FROM ep WHERE speaker LIKE 'SPEAKER_%' GROUP BY {_K}, speaker)"
CHUNKS, CHUNKS_SQL = adapter("orders", [_KEY.format(k="o_orderkey"), "concat('SPEAKER_0', o_custkey % 3) AS speaker", "CAST(NULL AS STRING) AS speaker_id", "CAST(NULL AS STRING) AS identity_version"], "o_orderkey % 41 <> 0")
CARRY_SQL = f"""{_BASE}, {_LM}, ch AS ({CHUNKS_SQL}), vd AS (SELECT c.*, EXISTS (SELECT 1 FROM lm b WHERE b.conflict AND b.show = c.show AND b.episode_number = c.episode_number AND b.date = c.date) AS refused, NOT EXISTS (SELECT 1 FROM lm b WHERE b.speaker = c.speaker AND b.show = c.show AND b.episode_number = c.episode_number AND b.date = c.date) AS unmapped FROM ch c)"""


@query("j2_carry_identity", f"WITH {CARRY_SQL} SELECT v.show, v.episode_number, v.date, v.speaker, CASE WHEN refused OR unmapped THEN NULL ELSE lm.person END AS speaker_id, CASE WHEN refused OR unmapped THEN NULL ELSE '1@1' END AS identity_version FROM vd v LEFT JOIN lm ON lm.show = v.show AND lm.episode_number = v.episode_number AND lm.date = v.date AND lm.speaker = v.speaker")
def j2(spark, d):
    from .operators.identity import carry

    return carry(RECORDS(spark, d), CHUNKS(spark, d), "1@1", TRIPLE)


@query("j24_carry_verdicts", f"WITH {CARRY_SQL} SELECT v.show, v.episode_number, v.date, coalesce((SELECT array_to_string(list_sort(list(b.speaker)), ',') FROM lm b WHERE b.conflict AND b.show = v.show AND b.episode_number = v.episode_number AND b.date = v.date), '') AS refused, CASE WHEN unmapped THEN speaker ELSE '' END AS unmapped FROM vd v")
def j24(spark, d):
    from .operators.identity import carry_verdicts

    out = carry_verdicts(RECORDS(spark, d), CHUNKS(spark, d), TRIPLE)
    return out.withColumns({c: F.array_join(c, ",") for c in ("refused", "unmapped")})


REPAIR_SQL = f"""{ID_SQL}, rj AS (SELECT e.*, idn.person FROM ep e {_IDJ}), ag AS (SELECT {_K}, count(*) AS n, count(person) AS m, count(*) FILTER (WHERE coalesce(speaker_id, '') <> '' AND speaker LIKE 'SPEAKER_%' AND person IS DISTINCT FROM speaker_id) AS bad FROM rj GROUP BY {_K}),
al AS (SELECT DISTINCT {_K} FROM rec UNION SELECT DISTINCT {_K} FROM idn),
rf AS (SELECT al.show, al.episode_number, al.date, CASE WHEN coalesce(n, 0) = 0 THEN 'no_records' WHEN m = 0 AND EXISTS (SELECT 1 FROM idn q WHERE q.show = al.show AND q.episode_number = al.episode_number AND q.date = al.date) THEN 'broken_join' WHEN bad > 0 THEN 'contradiction' END AS reason FROM al LEFT JOIN ag ON ag.show = al.show AND ag.episode_number = al.episode_number AND ag.date = al.date)"""


@query("j3_repair_refusals", f"WITH {REPAIR_SQL} SELECT {_K}, reason FROM rf")
def j3(spark, d):
    from .operators.identity import repair_refusals

    return repair_refusals(RECORDS(spark, d), IDENT(spark, d), TRIPLE).drop("labels")


@query("j3_repair_updates", f"WITH {REPAIR_SQL} SELECT rj.id, CASE WHEN rj.speaker LIKE 'SPEAKER_%' THEN rj.person END AS speaker_id, '1@1' AS identity_version FROM rj JOIN rf ON rf.show = rj.show AND rf.episode_number = rj.episode_number AND rf.date = rj.date WHERE reason IS NULL")
def j3u(spark, d):
    from .operators.identity import repair_updates

    return repair_updates(RECORDS(spark, d), IDENT(spark, d), "1@1", TRIPLE)


@query("j4_backfill", f"WITH {ID_SQL} SELECT e.id, idn.person AS speaker_id FROM rec e JOIN idn ON idn.show = e.show AND idn.episode_number = e.episode_number AND idn.date = e.date AND idn.speaker = e.speaker")
def j4(spark, d):
    from .operators.identity import backfill_updates

    return backfill_updates(IDENT(spark, d).withColumnRenamed("speaker", "cluster"), RECORDS(spark, d))


@query("j5_stamp_set", f"WITH {ID_SQL} SELECT id, '1@1' AS identity_version FROM ({semi('SELECT * FROM ep', 'SELECT * FROM idn')})")
def j5(spark, d):
    from .operators.identity import stamp_set

    return stamp_set(IDENT(spark, d), RECORDS(spark, d), "1@1")


@query("f8_p5_has_identity", f"WITH {_BASE} SELECT {_K}, max(CASE WHEN coalesce(speaker_id, '') <> '' THEN 1 ELSE 0 END) = 1 AS has_identity FROM ep GROUP BY {_K}")
def f8(spark, d):
    from .operators.identity import has_identity

    return has_identity(RECORDS(spark, d), TRIPLE)


_STAMP = f"SELECT {_K}, count(*) AS chunks, CAST(count(*) FILTER (WHERE identity_version = '1@1') AS BIGINT) AS stamped, count(DISTINCT nullif(speaker_id, '')) AS names, count(DISTINCT speaker) AS clusters FROM ep GROUP BY {_K}"


@query("a33_a35_stamps", f"WITH {_BASE} {_STAMP}")
def a33(spark, d):
    from .operators.reconcile import episodes_of

    rows = episodes_of(RECORDS(spark, d))
    return rows.groupBy(*TRIPLE).agg(F.count("*").alias("chunks"), F.count_if(F.col("identity_version") == "1@1").alias("stamped"), F.countDistinct(F.nullif("speaker_id", F.lit(""))).alias("names"), F.countDistinct("speaker").alias("clusters"))


@query("a34_backfill_counts", f"WITH {_BASE} SELECT nullif(speaker_id, '') AS person, count(*) AS records FROM rec WHERE coalesce(speaker_id, '') <> '' GROUP BY nullif(speaker_id, '') UNION ALL SELECT 'nobody of this name', count(*) FROM rec WHERE speaker_id = 'nobody of this name'")
def a34(spark, d):
    rows = RECORDS(spark, d).where("coalesce(speaker_id, '') != ''")
    control = rows.where("speaker_id = 'nobody of this name'").agg(F.lit("nobody of this name").alias("person"), F.count("*").alias("records"))
    return rows.groupBy(F.col("speaker_id").alias("person")).agg(F.count("*").alias("records")).unionByName(control)


@query("a40_backlog", f"WITH {_BASE}, r AS ({anti(semi('SELECT * FROM vol', 'SELECT * FROM feed'), 'SELECT * FROM exc')}), o AS ({anti('SELECT * FROM r', 'SELECT * FROM ep WHERE identity_version = ' + chr(39) + '1@1' + chr(39))}), x AS (SELECT show, count(*) AS reachable FROM r GROUP BY GROUPING SETS ((show), ())), y AS (SELECT show, count(*) AS owed FROM o GROUP BY GROUPING SETS ((show), ())) SELECT coalesce(x.show, 'ALL') AS show, reachable, CAST(coalesce(owed, 0) AS BIGINT) AS owed FROM x LEFT JOIN y ON x.show IS NOT DISTINCT FROM y.show")
def a40(spark, d):
    from .operators.reconcile import backlog, episodes_of

    return backlog(VOLUME(spark, d), FEED(spark, d), EXCLUDED(spark, d), episodes_of(RECORDS(spark, d)).where("identity_version = '1@1'"))


# ---- transcripts and chunks: conversations are transcripts, paragraphs of documents are segments ----

TEXTS, TEXTS_SQL = adapter("conversations", ["conv_id", "turn", "concat('[SPEAKER_', role, '] ', CAST(turn * 7 AS STRING), '.5s - ', replace(text, chr(10), ' ')) AS line"])


def transcripts(spark: SparkSession, d: str) -> DataFrame:
    """Whole transcripts with headers, a blank and a malformed line."""
    whole = TEXTS(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "line"))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: x["line"]), "\r\n")
    return whole.select(F.col("conv_id").alias("episode"), F.concat(F.lit("# Show - Episode 1\n# A title\n# Published: 2024-01-01\n\n"), body, F.lit("\nthis line is malformed\n")).alias("text"))


@query("c1_s1_parse_segments", "SELECT conv_id AS episode, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS seq, concat('SPEAKER_', role) AS speaker, turn * 7 + 0.5 AS start, md5(trim(replace(text, chr(10), ' '))) AS text_md5 FROM conversations")
def c1(spark, d):
    from .functions.text import segments

    return segments(transcripts(spark, d)).select("episode", F.col("seq").cast("long").alias("seq"), "speaker", "start", F.md5("text").alias("text_md5"))


@query("c19_titles", "SELECT DISTINCT conv_id AS episode, 'A title' AS title FROM conversations")
def c19(spark, d):
    from .functions.text import title_of

    return transcripts(spark, d).select("episode", title_of(F.col("text")).alias("title"))


_W = "list_filter(regexp_split_to_array(x, '\\s+'), lambda w: w <> '')"
_PARA = "SELECT doc_id AS episode, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS seq FROM documents"
CHUNK_SQL = f"""p AS ({_PARA}), s AS (SELECT episode, seq, concat('P', seq % 3) AS speaker, seq * 5.0 AS start, {_W} AS words FROM p), n AS (SELECT episode, max(seq) AS last FROM s GROUP BY episode),
fold AS (SELECT episode, CAST(-1 AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS speaker, CAST(0 AS DOUBLE) AS start, CAST([] AS VARCHAR[]) AS buf, CAST([] AS VARCHAR[]) AS done, CAST([] AS DOUBLE[]) AS ats FROM n
  UNION ALL SELECT f.episode, s.seq, s.speaker,
    CASE WHEN len(k.kept) + len(s.words) >= 400 THEN s.start WHEN (f.speaker IS DISTINCT FROM s.speaker AND len(f.buf) > 0) OR len(f.buf) = 0 THEN s.start ELSE f.start END,
    CASE WHEN len(k.kept) + len(s.words) >= 400 THEN list_concat(k.kept, s.words)[-50:] ELSE list_concat(k.kept, s.words) END,
    list_concat(f.done, list_concat(CASE WHEN f.speaker IS DISTINCT FROM s.speaker AND len(f.buf) > 0 THEN [concat('[', f.speaker, '] ', array_to_string(f.buf, ' '))] ELSE CAST([] AS VARCHAR[]) END, CASE WHEN len(k.kept) + len(s.words) >= 400 THEN [concat('[', s.speaker, '] ', array_to_string(list_concat(k.kept, s.words)[1:400], ' '))] ELSE CAST([] AS VARCHAR[]) END)),
    list_concat(f.ats, list_concat(CASE WHEN f.speaker IS DISTINCT FROM s.speaker AND len(f.buf) > 0 THEN [f.start] ELSE CAST([] AS DOUBLE[]) END, CASE WHEN len(k.kept) + len(s.words) >= 400 THEN [CASE WHEN (f.speaker IS DISTINCT FROM s.speaker AND len(f.buf) > 0) OR len(f.buf) = 0 THEN s.start ELSE f.start END] ELSE CAST([] AS DOUBLE[]) END))
  FROM fold f JOIN s ON s.episode = f.episode AND s.seq = f.seq + 1 CROSS JOIN LATERAL (SELECT CASE WHEN f.speaker IS DISTINCT FROM s.speaker AND len(f.buf) > 0 THEN f.buf[-50:] ELSE f.buf END AS kept) k),
fin AS (SELECT f.episode, list_concat(done, CASE WHEN len(buf) > 0 THEN [concat('[', speaker, '] ', array_to_string(buf, ' '))] ELSE CAST([] AS VARCHAR[]) END) AS done, list_concat(ats, CASE WHEN len(buf) > 0 THEN [start] ELSE CAST([] AS DOUBLE[]) END) AS ats FROM fold f JOIN n ON n.episode = f.episode AND n.last = f.seq)"""


def paragraphs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "documents").select(F.col("doc_id").alias("episode"), F.posexplode(F.split("text", "\n")).alias("seq", "text"))
    return p.withColumns({"speaker": F.concat(F.lit("P"), F.col("seq") % 3), "start": F.col("seq") * F.lit(5.0)})


@query("c2_w3_build_chunks", f"WITH RECURSIVE {CHUNK_SQL} SELECT episode, CAST(unnest(range(len(done))) AS BIGINT) AS chunk_index, CAST(len(done) AS BIGINT) AS n_chunks, unnest(ats) AS start_time, md5(unnest(done)) AS text_md5 FROM fin")
def c2(spark, d):
    from .operators.chunking import build_chunks

    return build_chunks(paragraphs(spark, d)).select("episode", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("n_chunks").cast("long").alias("n_chunks"), "start_time", F.md5("text").alias("text_md5"))


@query("c2_streamed_chunks", f"WITH RECURSIVE {CHUNK_SQL} SELECT episode, CAST(unnest(range(len(done))) AS BIGINT) AS chunk_index, CAST(len(done) AS BIGINT) AS n_chunks, unnest(ats) AS start_time, md5(unnest(done)) AS text_md5 FROM fin")
def c2s(spark, d):
    from .operators.chunking import build_chunks_streamed

    return build_chunks_streamed(paragraphs(spark, d)).select("episode", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("n_chunks").cast("long").alias("n_chunks"), "start_time", F.md5("text").alias("text_md5"))


@query("c2_chunks_folded", f"WITH RECURSIVE {CHUNK_SQL} SELECT episode, CAST(unnest(range(len(done))) AS BIGINT) AS chunk_index, CAST(len(done) AS BIGINT) AS n_chunks, unnest(ats) AS start_time, md5(unnest(done)) AS text_md5 FROM fin")
def c2f(spark, d):
    from .operators.chunking import fold_chunks

    return fold_chunks(paragraphs(spark, d)).select("episode", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("n_chunks").cast("long").alias("n_chunks"), "start_time", F.md5("text").alias("text_md5"))


@query("c3_expected_chunks", f"WITH RECURSIVE {CHUNK_SQL} SELECT episode, CAST(len(done) AS BIGINT) AS n_chunks FROM fin WHERE len(done) > 0")
def c3(spark, d):
    from .operators.chunking import expected_chunks

    return expected_chunks(paragraphs(spark, d))


@query(
    "c4_w8_book_chunks",
    f"""WITH b AS (SELECT source AS book, doc_id AS page, unnest({_W.replace("x,", "text,")}) AS w, unnest(range(len({_W.replace("x,", "text,")}))) AS k FROM documents), o AS (SELECT book, page, w, row_number() OVER (PARTITION BY book ORDER BY page, k) - 1 AS g FROM b),
t AS (SELECT book, max(g) + 1 AS n FROM o GROUP BY book), i AS (SELECT book, unnest(range(CAST(floor((n - 1) / 350) AS BIGINT) + 1)) AS i FROM t)
SELECT i.book, i AS chunk_index, min(page) AS page, count(*) AS n_words, md5(string_agg(w, ' ' ORDER BY g)) AS text_md5 FROM i JOIN o ON o.book = i.book AND g >= i * 350 AND g < i * 350 + 400 GROUP BY i.book, i""",
)
def c4(spark, d):
    from .operators.chunking import book_chunks

    out = book_chunks(table(spark, d, "documents"), "source", "doc_id", "text")
    return out.select("book", "chunk_index", "page", F.col("n_words").cast("long").alias("n_words"), F.md5("text").alias("text_md5"))


# ---- names, headers, feed fields, rendering ----

NAMES, NAMES_SQL = adapter("orders", ["o_orderkey", "concat('Show ', o_orderkey % 3, ' - Episode ', CASE WHEN o_orderkey % 7 = 0 THEN 'a b' ELSE CAST(o_orderkey AS STRING) END, ' - 2024-', lpad(CAST(o_orderkey % 14 AS STRING), 2, '0'), '-', lpad(CAST(o_orderkey % 33 AS STRING), 2, '0'), '.txt') AS name"])
_NAME_RE = "^(.+) - Episode (\\w+) - (\\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\\d|3[01])|Unknown Date)\\.txt$"


@query("c5_c20_file_names", f"SELECT o_orderkey, CASE WHEN regexp_matches(name, '{_NAME_RE}') THEN regexp_extract(name, '{_NAME_RE}', 1) END AS show, CASE WHEN regexp_matches(name, '{_NAME_RE}') THEN regexp_extract(name, '{_NAME_RE}', 2) END AS episode_number, CASE WHEN regexp_matches(name, '{_NAME_RE}') THEN regexp_extract(name, '{_NAME_RE}', 3) END AS date, concat('Show ', o_orderkey % 3) AS show_of FROM ({NAMES_SQL})")
def c5(spark, d):
    from .functions.text import file_triple, show_of

    return NAMES(spark, d).withColumn("k", file_triple(F.col("name"))).select("o_orderkey", "k.show", "k.episode_number", "k.date", show_of(F.col("name")).alias("show_of"))


@query("c6_ids", f"SELECT replace(concat(show, '-ep', episode_number, '-', date), ' ', '_') AS prefix, concat(replace(concat(show, '-ep', episode_number, '-', date), ' ', '_'), '-', 3) AS id, CASE WHEN date = 'Unknown Date' THEN 0 ELSE CAST(replace(date, '-', '') AS INTEGER) END AS date_ts FROM ({FEED_SQL})")
def c6(spark, d):
    from .functions.text import chunk_id, date_number, id_prefix

    p = id_prefix(F.col("show"), F.col("episode_number"), F.col("date"))
    return FEED(spark, d).select(p.alias("prefix"), chunk_id(p, F.lit(3)).alias("id"), date_number(F.col("date")).alias("date_ts"))


ITEMS, ITEMS_SQL = adapter("orders", ["o_orderkey", "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS STRING) WHEN o_orderkey % 5 = 1 THEN '' ELSE NULL END AS itunes", "CASE o_orderkey % 4 WHEN 0 THEN concat('On air, Ep. ', o_orderkey) WHEN 1 THEN concat('ep', o_orderkey, ' again') WHEN 2 THEN concat('Episode ', o_orderkey) ELSE 'Step 9' END AS title", "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('guid-', o_orderkey) END AS guid", "CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END AS is_link"])


@query("c7_c8_feed_fields", f"SELECT o_orderkey, CASE WHEN coalesce(is_link, true) OR guid = '' THEN NULL ELSE guid END AS guid, coalesce(nullif(itunes, ''), nullif(regexp_extract(title, '\\b[Ee]p\\.?\\s*(\\d+)', 1), ''), 'Unknown') AS episode_number FROM ({ITEMS_SQL})")
def c7(spark, d):
    from .functions.text import feed_guid, feed_number

    return ITEMS(spark, d).select("o_orderkey", feed_guid(F.col("guid"), F.col("is_link")).alias("guid"), feed_number(F.col("itunes"), F.col("title")).alias("episode_number"))


@query("c12_rewritten_header", "SELECT conv_id, turn, md5(CASE WHEN turn % 3 = 0 THEN concat('# S - Episode 9', chr(13), chr(10), text) WHEN turn % 3 = 1 THEN concat('# S - Episode 9', chr(10), text) ELSE concat('# S - Episode 77', chr(10), text) END) AS text_md5 FROM conversations")
def c12(spark, d):
    from .functions.text import rewritten_header

    head = F.when(F.col("turn") % 3 == 0, "# S - Episode 7\r\n").when(F.col("turn") % 3 == 1, "# S - Episode 7\n").otherwise("# S - Episode 77\n")
    return table(spark, d, "conversations").select("conv_id", "turn", F.md5(rewritten_header(F.concat(head, "text"), F.lit("S"), F.lit("7"), F.lit("9"))).alias("text_md5"))


@query("c15_second_tier", "SELECT doc_id, lang = 'es' OR (lang = 'en' AND contains(lower(text), 'clown')) AS second_tier FROM documents")
def c15(spark, d):
    from .functions.text import routes_to_second_tier

    return table(spark, d, "documents").select("doc_id", routes_to_second_tier(F.col("lang"), F.col("text"), ["es"], {"en": ["clown"]}).alias("second_tier"))


HITS, HITS_SQL = adapter("lineitem", ["l_orderkey * 10 + l_linenumber AS id", "CASE WHEN l_suppkey % 4 = 0 THEN concat('P', l_suppkey % 7) WHEN l_suppkey % 9 = 0 THEN '' ELSE NULL END AS speaker_id", "CASE WHEN l_linenumber = 1 THEN 'UNKNOWN' WHEN l_linenumber = 2 THEN NULL ELSE concat('SPEAKER_0', l_linenumber) END AS speaker", "concat('[SPEAKER_0', 3 + l_orderkey % 2, '] ', 'words of ', l_orderkey) AS document"])
PEOPLE_NAMES = [(f"P{i}", f"Person {i}") for i in range(4)]
_SHOWN = "CASE WHEN coalesce(speaker_id, '') <> '' AND display IS NOT NULL THEN display WHEN coalesce(speaker_id, '') <> '' THEN concat('unidentified voice (', speaker_id, ')') WHEN coalesce(speaker, '') <> '' AND speaker <> 'UNKNOWN' THEN concat('unidentified voice (', speaker, ')') ELSE 'unidentified' END"


@query("c16_c17_display", f"WITH nm(sid, display) AS (VALUES {', '.join(map(repr, PEOPLE_NAMES))}) SELECT id, {_SHOWN} AS shown, CASE WHEN starts_with(document, concat('[', coalesce(nullif(speaker, ''), 'UNKNOWN'), '] ')) THEN substr(document, length(coalesce(nullif(speaker, ''), 'UNKNOWN')) + 4) ELSE document END AS text FROM ({HITS_SQL}) h LEFT JOIN nm ON nm.sid = h.speaker_id")
def c16(spark, d):
    from .functions.text import display_speaker, strip_speaker

    names = spark.createDataFrame(PEOPLE_NAMES, "speaker_id string, display string")
    df = HITS(spark, d).join(F.broadcast(names), "speaker_id", "left")
    return df.select("id", display_speaker(F.col("speaker_id"), F.col("display"), F.col("speaker")).alias("shown"), strip_speaker(F.col("document"), F.col("speaker")).alias("text"))


@query("c21_feed_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'Unknown Date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date FROM orders")
def c21(spark, d):
    from .functions.text import feed_date

    stamp = F.concat(F.lit("Tue, "), F.date_format("o_orderdate", "d MMM yyyy"), F.lit(" 23:30:00 -0700"))
    return table(spark, d, "orders").select("o_orderkey", feed_date(F.when(F.col("o_orderkey") % 9 == 0, "soon").otherwise(stamp)).alias("date"))


@query("c22_next_ingest", "SELECT event_id, strftime(CASE WHEN date_trunc('day', ts) + INTERVAL 9 HOUR <= ts THEN date_trunc('day', ts) + INTERVAL 33 HOUR ELSE date_trunc('day', ts) + INTERVAL 9 HOUR END, '%Y-%m-%d %H') AS due FROM events")
def c22(spark, d):
    from .functions.text import next_ingest

    return table(spark, d, "events").select("event_id", F.date_format(next_ingest(F.col("ts").cast("timestamp")), "yyyy-MM-dd HH").alias("due"))


@query("c26_clip_ids", "SELECT vec_id, concat('stem ', vec_id % 50) AS stem, concat('C', vec_id % 3) AS cluster, vec_id % 5 AS draw FROM embeddings WHERE vec_id % 4 <> 0")
def c26(spark, d):
    from .functions.text import clip_parts

    id_ = F.when(F.col("vec_id") % 4 == 0, "no clip").otherwise(F.concat(F.lit("stem "), F.col("vec_id") % 50, F.lit("--C"), F.col("vec_id") % 3, F.lit("--d"), F.col("vec_id") % 5))
    return table(spark, d, "embeddings").select("vec_id", clip_parts(id_).alias("p")).where("p is not null").select("vec_id", "p.*")


# ---- search ----

STORE, STORE_SQL = adapter("embeddings", ["vec_id AS id", "embedding", "concat('Show ', label % 3) AS show", "CAST(vec_id % 7 AS STRING) AS episode_number", "concat('Title ', vec_id % 7) AS episode_title", "CASE WHEN vec_id % 23 = 0 THEN 'Unknown Date' ELSE concat('2024-01-', lpad(CAST(1 + vec_id % 9 AS STRING), 2, '0')) END AS date", "CASE WHEN vec_id % 23 = 0 THEN 0 ELSE 20240101 + vec_id % 9 END AS date_ts", "concat('SPEAKER_0', vec_id % 3) AS speaker", "CASE WHEN vec_id % 2 = 0 THEN concat('P', label) ELSE NULL END AS speaker_id", "vec_id * 1.0 AS start_time", "concat('[SPEAKER_0', vec_id % 3, '] words of ', vec_id) AS document"])
PROBE = [round(((i * 37) % 101 - 50) / 400.0, 6) for i in range(64)]
_PROBE_SQL = "CAST([" + ", ".join(map(repr, PROBE)) + "] AS DOUBLE[])"
SIM_SQL = f"st AS ({STORE_SQL}), q AS (SELECT {_PROBE_SQL} AS q), dist AS (SELECT st.* EXCLUDE (embedding), 1 - list_dot_product(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), q) / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), list_transform(embedding, lambda x: CAST(x AS DOUBLE))))) AS distance FROM st CROSS JOIN q)"


def _found(where: str, n: int) -> str:
    return f"WITH {SIM_SQL}, h AS (SELECT *, row_number() OVER (ORDER BY distance, id) AS similarity_rank FROM dist WHERE {where}), t AS (SELECT * FROM h WHERE similarity_rank <= {n}), r AS (SELECT *, row_number() OVER (ORDER BY date DESC NULLS LAST, similarity_rank) AS position FROM t)"


_HIT = "id, show, date, speaker_id, CAST(similarity_rank AS BIGINT) AS similarity_rank, CAST(position AS BIGINT) AS position"


def _hits(df: DataFrame, *more: str) -> DataFrame:
    return df.select("id", "show", "date", "speaker_id", F.col("similarity_rank").cast("long").alias("similarity_rank"), F.col("position").cast("long").alias("position"), *more)


@query("s8_h1_h3_search", f"{_found('true', 10)} SELECT {_HIT}, round(1 - distance, 3) AS relevance_score FROM r")
def h1(spark, d):
    from .operators.search import search

    return _hits(search(STORE(spark, d), PROBE, 10), "relevance_score")


def indexed_store(spark: SparkSession, d: str):
    from .operators.index import build

    return build(STORE(spark, d))


@query("s8_indexed_search", f"{_found('true', 10)} SELECT {_HIT} FROM r")
def s8i(spark, d):
    """The same hits, through the index: what its first cells leave open is read too."""
    from .operators.index import indexed
    from .operators.search import hits_by_date

    return _hits(hits_by_date(indexed(indexed_store(spark, d), PROBE, 10, exact=True).drop("embedding")))


_MANY = f"""WITH st AS ({STORE_SQL}), u AS (SELECT id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM st), n AS (SELECT id, e, sqrt(list_dot_product(e, e)) AS n FROM u),
s AS (SELECT a.id AS query_id, b.id, round(list_dot_product(a.e, b.e) / (a.n * b.n), 9) AS s FROM n a JOIN n b ON a.id % 20 = 0),
k AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank, s FROM s)"""


def every_twentieth(spark: SparkSession, d: str) -> DataFrame:
    return STORE(spark, d).where("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))


@query("s8_nearest_many", f"{_MANY} SELECT query_id, rank, id, round(s, 6) AS similarity FROM k WHERE rank <= 10")
def s8m(spark, d):
    from .operators.index import nearest_many

    found = nearest_many(indexed_store(spark, d), every_twentieth(spark, d), 10, exact=True)
    return rounded(found.withColumn("rank", F.col("rank").cast("long")), "similarity", digits=6)


@query("s8_index_recall", f"{_MANY} SELECT count(*) AS hits, true AS reached FROM k WHERE rank <= 10")
def s8r(spark, d):
    """How many hits all queries have, and whether the index, with the probes that it chose, finds 0.99 of them."""
    from .operators.index import nearest_many, recall
    from .session import written

    index, asked = indexed_store(spark, d), every_twentieth(spark, d)
    exact = written(nearest_many(index, asked, 10, exact=True), "exact")
    reached = recall(nearest_many(index, asked, 10), exact) >= 0.99
    return exact.agg(F.count("*").alias("hits")).withColumn("reached", F.lit(reached))


_FILTERED = "show = 'Show 1' AND date_ts >= 20240102 AND date_ts <= 20240107 AND speaker_id = 'P4'"


@query("f1_search_filtered", f"{_found(_FILTERED, 10)} SELECT {_HIT}, round(1 - distance, 3) AS relevance_score FROM r")
def f1(spark, d):
    from .operators.search import search

    return _hits(search(STORE(spark, d), PROBE, 10, show="Show 1", after_date="2024-01-02", before_date="2024-01-07", speaker="P4"), "relevance_score")


@query("f1_before_unknown_date", f"WITH {SIM_SQL} SELECT count(*) AS records, CAST(count(*) FILTER (WHERE date = 'Unknown Date') AS BIGINT) AS unknown FROM dist WHERE date_ts <= 20240101")
def f1b(spark, d):
    from .operators.search import filters, where

    rows = STORE(spark, d).where(where(filters(before_date="2024-01-01")))
    return rows.agg(F.count("*").alias("records"), F.count_if(F.col("date") == "Unknown Date").alias("unknown"))


@query("f3_missing_values", f"WITH st AS ({STORE_SQL}) SELECT CAST(count(*) FILTER (WHERE speaker_id = 'P1') AS BIGINT) AS eq, CAST(count(*) FILTER (WHERE speaker_id IS DISTINCT FROM 'P1') AS BIGINT) AS ne FROM st")
def f3(spark, d):
    from .operators.search import where

    return STORE(spark, d).agg(F.count_if(where({"speaker_id": {"$eq": "P1"}})).alias("eq"), F.count_if(where({"speaker_id": {"$ne": "P1"}})).alias("ne"))


@query("h2_latest_on_topic", f"{_found('true', 5)} SELECT {_HIT} FROM r")
def h2(spark, d):
    from .operators.search import latest_on_topic

    return _hits(latest_on_topic(STORE(spark, d), PROBE, 5))


_LINE = f"concat('[', date, '] ', show, ' - Episode ', episode_number, ' (', episode_title, ') @ ', CAST(id AS VARCHAR), '.0s | speaker: ', CASE WHEN speaker_id IS NOT NULL AND display IS NOT NULL THEN display WHEN speaker_id IS NOT NULL THEN concat('unidentified voice (', speaker_id, ')') ELSE concat('unidentified voice (', speaker, ')') END, chr(10), substr(document, 14), chr(10))"


@query("c18_k17_rendered", f"{_found('true', 5)}, nm(sid, display) AS (VALUES {', '.join(map(repr, PEOPLE_NAMES))}) SELECT string_agg({_LINE}, concat(chr(10), '---', chr(10)) ORDER BY position) AS text FROM r LEFT JOIN nm ON nm.sid = r.speaker_id")
def k17(spark, d):
    from .operators.search import latest_on_topic, response

    return response(latest_on_topic(STORE(spark, d), PROBE, 5), spark.createDataFrame(PEOPLE_NAMES, "speaker_id string, display string"))


# ---- samples, logs, copies, counts ----


@query("h6_evenly_spaced", "WITH o AS (SELECT o_custkey % 20 AS stratum, o_orderkey, row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_custkey % 20) AS n FROM orders), t AS (SELECT unnest(range(37)) AS k) SELECT DISTINCT stratum, o_orderkey, i AS index FROM o JOIN t ON CAST(floor(k * (n / 37.0)) AS BIGINT) = i WHERE n > 37")
def h6(spark, d):
    from .operators.sampling import evenly_spaced

    rows = table(spark, d, "orders").select((F.col("o_custkey") % 20).alias("stratum"), "o_orderkey")
    return evenly_spaced(rows, ["o_orderkey"], 37, ["stratum"]).select("stratum", "o_orderkey", F.col("index").cast("long").alias("index"))


@query("h7_h10_newest", "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r <= 4")
def h7(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderkey"))
    return table(spark, d, "orders").withColumn("r", F.row_number().over(w)).where("r <= 4").select("o_custkey", "o_orderkey")


#: Place by place: who waits, in order; a free place ends the first one's wait.
_WALK = """WITH RECURSIVE pk AS (SELECT DISTINCT o_custkey % 50 AS stratum, o_orderkey % 200 AS index FROM orders), gn AS (SELECT DISTINCT l_orderkey % 50 AS stratum, l_partkey % 200 AS u FROM lineitem),
st AS (SELECT DISTINCT stratum FROM pk), pl AS (SELECT stratum, i, EXISTS (SELECT 1 FROM pk WHERE pk.stratum = st.stratum AND pk.index = i) AS picked, EXISTS (SELECT 1 FROM gn WHERE gn.stratum = st.stratum AND gn.u = i) AS gone FROM st CROSS JOIN (SELECT unnest(range(200)) AS i)),
walk AS (SELECT stratum, CAST(-1 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS waiting, CAST([] AS BIGINT[]) AS served, CAST([] AS BIGINT[]) AS places FROM st
  UNION ALL SELECT w.stratum, pl.i, CASE WHEN picked AND gone THEN list_append(waiting, pl.i) WHEN NOT picked AND NOT gone AND len(waiting) > 0 THEN waiting[2:] ELSE waiting END,
    CASE WHEN NOT picked AND NOT gone AND len(waiting) > 0 THEN list_append(served, waiting[1]) ELSE served END, CASE WHEN NOT picked AND NOT gone AND len(waiting) > 0 THEN list_append(places, pl.i) ELSE places END
  FROM walk w JOIN pl ON pl.stratum = w.stratum AND pl.i = w.i + 1),
sv AS (SELECT stratum, unnest(served) AS index, unnest(places) AS place FROM walk WHERE i = 199)
SELECT pk.stratum, pk.index, CASE WHEN pl.gone THEN sv.place ELSE pk.index END AS chosen FROM pk JOIN pl ON pl.stratum = pk.stratum AND pl.i = pk.index LEFT JOIN sv ON sv.stratum = pk.stratum AND sv.index = pk.index"""


@query("h8_substitutes", _WALK)
def h8(spark, d):
    from .operators.sampling import substitute_unavailable

    picks = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("stratum"), (F.col("o_orderkey") % 200).alias("index")).distinct()
    gone = table(spark, d, "lineitem").select((F.col("l_orderkey") % 50).alias("stratum"), (F.col("l_partkey") % 200).alias("u")).groupBy("stratum").agg(F.collect_set("u").alias("unavailable"))
    return substitute_unavailable(picks.join(gone, "stratum", "left").withColumn("count", F.lit(200)))


def _plan_inputs(spark: SparkSession, d: str) -> dict:
    name = F.concat(F.lit("e"), "episode", F.lit(".txt"))
    named = event_turns(spark, d).withColumns({"speaker": F.concat(F.lit("SPEAKER_"), "speaker"), "episode": name})
    date = F.concat(F.lit("2024-01-"), F.lpad((1 + F.col("episode") % 28).cast("string"), 2, "0"))
    shares = event_shares(spark, d).select(name.alias("episode"), "show", date.alias("date"), "year", F.concat(F.lit("SPEAKER_"), "dominant").alias("dominant"), (F.col("show") == "show2").alias("second_tier"))
    return {"turns": named, "episodes": shares, "unavailable": shares.where(F.xxhash64("episode") % 5 == 0).select("episode"), "seed": "campaign-1"}


@query("h9_clip_plan")
def h9(spark, d):
    from .operators.sampling import clip_plan

    return clip_plan(**_plan_inputs(spark, d))


@query("a43_plan_counts")
def a43(spark, d):
    from .operators.sampling import plan_counts

    return plan_counts(**_plan_inputs(spark, d))


LOG, LOG_SQL = adapter("lineitem", ["CAST(l_orderkey % 400 AS STRING) AS episode", "CAST(l_suppkey % 3 AS STRING) AS cluster", "l_linenumber % 3 AS draw", "10.0 AS length_s", "l_orderkey * 10000 + l_partkey AS seq", "CASE WHEN l_partkey % 31 = 0 THEN 'download' WHEN l_partkey % 7 = 0 THEN 'crop' ELSE NULL END AS error_kind"])
_LAST = f"lg AS (SELECT *, row_number() OVER (PARTITION BY episode, cluster, draw, length_s ORDER BY seq DESC, error_kind) AS r, min(seq) OVER (PARTITION BY episode, cluster, draw, length_s) AS first_seq FROM ({LOG_SQL})), ld AS (SELECT * FROM lg WHERE r = 1)"


@query("a20_w6_dedupe_records", f"WITH {_LAST} SELECT episode, cluster, draw, seq, first_seq FROM ld")
def a20(spark, d):
    from .plans.planning import dedupe_records

    return dedupe_records(LOG(spark, d)).select("episode", "cluster", "draw", "seq", "first_seq")


LOGS, LOGS_SQL = adapter("lineitem", ["CAST(l_orderkey % 400 AS STRING) AS episode", "CAST(l_suppkey % 3 AS STRING) AS cluster", "l_linenumber % 3 AS draw", "10.0 AS length_s", "max(l_orderkey * 10000 + l_partkey) AS seq", "CASE WHEN max(l_orderkey * 10000 + l_partkey) % 31 = 0 THEN 'download' ELSE NULL END AS error_kind"], "l_orderkey IS NOT NULL GROUP BY l_orderkey % 400, l_suppkey % 3, l_linenumber % 3")


@query("a21_p7_completed_episodes", f"WITH lx AS ({LOGS_SQL}) SELECT episode FROM lx GROUP BY episode HAVING count(*) = 9 AND count(*) FILTER (WHERE error_kind = 'download') = 0")
def a21(spark, d):
    from .plans.planning import completed_episodes

    nine = spark.range(9).select(F.col("id").alias("k"))
    plan = LOGS(spark, d).select("episode").distinct().crossJoin(F.broadcast(nine))  # nine rows
    return completed_episodes(LOGS(spark, d), plan)


@query("p7_h11_resume", f"WITH lx AS ({LOGS_SQL}), pl AS (SELECT * FROM (SELECT DISTINCT episode, cluster, draw FROM lx) ORDER BY episode, cluster, draw LIMIT 500) SELECT * FROM pl a WHERE NOT EXISTS (SELECT 1 FROM lx b WHERE b.error_kind = 'download' AND a.episode = b.episode AND a.cluster = b.cluster AND a.draw = b.draw)")
def p7(spark, d):
    from .plans.planning import resume

    rows = LOGS(spark, d)
    keys = ["episode", "cluster", "draw"]
    return resume(rows.select(*keys).distinct(), rows.where("error_kind = 'download'"), keys, 500)


CHECKS, CHECKS_SQL = adapter("orders", ["concat('Show ', o_orderkey % 3) AS show", "CASE o_orderkey % 7 WHEN 0 THEN 'ABSENT' WHEN 1 THEN 'DEAD' WHEN 2 THEN 'UNKNOWN' ELSE 'OK' END AS verdict"])


@query("a25_availability", f"WITH c AS ({CHECKS_SQL}) SELECT coalesce(show, 'TOTAL') AS show, count(*) AS total, " + ", ".join(f"CAST(count(*) FILTER (WHERE verdict = '{v}') AS BIGINT) AS {v.lower()}" for v in ("OK", "ABSENT", "DEAD", "UNKNOWN")) + " FROM c GROUP BY GROUPING SETS ((show), ())")
def a25(spark, d):
    from .operators.stats import availability

    return availability(CHECKS(spark, d))


@query("j11_j12_j26_urls", f"WITH {_BASE}, u AS (SELECT show, episode_number, date, arg_max(concat('http://x/', feed_pos), feed_pos) AS audio_url FROM feed WHERE feed_pos % 50 <> 0 GROUP BY show, episode_number, date) SELECT v.show, v.episode_number, v.date, audio_url FROM (SELECT * FROM vol WHERE EXISTS (SELECT 1 FROM feed b WHERE b.show = vol.show AND b.episode_number = vol.episode_number AND b.date = vol.date)) v LEFT JOIN u ON u.show = v.show AND u.episode_number = v.episode_number AND u.date = v.date")
def j11(spark, d):
    from .operators.sampling import resolved_urls

    f = FEED(spark, d).withColumn("audio_url", F.when(F.col("feed_pos") % 50 != 0, F.concat(F.lit("http://x/"), "feed_pos")))
    plan = VOLUME(spark, d).distinct().join(f, TRIPLE, "left_semi")
    return resolved_urls(plan, f)


_TYPES = ("click", "view", "error", "purchase", "signup")
_SCAN = f"""WITH {CENTROID_SQL}, {TURN_SQL}, lb AS (SELECT DISTINCT person, CAST(substr(person, 2) AS BIGINT) AS l FROM cent), k AS (SELECT CAST(floor(max(l) / {len(_TYPES)}) AS BIGINT) + 1 AS sets FROM lb),
rf AS (SELECT person, concat(CASE l % {len(_TYPES)} {" ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TYPES))} END, '-', CAST(floor(l / {len(_TYPES)}) AS BIGINT)) AS cluster FROM lb),
nm AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM dim GROUP BY vec_id), s AS (SELECT dim.vec_id, rf.cluster, sum(x * c) / max(n) AS s FROM dim JOIN cent ON cent.i = dim.i JOIN nm ON nm.vec_id = dim.vec_id JOIN rf ON rf.person = cent.person GROUP BY dim.vec_id, rf.cluster),
best AS (SELECT vec_id, cluster AS best FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cluster) AS r FROM s) WHERE r = 1),
ts AS (SELECT episode % 50 AS ep, row_number() OVER (PARTITION BY episode % 50 ORDER BY start, episode, turn_idx) AS i, start - min(start) OVER (PARTITION BY episode % 50) AS b, duration_s, concat(speaker, '-', turn_idx % sets) AS speaker FROM turn CROSS JOIN k),
pt AS (SELECT vec_id, vec_id % 50 AS ep, r, place, vec_id * 997.0 * r AS t, best FROM best CROSS JOIN (SELECT unnest([1.0, 0.75, 0.5, 0.3628, 0.3333]) AS r, unnest(range(5)) AS place)),
hd AS (SELECT vec_id, r, arg_min(speaker, i) AS heard FROM pt JOIN ts ON ts.ep = pt.ep AND b <= t AND t < b + duration_s GROUP BY vec_id, r),
hit AS (SELECT pt.r, pt.place, heard, best, heard IN (SELECT cluster FROM rf) AS known FROM pt LEFT JOIN hd ON hd.vec_id = pt.vec_id AND hd.r = pt.r),
agg AS (SELECT CAST(r AS DOUBLE) AS r, place, CAST(count(*) FILTER (WHERE known AND best = heard) AS BIGINT) AS hit, CAST(count(*) FILTER (WHERE known AND best <> heard) AS BIGINT) AS miss, CAST(count(*) FILTER (WHERE heard IS NULL) AS BIGINT) AS uncovered, CAST(count(*) FILTER (WHERE heard IS NOT NULL AND NOT known) AS BIGINT) AS no_reference FROM hit GROUP BY r, place),
acc AS (SELECT *, coalesce(hit / nullif(CAST(hit + miss AS DOUBLE), 0), 0.0) AS a FROM agg)
SELECT r, hit, miss, uncovered, no_reference, round(a, 6) AS accuracy, row_number() OVER (ORDER BY a DESC, place) = 1 AS peak FROM acc"""


@query("a32_offset_scan", _SCAN)
def a32(spark, d):
    from pyspark.sql import Window

    from .operators.evaluate import offset_scan

    types = _TYPES
    label = F.substring("person", 2, 20).cast("int")
    enrolled = people(spark, d)
    sets = enrolled.agg((F.floor(F.max(label) / len(types)) + 1).alias("sets"))
    # speakers are event types, dealt over as many sets as all people need, so that each has a speaker of their own
    turns = event_turns(spark, d).crossJoin(F.broadcast(sets)).withColumn("speaker", F.concat("speaker", F.lit("-"), F.col("turn_idx") % F.col("sets"))).withColumnRenamed("episode", "user").withColumn("episode", F.col("user") % 50)  # one row
    episode = Window.partitionBy("episode")
    turns = turns.withColumn("turn_idx", F.row_number().over(episode.orderBy("start", "user", "turn_idx"))).withColumn("start", F.col("start") - F.min("start").over(episode))
    refs = enrolled.withColumn("cluster", F.concat(F.element_at(F.array(*map(F.lit, types)), label % len(types) + 1), F.lit("-"), F.floor(label / len(types))))
    refs = refs.crossJoin(spark.range(50).select(F.col("id").alias("episode"))).select("episode", "cluster", "centroid")  # fifty episodes
    crops = vectors(spark, d).select(F.col("vec_id").alias("crop_id"), (F.col("vec_id") % 50).alias("episode"), (F.col("vec_id") * 997.0).alias("crop_start_s"), "vector")
    return rounded(offset_scan(crops, turns, refs, [1.0, 0.75, 0.5, 0.3628, 0.3333]), "accuracy", digits=6)


RATES, RATES_SQL = adapter("lineitem", ["l_orderkey AS episode", "CASE WHEN l_orderkey % 3 = 0 THEN 44100 WHEN l_suppkey % 4 = 0 THEN 48000 ELSE 44100 END AS rate"])


@query("a38_rate_histogram", f"WITH f AS ({RATES_SQL}), k AS (SELECT episode, count(DISTINCT rate) AS rates FROM f GROUP BY episode) SELECT CAST(rate AS INTEGER) AS rate, count(*) AS files, count(DISTINCT CASE WHEN rates = 1 THEN f.episode END) AS single_rate_episodes, round(16000.0 / rate, 6) AS implied_ratio FROM f JOIN k ON k.episode = f.episode GROUP BY rate")
def a38(spark, d):
    from .operators.stats import rate_histogram

    return rounded(rate_histogram(RATES(spark, d)), "implied_ratio", digits=6)


@query("a41_same_counts", "SELECT (SELECT count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem)) AS first, (SELECT count(*) FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS second, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem)) = (SELECT count(*) FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS agree")
def a41(spark, d):
    from .operators.stats import same_counts

    lines = table(spark, d, "lineitem").select("l_orderkey").distinct()
    return same_counts(lines, table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi"))


OLD, OLD_SQL = adapter("documents", ["concat('old ', doc_id) AS name", "lang AS date", "concat('# head ', doc_id, chr(13), chr(10), replace(text, chr(10), concat(chr(13), chr(10)))) AS text"], "doc_id % 3 <> 1")
NEW, NEW_SQL = adapter("documents", ["concat('new ', doc_id) AS name", "lang AS date", "concat('# other head', chr(10), text) AS text"], "doc_id % 5 <> 2")
REMAP_SQL = f"ol AS ({OLD_SQL}), nw AS ({NEW_SQL}), oh AS (SELECT name, date, md5(replace(substr(text, strpos(text, chr(10)) + 1), concat(chr(13), chr(10)), chr(10))) AS h FROM ol), nh AS (SELECT name AS new_name, date, md5(substr(text, strpos(text, chr(10)) + 1)) AS h FROM nw), rp AS (SELECT name, oh.date, count(new_name) AS n, max(new_name) AS new_name FROM oh LEFT JOIN nh ON nh.date = oh.date AND nh.h = oh.h GROUP BY name, oh.date), rv AS (SELECT name, date, CASE WHEN n = 1 THEN 'renamed' WHEN n = 0 THEN 'stale' ELSE 'problem' END AS verdict, CASE WHEN n = 1 THEN new_name END AS new_name FROM rp)"


@query("j10_classify_texts", f"WITH {REMAP_SQL} SELECT * FROM rv")
def j10(spark, d):
    from .operators.migrate import classify_texts

    return classify_texts(OLD(spark, d), NEW(spark, d))


@query("j25_k19_remapped_assignments", f"WITH {REMAP_SQL}, v AS (SELECT * FROM rv WHERE verdict <> 'problem') SELECT CASE WHEN verdict = 'renamed' THEN new_name ELSE v.name END AS episode, 'C' AS cluster FROM v WHERE verdict <> 'stale'")
def j25(spark, d):
    from .operators.migrate import classify_texts, remap_assignments

    v = classify_texts(OLD(spark, d), NEW(spark, d)).where("verdict != 'problem'")
    n = {r["verdict"]: r["n"] for r in v.groupBy("verdict").agg(F.count("*").alias("n")).collect()}  # two rows
    old = v.select(F.col("name").alias("episode"), F.lit("C").alias("cluster"))
    return remap_assignments(old, v, expect_renamed=n.get("renamed", 0), expect_dropped=n.get("stale", 0))


def _copies(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding"), F.concat(F.lit("doc "), "vec_id").alias("document"), F.create_map(F.lit("show"), F.concat(F.lit("s"), F.col("label")), F.lit("page"), F.col("vec_id").cast("string")).alias("metadata"))
    k = F.col("id")
    moved = F.when(k % 13 == 0, F.transform("embedding", lambda x: (x + F.lit(0.01)).cast("float"))).when(k % 17 == 0, F.lit(None)).otherwise(F.col("embedding"))
    meta = F.when(k % 7 == 0, F.map_concat("metadata", F.create_map(F.lit("extra"), F.lit("1")))).when(k % 11 == 0, F.map_filter("metadata", lambda a, b: a != "page")).when(k % 5 == 0, F.map_concat(F.map_filter("metadata", lambda a, b: a != "show"), F.create_map(F.lit("show"), F.lit("other")))).otherwise(F.col("metadata"))
    copy = v.where(k % 19 != 0).withColumns({"embedding": moved, "metadata": meta, "document": F.when(k % 23 == 0, F.lit("changed")).otherwise(F.col("document"))})
    return v, copy.unionByName(v.where(k == 0).withColumn("id", F.lit(-1).cast("long")))


@query(
    "j16_u8_t17_validate",
    """WITH k AS (SELECT vec_id AS id FROM embeddings) SELECT id, 'missing' AS problem, '' AS detail FROM k WHERE id % 19 = 0 UNION ALL SELECT -1, 'unexpected', '' UNION ALL SELECT id, 'document', '' FROM k WHERE id % 19 <> 0 AND id % 23 = 0
UNION ALL SELECT id, 'metadata_extra', 'extra' FROM k WHERE id % 19 <> 0 AND id % 7 = 0 UNION ALL SELECT id, 'metadata_missing', 'page' FROM k WHERE id % 19 <> 0 AND id % 7 <> 0 AND id % 11 = 0 UNION ALL SELECT id, 'metadata_changed', 'show' FROM k WHERE id % 19 <> 0 AND id % 7 <> 0 AND id % 11 <> 0 AND id % 5 = 0
UNION ALL SELECT id, 'embedding', '' FROM k WHERE id % 19 <> 0 AND id % 13 = 0 UNION ALL SELECT id, 'embedding_presence', '' FROM k WHERE id % 19 <> 0 AND id % 13 <> 0 AND id % 17 = 0""",
)
def j16(spark, d):
    from .operators.migrate import validate

    return validate(*_copies(spark, d))


@query("j17_j19_changed_vectors", "SELECT vec_id AS id, vec_id % 13 <> 0 AS same FROM embeddings WHERE vec_id % 19 <> 0 AND (vec_id % 13 = 0 OR vec_id % 17 <> 0)")
def j17(spark, d):
    from .operators.migrate import changed_vectors

    a, b = (x.select("id", F.col("embedding").alias("vector")) for x in _copies(spark, d))
    return changed_vectors(a, b.where("vector is not null and id >= 0"), ["id"])


@query("u6_common_keys", "SELECT count(*) AS shared FROM (SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer)")
def u6(spark, d):
    return table(spark, d, "orders").select("o_custkey").intersect(table(spark, d, "customer").select("c_custkey")).agg(F.count("*").alias("shared"))


@query("u7_differing_names", "SELECT n_name AS name, 'first' AS side FROM nation WHERE n_nationkey % 3 = 0 AND n_nationkey % 4 <> 0 UNION ALL SELECT n_name, 'second' FROM nation WHERE n_nationkey % 4 = 0 AND n_nationkey % 3 <> 0")
def u7(spark, d):
    from .operators.migrate import differing_names

    n = table(spark, d, "nation").withColumnRenamed("n_name", "name")
    return differing_names(n.where("n_nationkey % 3 = 0"), n.where("n_nationkey % 4 = 0"))


@query("u10_bag_union", f"WITH lx AS ({LOG_SQL}) SELECT episode, cluster, draw, seq, count(*) AS n FROM (SELECT * FROM lx UNION ALL SELECT * FROM lx WHERE draw = 1) GROUP BY episode, cluster, draw, seq")
def u10(spark, d):
    rows = LOG(spark, d)
    return rows.unionByName(rows.where("draw = 1")).groupBy("episode", "cluster", "draw", "seq").agg(F.count("*").alias("n"))


@query("k1_k2_merge_upsert", "SELECT id, coalesce(n.a, o.a) AS a, coalesce(o.b, -1) AS b, coalesce(n.c, -1) AS c FROM (SELECT o_orderkey AS id, o_orderstatus AS a, o_custkey AS b FROM orders WHERE o_orderkey % 2 = 0) o FULL OUTER JOIN (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'new' END AS a, o_custkey + 1 AS c FROM orders WHERE o_orderkey % 3 = 0) n USING (id)")
def k1(spark, d):
    from .sources.store import merged

    o = table(spark, d, "orders")
    old = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("a"), F.col("o_custkey").alias("b"))
    new = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 5 != 0, "new").alias("a"), (F.col("o_custkey") + 1).alias("c"))
    return merged(old, new).fillna(-1, ["b", "c"])


@query("k2_k3_gated_update", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS status FROM orders")
def k2(spark, d):
    from .plans.planning import gated
    from .sources.store import updated

    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    change = o.where("id % 10 = 0").select("id", F.lit("X").alias("status"))
    return updated(o, gated(change, change.count()))


@query("k15_ledger_merge", "SELECT concat('c', o_orderkey % 500) AS clip_id, CASE WHEN max(CASE WHEN o_orderkey % 500 < 200 THEN 1 ELSE 0 END) = 1 THEN 'later' ELSE 'first' END AS reason FROM orders GROUP BY o_orderkey % 500")
def k15(spark, d):
    from .operators.sampling import ledger_merge

    ids = table(spark, d, "orders").select((F.col("o_orderkey") % 500).alias("k")).distinct()
    of = lambda df, reason: df.select(F.concat(F.lit("c"), "k").alias("clip_id"), F.lit(reason).alias("reason"))
    return ledger_merge(of(ids, "first"), of(ids.where("k < 200"), "later"))


@query("f2_f13_selectors", f"WITH {_BASE} SELECT id, pos FROM rec WHERE (show = 'Show 1' AND date = '2024-03-03') OR (episode_guid = 'g37' AND show = 'Show 1') OR starts_with(id, 'Show_2-ep11')")
def f2(spark, d):
    from .operators.search import where

    tree = {"$or": [{"$and": [{"show": {"$eq": "Show 1"}}, {"date": {"$eq": "2024-03-03"}}]}, {"$and": [{"episode_guid": {"$eq": "g37"}}, {"show": {"$eq": "Show 1"}}]}]}
    return RECORDS(spark, d).where(where(tree) | F.col("id").startswith("Show_2-ep11")).select("id", "pos")


@query("f6_f7_f11_f12_usable", "SELECT user_id AS episode, CAST(count(*) FILTER (WHERE value < 1) AS BIGINT) AS dropped, count(*) AS segments FROM events GROUP BY user_id")
def f6(spark, d):
    from .operators.identity import dropped_segments

    rows = table(spark, d, "events").select(F.col("user_id").alias("episode"), F.when(F.col("value") >= 1, F.col("value").cast("string")).otherwise("soon").try_cast("double").alias("start"))
    return dropped_segments(rows)


@query("p4_verified", f"WITH {PLAN_SQL} SELECT {_K} FROM plan WHERE action = 'IDENTIFY_ONLY' AND feed_pos % 3 = 0")
def p4(spark, d):
    from .plans.planning import verified

    p = planned(spark, d)
    return verified(p, p.withColumn("action", F.when(F.col("feed_pos") % 3 == 0, F.col("action")).otherwise("SKIP")))


@query("c23_distance_space", "SELECT 'cosine' AS space")
def c23(spark, d):
    from .sources.store import distance_space

    return spark.createDataFrame([(distance_space({"collection_metadata": {"space": "cosine"}}),)], "space string")
