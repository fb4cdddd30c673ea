"""Whole jobs, put together from operators: re-embedding a show, books, renumbering, identification, gated stamps."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import id_prefix, segments
from ..operators import chunking, identity, migrate, turns
from ..operators.reconcile import KEY, episodes_of, is_complete
from ..sources import readers, store
from ..session import drop_written, written
from ..streaming.ingest import RULES_VERSION, records_of
from .planning import Refused, cap_work, episode_state, guard, plan_show, require_expected

IDENTITY_VERSION = "1@1"


def expected_of(texts: DataFrame) -> DataFrame:
    """(show, episode_number, date, n_expected) of transcripts: 0 for those that give no chunks."""
    named = texts.where("show != ''")
    n = chunking.expected_chunks(segments(named.select(*KEY, "text")), tuple(KEY))
    return named.select(*KEY).distinct().join(n, KEY, "left").select(*KEY, F.coalesce("n_chunks", F.lit(0)).cast("int").alias("n_expected"))


def plan_all(feed: DataFrame, texts: DataFrame, records: DataFrame, exclusions: DataFrame, *, threshold: int = 10, cap: int = 0) -> dict[str, DataFrame]:
    """A night's work for all shows at once: plan (every feed entry with its action), transcribe (all of a show's or, beyond the threshold, none), embed, identify (the first `cap` of each show), refused (shows whose transcribing was refused)."""
    plan = plan_show(feed, expected_of(texts), episode_state(records), exclusions, current_rules=RULES_VERSION, current_identity=IDENTITY_VERSION)
    of = lambda action: plan.where(F.col("action") == action)
    guarded = guard(of("TRANSCRIBE"), threshold)
    return {"plan": plan, "transcribe": guarded.where("not refused").drop("n", "refused"), "embed": of("EMBED_ONLY"), "identify": cap_work(of("IDENTIFY_ONLY"), cap), "refused": guarded.where("refused").select("show", "n").distinct()}


def bulk_embed(spark: SparkSession, folder: str, show: str, collection: store.Collection, encode: Callable[[pd.Series], pd.Series]) -> dict:
    """Chunks and vectors for all of a show's transcripts that the store doesn't hold whole and under the current rules. Names that stored records carry for their clusters go over to the new ones, where no two contradict each other."""
    texts = readers.transcripts(spark, folder, show).withColumn("at", F.lit(0))
    current = collection.read() if collection.exists() else None
    if current is not None:
        state = expected_of(texts).join(episode_state(current), KEY).where(is_complete(F.col("n_expected")) & F.col("rules_version").eqNullSafe(F.lit(RULES_VERSION)))
        texts = texts.join(state.select(*KEY), KEY, "left_anti")
    fresh = records_of(texts.select("name", "text", "at"), encode)
    if current is not None:
        fresh = identity.carry(current, fresh, IDENTITY_VERSION, KEY)
    return store.upsert_then_prune(collection, fresh)


def upload_book(collection: store.Collection, pages: DataFrame, encode: Callable[[pd.Series], pd.Series], *, title: str, author: str, date: str) -> int:
    """A book's pages (page, text) as records of their own kind, merged in; episodes never prune them."""
    made = chunking.book_chunks(pages.withColumn("book", F.lit(title)))
    name = title.replace(" ", "_")
    number = int(date.replace("-", "")) if date[:4].isdigit() else 0
    rows = made.select(F.concat(F.lit(f"{name}-p"), "page", F.lit("-"), "chunk_index").alias("id"), F.col("text").alias("document"), F.lit("book").alias("source"), F.lit(title).alias("title"), F.lit(author).alias("author"), F.lit(date).alias("date"), F.lit(number).alias("date_ts"), F.col("page").cast("int").alias("page"), F.lit(title).alias("show"), F.lit("N/A").alias("episode_number"), F.lit(title).alias("episode_title"), F.lit(author).alias("speaker"), F.col("page").cast("double").alias("start_time"))
    rows = readers.with_model(rows, encode, "document", "embedding")
    rows = written(rows, "book")
    collection.merge(rows)
    n = rows.count()
    drop_written(rows)
    return n


def identify_clusters(segs: DataFrame, audio: DataFrame, embed: Callable, people: DataFrame, *, threshold: float, margin: float, cap: float = turns.GAP_CAP_S) -> DataFrame:
    """(episode, speaker, person) of the clusters that a voice was recognised for. segs: episode, seq, speaker, start, text; audio: episode, audio_path."""
    merged = turns.merge_turns(identity.usable_segments(segs), cap)
    crops = readers.embedded_crops(turns.crop_plan(merged).join(audio, "episode"), embed)
    named = identity.assign_vectors(identity.cluster_centroids(crops), people, ["episode", "cluster"], threshold, margin, "centroid")
    return named.where("person is not null").select("episode", F.col("cluster").alias("speaker"), "person")


def apply_renumber(collection: store.Collection, verdicts: DataFrame, orphans: DataFrame, *, expect_renames: int, expect_orphans: int) -> int:
    """Re-keys the records of episodes that the feed renumbered, once both counts are as foretold and nothing is unresolved; then reads back: as many records as before, none under an old number."""
    unresolved = verdicts.where("verdict not in ('rename', 'new')").count()
    if unresolved:
        raise Refused(f"{unresolved} entries are unresolved")
    renames = verdicts.where("verdict = 'rename'").select("show", "date", F.col("old_number").alias("episode_number"), F.col("episode_number").alias("to_"))
    n = renames.count()
    require_expected(n, expect_renames)
    require_expected(orphans.count(), expect_orphans)
    before = collection.read()
    mine = episodes_of(before).join(renames, KEY)
    moved = migrate.rekey(mine.withColumn("old_", F.col("episode_number")), F.col("to_"), F.col("old_")).select(*before.columns)
    total = before.count()
    moved, gone = written(moved, "moved"), written(mine.select("id"), "gone")
    collection.merge(moved, gone)
    after = collection.read()
    drop_written(moved)
    drop_written(gone)
    if after.count() != total or not episodes_of(after).join(renames, KEY, "left_semi").isEmpty():
        raise Refused("records don't read back as planned")
    return n


def backfill(collection: store.Collection, assignments: DataFrame, expect: int) -> DataFrame:
    """Names onto the records of assigned clusters, then (person, records) read back, with a control that must find nobody."""
    store.apply_updates(collection, identity.backfill_updates(assignments, collection.read()), expect)
    after = collection.read()
    if after.where("speaker_id = '\x00nobody'").count():
        raise Refused("the control found records")
    return after.where("coalesce(speaker_id, '') != ''").groupBy(F.col("speaker_id").alias("person")).agg(F.count("*").alias("records"))


def nightly(shows: list[str], run: Callable[[str], dict], *, at_once: int = 4) -> dict[str, dict]:
    """run(show) for each show, up to at_once side by side, whatever becomes of the others; what each gave. Shows that failed are told, with their errors, once all have had their turn.

    Each show's jobs go to a scheduler pool of its own name, and its thread has the session's properties; so where spark.scheduler.mode is FAIR, a show with much to do takes no other's share. Shows that write to one collection wait for each other there (Collection's wait_s), and nowhere else.
    """
    spark, done, failed = SparkSession.active(), {}, {}

    def turn(show: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", show)
        try:
            done[show] = run(show)
        except Exception as e:  # noqa: BLE001  a show's failure is its own
            failed[show] = e
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        # each turn inherits the caller's local properties, and leaves none behind for the next on its thread
        for each in [pool.submit(inheritable_thread_target(spark)(turn), show) for show in shows]:
            each.result()
    if failed:
        told = [s for s in shows if s in failed]
        raise ExceptionGroup(f"{len(told)} of {len(shows)} shows failed: {', '.join(sorted(told))}", [failed[s] for s in told])
    return {s: done[s] for s in shows}


def run_show(spark: SparkSession, show: str, folder: str, feed: DataFrame, collection: store.Collection, exclusions: DataFrame, encode: Callable[[pd.Series], pd.Series], *, threshold: int = 10, cap: int = 0) -> dict:
    """A show's night: its plan, refused as a whole if too many episodes wait for a transcript; then all that needs no model but the encoder is embedded. Returns the counts of the plan's actions and what was written."""
    plan = plan_all(feed.where(F.col("show") == show), readers.transcripts(spark, folder, show), collection.read() if collection.exists() else _no_records(spark), exclusions, threshold=threshold, cap=cap)
    refused = plan["refused"].first()
    if refused:
        raise Refused(f"{refused['n']} episodes of {show} wait for a transcript")
    counts = {r["action"]: r["n"] for r in plan["plan"].groupBy("action").agg(F.count("*").alias("n")).collect()}  # six actions
    return counts | bulk_embed(spark, folder, show, collection, encode)


def _no_records(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "id string, show string, episode_number string, date string, n_chunks int, source string, episode_guid string, rules_version string, identity_version string, speaker string, speaker_id string")


def stamp(collection: store.Collection, assignments: DataFrame, expect: int) -> tuple[int, int]:
    """The identity version onto all records of assigned episodes; returns how many carry it and how many there are, read back."""
    store.apply_updates(collection, identity.stamp_set(assignments, collection.read(), IDENTITY_VERSION), expect)
    r = episodes_of(collection.read()).agg(F.count_if(F.col("identity_version") == IDENTITY_VERSION).alias("a"), F.count("*").alias("b")).first()
    return r["a"], r["b"]


def old_prefixes(verdicts: DataFrame) -> DataFrame:
    """Id prefixes that renames leave behind."""
    return verdicts.where("verdict = 'rename'").select(id_prefix(F.col("show"), F.col("old_number"), F.col("date")).alias("prefix"))
