"""What each episode needs, and how much of it is done now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.reconcile import KEY, completeness, episodes_of, is_complete

ACTIONS = ("EXCLUDE", "TRANSCRIBE", "UNPARSEABLE", "EMBED_ONLY", "IDENTIFY_ONLY", "SKIP")


class Refused(RuntimeError):
    """A gate that didn't open; nothing was written."""


def decide(*, excluded: Column, exists: Column, parses: Column, complete: Column, rules: Column, identity: Column, current_rules: str, current_identity: str) -> Column:
    """The action, by the first rule that holds. A version that is null is never current."""
    return (
        F.when(excluded, "EXCLUDE")
        .when(~exists, "TRANSCRIBE")
        .when(~parses, "UNPARSEABLE")
        .when(~complete, "EMBED_ONLY")
        .when(~rules.eqNullSafe(F.lit(current_rules)), "EMBED_ONLY")
        .when(~identity.eqNullSafe(F.lit(current_identity)), "IDENTIFY_ONLY")
        .otherwise("SKIP")
    )


def episode_state(records: DataFrame) -> DataFrame:
    """What the store knows of each episode: counts over its ids, and the versions of its last record by id, sound where is_uniform."""
    rows = episodes_of(records)
    last = lambda c: F.max_by(c, "id").alias(c)
    stamps = rows.groupBy(*KEY).agg(last("rules_version"), last("identity_version"))
    return completeness(rows).join(stamps, KEY)


def plan_show(feed: DataFrame, expected: DataFrame, state: DataFrame, exclusions: DataFrame, *, current_rules: str, current_identity: str) -> DataFrame:
    """feed (show, feed_pos, episode_number, date, guid) with the action of each episode. expected: n_expected chunks by transcript, which alone tells what is complete; state: episode_state(). All shows are planned at once; joins share the partitioning by episode, exclusions are matched by two equi joins."""
    triple = exclusions.select(*KEY, F.lit(True).alias("by_triple")).distinct()
    guid = exclusions.where("guid is not null").select("show", "guid", F.lit(True).alias("by_guid")).distinct()
    df = feed.join(expected.select(*KEY, "n_expected"), KEY, "left").join(state, KEY, "left").join(triple, KEY, "left").join(guid, ["show", "guid"], "left")
    out = F.coalesce("by_triple", F.lit(False)) | F.coalesce("by_guid", F.lit(False))
    n = F.col("n_expected")
    action = decide(excluded=out, exists=n.isNotNull(), parses=n > 0, complete=is_complete(n), rules=F.col("rules_version"), identity=F.col("identity_version"), current_rules=current_rules, current_identity=current_identity)
    return df.select(*feed.columns, action.alias("action"))


def cap_work(planned: DataFrame, cap: int, by: str = "show") -> DataFrame:
    """The first `cap` rows in feed order; none for a cap of 0 or less. left_over: what stays for later."""
    w = Window.partitionBy(by)
    df = planned.withColumn("no_", F.row_number().over(w.orderBy("feed_pos"))).withColumn("left_over", F.greatest(F.count("*").over(w) - max(cap, 0), F.lit(0)))
    return df.where(F.col("no_") <= max(cap, 0)).drop("no_")


def guard(planned: DataFrame, threshold: int = 10, by: str = "show") -> DataFrame:
    """planned with n and refused: all of a show's rows or none, for more than `threshold` at once speak of a feed that changed shape."""
    w = Window.partitionBy(by)
    return planned.withColumn("n", F.count("*").over(w)).withColumn("refused", F.col("n") > threshold)


def require_expected(n: int, expect: int) -> None:
    """Opens only if the caller foretold the count; -1 means that nothing was foretold, 0 is a count like any other."""
    if expect < 0:
        raise Refused(f"{n} changes are planned; say so to apply them")
    if expect != n:
        raise Refused(f"{n} changes are planned, {expect} were foretold")


def gated(df: DataFrame, expect: int) -> DataFrame:
    """df, once its count is as foretold."""
    require_expected(df.count(), expect)
    return df


def verified(planned: DataFrame, replanned: DataFrame, action: str = "IDENTIFY_ONLY") -> DataFrame:
    """Repaired episodes that, planned anew, still need the action: each is a failure."""
    return planned.where(F.col("action") == action).select(*KEY).join(replanned.where(F.col("action") == action), KEY, "left_semi")


def resume(plan: DataFrame, done: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """What of a plan is left after what is done; a limit counts rows of the plan, before."""
    first = plan.orderBy(*keys).limit(limit) if limit is not None else plan
    return first.join(done.select(*keys).distinct(), keys, "left_anti")


def dedupe_records(log: DataFrame, keys: tuple[str, ...] = ("episode", "cluster", "draw", "length_s")) -> DataFrame:
    """The last record of each key by seq; first_seq tells where the key first stood."""
    w = Window.partitionBy(*keys)
    ranked = log.withColumn("no_", F.row_number().over(w.orderBy(F.desc("seq")))).withColumn("first_seq", F.min("seq").over(w))
    return ranked.where("no_ = 1").drop("no_")


def completed_episodes(log: DataFrame, plan: DataFrame) -> DataFrame:
    """Episodes whose deduped records are as many as planned, with no failed download among them; failed crops don't matter."""
    have = dedupe_records(log).groupBy("episode").agg(F.count("*").alias("have"), F.bool_or(F.coalesce(F.col("error_kind") == "download", F.lit(False))).alias("failed"))
    want = plan.groupBy("episode").agg(F.count("*").alias("want"))
    return have.join(want, "episode").where("have = want and not failed").select("episode")
