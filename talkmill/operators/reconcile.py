"""Volume, store and feed held against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import id_index, is_non_episode

KEY = ["show", "episode_number", "date"]
#: Classes that are no fault.
INFORMATIVE = ("feed_unreachable",)


def episodes_of(records: DataFrame) -> DataFrame:
    return records.where(~is_non_episode(F.col("source")))


def excluded_keys(df: DataFrame, exclusions: DataFrame, guid: str | None = "episode_guid") -> DataFrame:
    """Rows of df that are excluded: by show, number and date, or by guid within a show. Two equi joins, so that neither is a nested loop."""
    by_triple = df.join(exclusions.select(*KEY), KEY, "left_semi")
    if guid is None:
        return by_triple
    by_guid = df.join(exclusions.where("guid is not null").select("show", F.col("guid").alias(guid)), ["show", guid], "left_semi")
    return by_triple.unionByName(by_guid).distinct()


def not_excluded(df: DataFrame, exclusions: DataFrame, guid: str | None = "episode_guid") -> DataFrame:
    out = df.join(exclusions.select(*KEY), KEY, "left_anti")
    if guid is None:
        return out
    return out.join(exclusions.where("guid is not null").select("show", F.col("guid").alias(guid)), ["show", guid], "left_anti")


def completeness(records: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """By episode, over its ids: all, those with an index, distinct indices, least and largest index, and whether records agree on n_chunks and versions."""
    index = id_index(F.col("id"))
    return records.select(*keys, "id", index.alias("i"), "n_chunks").groupBy(*keys).agg(F.count("*").alias("ids"), F.count("i").alias("indexed"), F.countDistinct("i").alias("distinct_i"), F.min("i").alias("lo"), F.max("i").alias("hi"), F.max_by("n_chunks", F.when(F.col("n_chunks").isNotNull(), F.col("id"))).alias("stored_n"), (F.countDistinct("n_chunks") <= 1).alias("is_uniform"))


def is_complete(expected: Column) -> Column:
    """Over completeness(): all ids are indexed and their set is 0 .. expected - 1. No expectation is never complete; none stored and none expected is."""
    whole = (F.col("ids") == F.col("indexed")) & (F.col("distinct_i") == expected) & (F.col("lo") == 0) & (F.col("hi") == expected - 1)
    return F.coalesce(F.when(expected == 0, F.coalesce("ids", F.lit(0)) == 0).otherwise(whole), F.lit(False))


def shared_prefixes(records: DataFrame) -> DataFrame:
    """Id prefixes that more than one episode uses."""
    prefix = F.regexp_replace("id", "-[0-9]+$", "")
    return episodes_of(records).where(id_index(F.col("id")).isNotNull()).groupBy(prefix.alias("prefix")).agg(F.countDistinct(*KEY).alias("episodes")).where("episodes > 1")


def incomplete(records: DataFrame, pos: str = "id") -> DataFrame:
    """Episodes whose count of ids isn't the n_chunks that their last record to state one gives; those that state none are exempt."""
    n = F.max_by("n_chunks", F.when(F.col("n_chunks").isNotNull(), F.col(pos)))
    return episodes_of(records).groupBy(*KEY).agg(F.count("*").alias("ids"), n.alias("n_chunks")).where("n_chunks is not null and ids != n_chunks")


def non_contiguous(records: DataFrame) -> DataFrame:
    """Episodes whose indices, as a list, aren't 0 .. n - 1: gaps and repeats are faults, no indices at all are none."""
    rows = episodes_of(records).select(*KEY, id_index(F.col("id")).alias("i")).where("i is not null")
    return rows.groupBy(*KEY).agg(F.count("*").alias("n"), F.countDistinct("i").alias("d"), F.min("i").alias("lo"), F.max("i").alias("hi")).where("lo != 0 or hi != n - 1 or d != n").select(*KEY)


def report(volume: DataFrame, records: DataFrame, feed: DataFrame, exclusions: DataFrame) -> DataFrame:
    """(fault_class, show, episode_number, date, prefix), one row per finding; a clean corpus has rows of INFORMATIVE classes at most.

    Records are summed up once by episode; these sums, the volume, the feed and the exclusions meet by episode, where each row tells which classes it falls into. Only guids and prefixes, which cross episodes, take a look of their own at the records.
    """
    rows = episodes_of(records)
    i = id_index(F.col("id"))
    last_n = F.max_by("n_chunks", F.when(F.col("n_chunks").isNotNull(), F.col("id")))
    per = rows.groupBy(*KEY).agg(F.count("*").alias("ids"), last_n.alias("n_chunks"), F.count(i).alias("n"), F.countDistinct(i).alias("d"), F.min(i).alias("lo"), F.max(i).alias("hi")).withColumn("stored", F.lit(True))
    flag = lambda df, name: df.select(*KEY, F.lit(True).alias(name)).distinct()
    by_guid = rows.select(*KEY, "episode_guid").join(exclusions.where("guid is not null").select("show", F.col("guid").alias("episode_guid")), ["show", "episode_guid"], "left_semi")
    df = per.join(flag(volume, "held"), KEY, "full_outer").join(flag(feed, "fed"), KEY, "left").join(flag(exclusions, "named"), KEY, "left").join(flag(by_guid, "by_guid"), KEY, "left")
    df = df.fillna(False, ["stored", "held", "fed", "named", "by_guid"])
    stored, out = F.col("stored"), F.col("stored") & (F.col("named") | F.col("by_guid"))
    tests = {
        "missing": F.col("held") & ~stored & ~F.col("named"),
        "extra": stored & ~F.col("held") & ~out,
        "excluded_with_records": out,
        "feed_unreachable": F.col("held") & ~F.col("fed"),
        "incomplete": F.col("n_chunks").isNotNull() & (F.col("ids") != F.col("n_chunks")),
        "non_contiguous": (F.col("n") > 0) & ((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1) | (F.col("d") != F.col("n"))),
    }
    found = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in tests.items())))
    none = F.lit(None).cast("string")
    out = df.select(F.explode(found).alias("fault_class"), *KEY, none.alias("prefix"))
    return out.unionByName(shared_prefixes(records).select(F.lit("shared_prefixes").alias("fault_class"), *(none.alias(k) for k in KEY), "prefix"))


def is_clean(findings: DataFrame) -> DataFrame:
    """One row: faults, findings that are none, and whether there are no faults."""
    fault = ~F.col("fault_class").isin(list(INFORMATIVE))
    return findings.agg(F.count_if(fault).alias("faults"), F.count_if(~fault).alias("informative"), (F.count_if(fault) == 0).alias("is_clean"))


def multiset_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Values that stand in a and b in different numbers."""
    x, y = a.groupBy(key).agg(F.count("*").alias("in_first")), b.groupBy(key).agg(F.count("*").alias("in_second"))
    both = x.join(y, key, "full_outer").select(key, F.coalesce("in_first", F.lit(0)).alias("in_first"), F.coalesce("in_second", F.lit(0)).alias("in_second"))
    return both.where("in_first != in_second")


def stale_ids(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.select("id").distinct().join(new.select("id"), "id", "left_anti")


def prune_set(records: DataFrame, written: DataFrame) -> DataFrame:
    """Ids to remove after episodes were written (written: show, episode_number, date, episode_guid, id): all that their triple matches or, within the show, their guid, but what was written and what is no episode."""
    rows = episodes_of(records)
    by_triple = rows.join(written.select(*KEY).distinct(), KEY, "left_semi").select("id")
    by_guid = rows.join(written.where("coalesce(episode_guid, '') != ''").select("show", "episode_guid").distinct(), ["show", "episode_guid"], "left_semi").select("id")
    return stale_ids(by_triple.union(by_guid), written)


def backlog(volume: DataFrame, feed: DataFrame, exclusions: DataFrame, stamped: DataFrame) -> DataFrame:
    """By show (and ALL): transcripts reachable by the feed, not excluded and without an identity stamp."""
    reachable = not_excluded(volume.select(*KEY).distinct().join(feed.select(*KEY).distinct(), KEY, "left_semi"), exclusions, None)
    owed = reachable.join(stamped.select(*KEY).distinct(), KEY, "left_anti")
    a = reachable.rollup("show").agg(F.count("*").alias("reachable"))
    b = owed.rollup("show").agg(F.count("*").alias("owed"))
    out = a.join(b, a["show"].eqNullSafe(b["show"]), "left").select(F.coalesce(a["show"], F.lit("ALL")).alias("show"), "reachable", F.coalesce("owed", F.lit(0)).alias("owed"))
    return out.where("reachable > 0")
