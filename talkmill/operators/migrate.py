"""Collections copied, re-keyed and validated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CHUNK_ID, chunk_id, id_index, id_prefix, is_non_episode
from ..functions.vectors import all_close
from ..plans.planning import require_expected
from .reconcile import KEY, not_excluded


def remap_ids(records: DataFrame) -> DataFrame:
    """records with new_id and classification: ids by show and number become ids by show, number and date.

    passthrough_non_episode: no episode, or an id that isn't prefix-index; passthrough_unmatched: a missing show, number or date, or a prefix that is neither the old nor the new one; remapped: all else, those that have their new id already included.
    """
    prefix, index = F.regexp_extract("id", CHUNK_ID, 1), F.regexp_extract("id", CHUNK_ID, 2).try_cast("long")
    missing: Column = F.lit(False)
    for k in KEY:
        missing = missing | (F.coalesce(F.col(k), F.lit("")) == "")
    old = F.replace(F.concat(F.col("show"), F.lit("-ep"), F.col("episode_number")), F.lit(" "), F.lit("_"))
    new = id_prefix(F.col("show"), F.col("episode_number"), F.col("date"))
    kind = F.when(is_non_episode(F.col("source")) | ~F.col("id").rlike(CHUNK_ID), "passthrough_non_episode").when(missing, "passthrough_unmatched").when((prefix == new) | (prefix == old), "remapped").otherwise("passthrough_unmatched")
    return records.withColumn("classification", kind).withColumn("new_id", F.when((kind == "remapped") & (prefix == old) & (prefix != new), chunk_id(new, index)).otherwise(F.col("id")))


def classification_counts(remapped: DataFrame, samples: int = 5) -> DataFrame:
    """By classification: records, and up to `samples` ids, the least ones."""
    counts = remapped.groupBy("classification").agg(F.count("*").alias("records"))
    first = remapped.select("classification", "id").withColumn("no_", F.row_number().over(Window.partitionBy("classification").orderBy("id"))).where(F.col("no_") <= samples)  # those that partitions keep meet
    sample = first.groupBy("classification").agg(F.array_sort(F.collect_list("id")).alias("sample"))
    return counts.join(sample.withColumnRenamed("classification", "c_"), F.col("classification").eqNullSafe(F.col("c_")), "left").select("classification", "records", F.coalesce("sample", F.array().cast("array<string>")).alias("sample"))


def episode_facts(expected: DataFrame, guids: DataFrame, rules_version: str = "1") -> DataFrame:
    """What is stamped on each record of an episode: n_chunks (from the transcript), rules_version, and the feed's guid where it has one."""
    return expected.select(*KEY, F.col("n_expected").alias("n_chunks"), F.lit(rules_version).alias("rules_version")).join(guids.select(*KEY, F.col("guid").alias("episode_guid")), KEY, "left")


def enriched(records: DataFrame, facts: DataFrame) -> DataFrame:
    """records with their episode's facts, which win over what they carried."""
    new = [c for c in facts.columns if c not in KEY]
    df = records.join(facts.select(*KEY, *(F.col(c).alias(f"{c}_f") for c in new)), KEY, "left")
    return df.select(*(F.coalesce(f"{c}_f", c).alias(c) if c in new else c for c in records.columns), *(F.col(f"{c}_f").alias(c) for c in new if c not in records.columns))


def re_id(records: DataFrame, facts: DataFrame) -> DataFrame:
    """The copy of a collection under new ids, with facts; vectors and documents as they are."""
    return enriched(remap_ids(records), facts).withColumn("id", F.col("new_id")).drop("new_id", "classification")


def rekey(records: DataFrame, new_number: Column, old_number: Column) -> DataFrame:
    """Records of episodes that get a new number: the same index under the new prefix. Raises, while it runs, on an id outside the old prefix, one without an index, and metadata that name another number."""
    old = id_prefix(F.col("show"), old_number, F.col("date"))
    fits = F.col("id").rlike(CHUNK_ID) & (F.regexp_extract("id", CHUNK_ID, 1) == old) & (F.col("episode_number") == old_number)
    id_ = F.when(fits, chunk_id(id_prefix(F.col("show"), new_number, F.col("date")), id_index(F.col("id")))).otherwise(F.raise_error(F.concat(F.lit("can't re-key "), F.col("id"))))
    return records.withColumns({"id": id_, "episode_number": new_number})


def renumber_verdicts(feed: DataFrame, volume: DataFrame, stored: DataFrame, exclusions: DataFrame) -> DataFrame:
    """feed (show, episode_number, date, guid) entries without a transcript, but excluded ones: verdict and old_number. stored: (show, episode_number, date, guid) of records.

    no_guid; new (no record has the guid under another number or date); several (more than one does); date_moved; no_file (of the old triple); still_in_feed; rename.
    """
    entries = not_excluded(feed.join(volume.select(*KEY).distinct(), KEY, "left_anti"), exclusions, "guid")
    others = stored.where("guid is not null").select("show", "guid", F.col("episode_number").alias("o_n"), F.col("date").alias("o_d")).distinct()
    some = entries.join(others, ["show", "guid"], "left").where("o_n is null or not (o_n = episode_number and o_d = date)")
    gone = entries.join(some.select("show", "episode_number", "date"), KEY, "left_anti").select(*entries.columns, F.lit(None).cast("string").alias("o_n"), F.lit(None).cast("string").alias("o_d"))
    per = some.select(*entries.columns, "o_n", "o_d").unionByName(gone).groupBy(*KEY, "guid").agg(F.count("o_n").alias("olds"), F.max("o_n").alias("old_number"), F.max("o_d").alias("old_date"))
    as_old = lambda df, name: df.select("show", F.col("episode_number").alias("old_number"), F.col("date").alias("old_date")).distinct().withColumn(name, F.lit(True))
    per = per.join(as_old(volume, "has_file"), ["show", "old_number", "old_date"], "left").join(as_old(feed, "in_feed"), ["show", "old_number", "old_date"], "left")
    no = lambda c: F.coalesce(c, F.lit(False))
    verdict = F.when(F.coalesce("guid", F.lit("")) == "", "no_guid").when(F.col("olds") == 0, "new").when(F.col("olds") > 1, "several").when(F.col("old_date") != F.col("date"), "date_moved").when(~no(F.col("has_file")), "no_file").when(no(F.col("in_feed")), "still_in_feed").otherwise("rename")
    return per.select(*KEY, "guid", verdict.alias("verdict"), F.when(verdict == "rename", F.col("old_number")).alias("old_number"))


def orphans(feed: DataFrame, volume: DataFrame, stored: DataFrame, exclusions: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Transcripts that neither feed nor store nor a rename accounts for, but excluded ones."""
    out = volume.select(*KEY).distinct()
    renamed = verdicts.where("verdict = 'rename'").select("show", F.col("old_number").alias("episode_number"), "date")
    for other in (feed, stored, renamed):
        out = out.join(other.select(*KEY), KEY, "left_anti")
    return not_excluded(out, exclusions, None)


def body_hash(text: Column) -> Column:
    """What a transcript holds after its first line, whatever its line ends."""
    plain = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    return F.sha2(F.when(plain.contains("\n"), F.regexp_replace(plain, "^[^\n]*\n", "")).otherwise(F.lit("")), 256)


def classify_texts(old: DataFrame, new: DataFrame) -> DataFrame:
    """old (name, date, text) with verdict: renamed (one file of the date has its body; new_name), stale (none), problem (several)."""
    a = old.select("name", "date", body_hash(F.col("text")).alias("h"))
    b = new.select(F.col("name").alias("new_name"), "date", body_hash(F.col("text")).alias("h"))
    per = a.join(b, ["date", "h"], "left").groupBy("name", "date").agg(F.count("new_name").alias("n"), F.max("new_name").alias("new_name"))
    return per.select("name", "date", F.when(F.col("n") == 1, "renamed").when(F.col("n") == 0, "stale").otherwise("problem").alias("verdict"), F.when(F.col("n") == 1, F.col("new_name")).alias("new_name"))


def remap_assignments(assignments: DataFrame, verdicts: DataFrame, *, expect_renamed: int = -1, expect_dropped: int = -1) -> DataFrame:
    """assignments under their episodes' new names, without those of stale ones, once the counts are as foretold; a problem lets nothing through."""
    if not verdicts.where("verdict = 'problem'").isEmpty():
        raise RuntimeError("some files match more than one")
    require_expected(verdicts.where("verdict = 'renamed' and new_name != name").count(), expect_renamed)
    require_expected(verdicts.where("verdict = 'stale'").count(), expect_dropped)
    v = verdicts.select(F.col("name").alias("episode"), "verdict", "new_name")
    df = assignments.join(v.where("verdict = 'stale'"), "episode", "left_anti").join(v.where("verdict = 'renamed'").select("episode", "new_name"), "episode", "left")
    return df.withColumn("episode", F.coalesce("new_name", "episode")).drop("new_name")


def validate(src: DataFrame, dst: DataFrame, *, metadata: str = "metadata", vector: str = "embedding", document: str = "document", id_map: DataFrame | None = None, allowed_new: tuple[str, ...] = (), atol: float = 1e-4) -> DataFrame:
    """(id, problem, detail) of each difference between a collection and its copy: missing, unexpected, document, metadata_missing, metadata_changed, metadata_extra (but allowed_new), embedding_presence, embedding. metadata is a map of strings. id_map (id, new_id) tells where ids went."""
    a = src.select("id", F.col(metadata).alias("ma"), F.col(vector).alias("va"), F.col(document).alias("da"))
    a = mapped_ids(a.withColumn("to", F.col("id")), id_map, "to")
    b = dst.select(F.col("id").alias("to"), F.col(metadata).alias("mb"), F.col(vector).alias("vb"), F.col(document).alias("db"), F.lit(True).alias("there"))
    j = a.join(b, "to", "full_outer")
    keys = lambda m: F.map_keys(F.coalesce(m, F.create_map().cast("map<string,string>")))
    lost = F.array_sort(F.array_except(keys(F.col("ma")), keys(F.col("mb"))))
    extra = F.array_sort(F.array_except(F.array_except(keys(F.col("mb")), keys(F.col("ma"))), F.array(*map(F.lit, allowed_new)).cast("array<string>")))
    changed = F.array_sort(F.filter(F.array_intersect(keys(F.col("ma")), keys(F.col("mb"))), lambda k: ~F.element_at("ma", k).eqNullSafe(F.element_at("mb", k))))
    gap = lambda name, cond, detail=F.lit(""): F.when(cond, F.struct(F.lit(name).alias("problem"), detail.alias("detail")))
    text = lambda arr: F.array_join(arr, ",")
    both = F.col("id").isNotNull() & F.col("there").isNotNull()
    found = F.array(
        gap("missing", F.col("there").isNull()),
        gap("unexpected", F.col("id").isNull()),
        gap("document", both & ~F.col("da").eqNullSafe(F.col("db"))),
        gap("metadata_missing", both & (F.size(lost) > 0), text(lost)),
        gap("metadata_changed", both & (F.size(changed) > 0), text(changed)),
        gap("metadata_extra", both & (F.size(extra) > 0), text(extra)),
        gap("embedding_presence", both & (F.col("va").isNull() != F.col("vb").isNull())),
        gap("embedding", both & F.col("va").isNotNull() & F.col("vb").isNotNull() & ~all_close(F.col("va"), F.col("vb"), atol)),
    )
    return j.select(F.coalesce("id", "to").alias("id"), F.explode(F.filter(found, lambda x: x.isNotNull())).alias("p")).select("id", "p.*")


def changed_vectors(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Vectors of equal keys in two runs: keys, same; refuses runs that share none."""
    both = old.select(*keys, F.col("vector").alias("a")).join(new.select(*keys, F.col("vector").alias("b")), keys)
    if both.isEmpty():
        raise RuntimeError("the runs have no key in common")
    return both.select(*keys, all_close(F.col("a"), F.col("b"), 1e-6).alias("same"))


def differing_names(a: DataFrame, b: DataFrame) -> DataFrame:
    """(name, side) of names in one list alone."""
    return a.select("name").exceptAll(b.select("name")).withColumn("side", F.lit("first")).union(b.select("name").exceptAll(a.select("name")).withColumn("side", F.lit("second")))


def drop_all_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """df without those of the columns that hold nothing at all."""
    seen = df.agg(*(F.count(c).alias(c) for c in columns)).first()
    return df.drop(*(c for c in columns if not seen[c]))


def mapped_ids(df: DataFrame, id_map: DataFrame | None, column: str = "id") -> DataFrame:
    """df with its ids sent through id_map (id, new_id); those that it doesn't list stay."""
    if id_map is None:
        return df
    to = id_map.select(F.col("id").alias("from_"), F.col("new_id").alias("to_"))
    return df.join(to, F.col(column) == F.col("from_"), "left").withColumn(column, F.coalesce("to_", column)).drop("from_", "to_")
