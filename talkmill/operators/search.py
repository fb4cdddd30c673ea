"""Search by meaning with filters on metadata, and how hits read."""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import display_speaker, strip_speaker, to_places
from ..functions.vectors import dot, dot_with, norm

if TYPE_CHECKING:
    from .index import VectorIndex

OPERATORS = {"$eq": lambda c, v: c == v, "$ne": lambda c, v: ~c.eqNullSafe(F.lit(v)), "$gt": lambda c, v: c > v, "$gte": lambda c, v: c >= v, "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v, "$in": lambda c, v: c.isin(list(v))}


def where(tree: dict | None) -> Column:
    """A filter tree as a predicate: {"show": {"$eq": "x"}}, joined by $and and $or. Comparisons never match a missing value, but $ne does. No tree lets all pass; an unknown operator raises."""
    if not tree:
        return F.lit(True)
    parts = []
    for key, value in tree.items():
        if key in ("$and", "$or"):
            parts.append(reduce(lambda a, b: a & b if key == "$and" else a | b, map(where, value)))  # noqa: B023
            continue
        for op, x in (value if isinstance(value, dict) else {"$eq": value}).items():
            if op not in OPERATORS:
                raise ValueError(f"no filter operator {op}")
            parts.append(OPERATORS[op](F.col(key), x))
    return reduce(lambda a, b: a & b, parts)


def filters(show: str | None = None, after_date: str | None = None, before_date: str | None = None, speaker: str | None = None) -> dict | None:
    """The tree of the search arguments; empty ones don't filter, date bounds are inclusive."""
    day = lambda d: int(d.replace("-", ""))
    parts = [{"show": {"$eq": show}}] * bool(show) + [{"date_ts": {"$gte": day(after_date)}} for _ in [0] if after_date] + [{"date_ts": {"$lte": day(before_date)}} for _ in [0] if before_date] + [{"speaker_id": {"$eq": speaker}}] * bool(speaker)
    return None if not parts else parts[0] if len(parts) == 1 else {"$and": parts}


def nearest(records: DataFrame, query: list[float], n: int, tree: dict | None = None, vector: str = "embedding", id_col: str = "id", *, few: bool = False) -> DataFrame:
    """The n records nearest to the query by cosine distance, ties by id: each partition keeps n, the driver merges them. Filters reach the scan. Where there are few records, the query is walked along rather than written into code, which would be compiled anew for each one."""
    length = sum(x * x for x in query) ** 0.5
    if length == 0:
        raise ValueError("the query vector has no length")
    product = dot(F.col(vector), F.array(*(F.lit(float(x)) for x in query))) if few else dot_with(F.col(vector), query)
    similarity = F.coalesce(F.try_divide(product, norm(F.col(vector)) * length), F.lit(0.0))
    return records.where(where(tree)).where(F.col(vector).isNotNull()).withColumn("distance", 1 - similarity).orderBy("distance", id_col).limit(n)


def unknown_speaker(people: DataFrame, speaker: str) -> str | None:
    """What to say of a name that isn't among the people's: which there are, the first thousand of them. Null if it is one."""
    if not people.where(F.col("display") == speaker).isEmpty():
        return None
    listed = [r[0] for r in people.select("display").where("display is not null").distinct().orderBy("display").limit(1001).collect()]  # for a reader
    return f"no speaker {speaker!r}; there are: {', '.join(listed[:1000])}{' and more' * (len(listed) > 1000)}"


def search(records: DataFrame | VectorIndex, query: list[float], n: int = 10, *, show: str | None = None, after_date: str | None = None, before_date: str | None = None, speaker: str | None = None, people: DataFrame | None = None, vector: str = "embedding", id_col: str = "id") -> DataFrame:
    """The n nearest records, latest first (unknown dates last), equal dates by nearness: similarity_rank, position, relevance_score and the records' columns but the vector. A speaker that `people` doesn't list is refused with those it does, rather than found nowhere. records may be an index, whose cells are probed then."""
    if speaker and people is not None:
        wrong = unknown_speaker(people, speaker)
        if wrong:
            raise ValueError(wrong)
    tree = filters(show, after_date, before_date, speaker)
    if isinstance(records, DataFrame):
        hits = nearest(records, query, n, tree, vector, id_col).drop(vector)
    else:
        from .index import indexed

        hits, id_col = indexed(records, query, n, tree).drop(records.vector), records.id_col
    return hits_by_date(hits, id_col)


def hits_by_date(hits: DataFrame, id_col: str = "id") -> DataFrame:
    """The few hits of a search with similarity_rank, position (latest first, unknown dates last, equal dates by nearness) and relevance_score in place of their distance, in order of position."""
    ranked = hits.withColumn("similarity_rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("distance", id_col)))  # n rows
    ranked = ranked.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc_nulls_last("date"), "similarity_rank")))
    return ranked.withColumn("relevance_score", to_places(1 - F.col("distance"), 3)).drop("distance").orderBy("position")


def latest_on_topic(records: DataFrame | VectorIndex, query: list[float], n: int = 5, **more) -> DataFrame:
    """The same n by nearness, latest first, without a score: not the latest records of all."""
    return search(records, query, n, **more).drop("relevance_score")


def rendered(hits: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """position and the text that a reader gets for each hit. names: speaker_id, display, any number of people."""
    df = hits.join(names, "speaker_id", "left") if names is not None else hits.withColumn("display", F.lit(None).cast("string"))
    who = display_speaker(F.col("speaker_id"), F.col("display"), F.col("speaker"))
    head = F.concat(F.lit("["), F.col("date"), F.lit("] "), F.col("show"), F.lit(" - Episode "), F.col("episode_number"), F.lit(" ("), F.col("episode_title"), F.lit(") @ "), to_places(F.col("start_time").cast("double"), 1).cast("decimal(30,1)").cast("string"), F.lit("s | speaker: "), who)
    if "relevance_score" in hits.columns:
        head = F.concat(head, F.lit(" [relevance: "), F.col("relevance_score").cast("string"), F.lit("]"))
    return df.select("position", F.concat(head, F.lit("\n"), strip_speaker(F.col("document"), F.col("speaker")), F.lit("\n")).alias("text"))


def response(hits: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """One row: all hits in order, parted by lines of hyphens; "No results found." without any."""
    parts = rendered(hits, names).groupBy().agg(F.array_sort(F.collect_list(F.struct("position", "text"))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: x["text"]), "\n---\n")
    return parts.select(F.when(F.size("p") == 0, F.lit("No results found.")).otherwise(joined).alias("text"))
