"""Line dedup by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, col, unused

WIDTH = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _full(lines: Column) -> Column:
    """The numbers of the lines that hold a word."""
    return F.filter(F.transform(lines, lambda x, i: F.when(x.rlike("[^ \\x09-\\x0D]"), i)), lambda i: i.isNotNull())


def windows(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """id, th (a hash of the text), at, h, h2: for each window of three consecutive lines of a text its number and two hashes of the lines without white space around them. Lines without a word are passed over."""
    df = docs.select(F.col(id_).alias("id"), F.xxhash64(text).alias("th"), _lines(F.col(text)).alias("lines")).withColumn("full", _full(F.col("lines")))
    df = df.where(F.size("full") >= WIDTH).withColumn("bare", F.transform("full", lambda i: F.trim(F.get("lines", i), F.lit(SPACES))))
    at = F.sequence(F.lit(0), F.size("bare") - WIDTH)
    three = lambda i: [F.get("bare", i + k) for k in range(WIDTH)]
    found = F.explode(F.transform(at, lambda i: F.struct(i.alias("at"), F.xxhash64(*three(i)).alias("h"), F.hash(*three(i)).alias("h2"))))
    return df.select("id", "th", found.alias("w")).select("id", "th", "w.*")


def covered(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """id, th, ats: the windows of a document that are found earlier: in a document with a smaller id, or further up in its own."""
    found = windows(docs, id_, text)
    where = F.struct("id", "th", "at")
    first = found.groupBy("h", "h2").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first < last").select("h", "h2", "first")
    return found.join(first, ["h", "h2"]).where(where > F.col("first")).groupBy("id", "th").agg(F.collect_set("at").alias("ats"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with later occurrences of repeated windows of three lines taken out of the texts, and the columns n_lines and n_removed (long) added; columns of docs of these names give way.

    Windows overlap, and lines are numbered over those that hold a word, so that blank lines between don't hide a repeat. Of all windows with equal lines the one of the least (id, text hash, place) stays; the lines of all others are covered, and a text keeps the lines that no window covers. A line that goes is thus found again, in a place before. Lines without a word stay.

    Shuffled are windows (32 bytes each), reduced by hash before, and the texts once, to meet the numbers of their windows. A hot window is reduced where it is read, and its rows meet one row in a join that Spark can split.
    Null text stays null, with no lines; an empty one has one line. A null id comes before all others. Rows with equal id and text count as one document: they lose the same lines, and none for the others' sake. An empty table gives no rows.
    """
    own = [c for c in docs.columns if c.lower() not in {"n_lines", "n_removed"}]
    id_, text, th, lines, gone, k_id, k_th = unused(docs, "w_id", "w_text", "w_th", "w_lines", "w_gone", "w_kid", "w_kth")
    df = docs.withColumns({id_: col(id_col), text: col(text_col).cast("string")})
    marks = covered(df.select(id_, text), id_, text).toDF(k_id, k_th, gone)
    df = df.withColumn(th, F.xxhash64(text)).join(marks, F.col(id_).eqNullSafe(F.col(k_id)) & (F.col(th) == F.col(k_th)), "left")
    df = df.withColumn(lines, _lines(F.col(text)))
    (full,) = unused(df, "w_full")
    df = df.withColumn(full, F.when(F.col(gone).isNotNull(), _full(F.col(lines))))
    removed = F.array_distinct(F.flatten(F.transform(gone, lambda a: F.transform(F.sequence(a, a + WIDTH - 1), lambda i: F.get(full, i)))))
    df = df.withColumn(gone, removed)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rest = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    counts = [F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"), F.when(F.col(gone).isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long").alias("n_removed")]
    return df.select(*(rest.alias(c) if c == text_col else col(c) for c in own), *counts)
