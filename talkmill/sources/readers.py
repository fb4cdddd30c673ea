"""Readers and writers of transcripts, feeds, logs, books and audio headers, and the seams for models."""

from __future__ import annotations

import os
import re
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import feed_date, feed_guid, feed_number, file_triple, segments, title_of
from ..operators.turns import merge_turns, non_monotonic, speech_shares
from ..session import prepared


#: Requests to a file system that the driver makes at a time.
AT_ONCE = 16


#: Where a folder of transcripts has its packs; readers of files pass over such names.
PACKS = "_packs"


def _packs(spark: SparkSession, folder: str) -> list[str]:
    """The packs of a folder, oldest first."""
    from .store import Files

    return [n for n in Files(spark, f"{folder}/{PACKS}").names() if n[0].isdigit()]


def transcripts(spark: SparkSession, folder: str, show: str | None = None) -> DataFrame:
    """Text files of a folder whole, and the texts of its packs: name, show, episode_number, date, year ("unparsed" if the name isn't a transcript's), title, text. Of a name that comes from several writes the last one counts."""
    glob = f"{show} - Episode *.txt" if show else "*.txt"
    loose = spark.read.text(folder, wholetext=True, pathGlobFilter=glob)
    packs = _packs(spark, folder)
    df = loose.select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"), F.col("_metadata.file_modification_time").alias("at_"))
    df = df.withColumn("name", F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B"))))
    if packs:
        whose = F.col("name").startswith(f"{show} - Episode ") if show else F.lit(True)
        of = [spark.read.schema("name string, text string").parquet(f"{folder}/{PACKS}/{n}").where(whose).withColumn("at_", F.timestamp_micros(F.lit(int(n.split("-")[0]) // 1000))) for n in packs]
        of += [df] if loose.inputFiles() else []
        df = reduce(DataFrame.unionByName, of)
        if len(of) > 1:
            df = df.join(df.groupBy("name").agg(F.max("at_").alias("at_")), ["name", "at_"], "left_semi")
    df = df.withColumn("k", file_triple(F.col("name")))
    blank = lambda c: F.coalesce(c, F.lit(""))
    return df.select("name", blank(F.col("k.show")).alias("show"), blank(F.col("k.episode_number")).alias("episode_number"), blank(F.col("k.date")).alias("date"), F.coalesce(F.substring("k.date", 1, 4), F.lit("unparsed")).alias("year"), title_of(F.col("text")).alias("title"), "text")


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(show, episode_number, date) of a folder's transcripts, from their names alone: contents of files and of packs aren't read."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select(F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B"))).alias("name"))
    packs = _packs(spark, folder)
    if packs:
        names = names.unionByName(spark.read.schema("name string").parquet(*(f"{folder}/{PACKS}/{n}" for n in packs)))
    return names.select(file_triple(F.col("name")).alias("k")).where("k is not null").select("k.*").distinct()


def episodes(texts: DataFrame, cap: float) -> dict[str, DataFrame]:
    """What analytics need of transcripts: segments, turns, shares and faults, by episode (the file's name). Files without segments have no rows."""
    seg = segments(texts.select(F.col("name").alias("episode"), "show", "year", "text"))
    turns = merge_turns(seg, cap, ("episode", "show", "year"))
    return {"segments": seg, "turns": turns, "shares": speech_shares(turns, keys=("episode", "show", "year")), "faults": non_monotonic(seg)}


FEED_ITEM = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("pubDate", T.StringType()),
        T.StructField("guid", T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_isPermaLink", T.StringType())])),
        T.StructField("itunes:episode", T.StringType()),
        T.StructField("link", T.ArrayType(T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_rel", T.StringType()), T.StructField("_href", T.StringType())]))),
        T.StructField("enclosure", T.ArrayType(T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_url", T.StringType())]))),
    ]
)


def feed(spark: SparkSession, path: str, show: str) -> DataFrame:
    """Items of an RSS file, or of the files of a folder, in order of their names: show, feed_pos, title, episode_number, audio_url, date, guid, published. Those without audio are left out; a link that says enclosure comes before the enclosure itself."""
    df = spark.read.format("xml").option("rowTag", "item").schema(FEED_ITEM).load(path)
    at, files = F.monotonically_increasing_id(), sorted(df.inputFiles())
    if len(files) > 1:  # partitions follow the files' sizes
        ranks = F.broadcast(spark.createDataFrame(list(enumerate(files)), "rank_ long, file_ string"))  # a row for each file
        at = (F.shiftleft(F.col("rank_"), 46)) + F.col("at_")
        df = df.withColumns({"file_": F.input_file_name(), "at_": F.monotonically_increasing_id()}).join(ranks, "file_", "left").drop("file_")
    df = df.withColumn("feed_pos", at)
    marked = F.filter("link", lambda x: x["_rel"] == "enclosure")
    url = F.coalesce(F.get(marked, F.lit(0))["_href"], F.get("enclosure", F.lit(0))["_url"])
    is_link = F.when(F.col("guid._isPermaLink") == "false", False).when(F.col("guid._isPermaLink") == "true", True)
    out = df.select(F.lit(show).alias("show"), "feed_pos", F.coalesce("title", F.lit("")).alias("title"), feed_number(F.col("`itunes:episode`"), F.col("title")).alias("episode_number"), url.alias("audio_url"), feed_date(F.col("pubDate")).alias("date"), feed_guid(F.col("guid._VALUE"), is_link).alias("guid"), F.col("pubDate").alias("published"))
    return out.where("coalesce(audio_url, '') != ''")


def audio_urls(items: DataFrame) -> DataFrame:
    """(episode_number, date, audio_url), the last item of each; items as feed() gives them, before or after it drops any."""
    return items.where("audio_url is not null").groupBy("show", "episode_number", "date").agg(F.max_by("audio_url", "feed_pos").alias("audio_url"))


def feed_faults(items: DataFrame) -> DataFrame:
    """One row: items, and those without audio or date."""
    return items.agg(F.count("*").alias("items"), F.count_if(F.col("audio_url").isNull()).alias("no_enclosure"), F.count_if(F.col("date") == "Unknown Date").alias("no_date"))


def json_map(spark: SparkSession, path: str, value: str, key_name: str) -> DataFrame:
    """A JSON file that is one object of objects: a row per key, its value read by the schema `value`."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias(key_name, "v")).select(key_name, "v.*")


def log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file of JSON lines with seq, their order; blank lines are passed over. One file, or files whose names sort in order."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i"))
    return rows.where(F.trim("value") != "").select(F.from_json("value", schema).alias("v"), F.col("i").alias("seq")).select("v.*", "seq")


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def _lines() -> Column:
    from ..functions.text import to_places

    return F.format_string("[%s] %ss - %s", "speaker", to_places(F.col("start").cast("double"), 1).cast("decimal(30,1)").cast("string"), "text")


def write_transcripts(segs: DataFrame, folder: str) -> int:
    """One text file per episode, by its name, as transcripts() reads it: segs (show, episode_number, title, date, seq, speaker, start, text), a header and a line per segment. Files are written beside first and then moved, over those of an earlier write. Returns how many. A file costs some requests to the file system, in the driver and when it is read; for many episodes there is pack_transcripts."""
    from ..functions.text import file_name, header
    from .store import Files

    spark = segs.sparkSession
    whole = segs.groupBy("show", "episode_number", "title", "date").agg(F.array_sort(F.collect_list(F.struct("seq", _lines().alias("line")))).alias("l"))
    text = F.concat(header(F.col("show"), F.col("episode_number"), F.col("title"), F.col("date")), F.array_join(F.transform("l", lambda x: x["line"]), "\n"))
    named = whole.select(file_name(F.col("show"), F.col("episode_number"), F.col("date")).alias("name"), text.alias("value"))
    part = f".partial-{uuid.uuid4().hex}"
    named.repartition("name").write.partitionBy("name").text(f"{folder}/{part}")
    files, made = Files(spark, folder), Files(spark, f"{folder}/{part}")
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    there = {at: unescape(at[5:]) for at in made.names() if at.startswith("name=")}
    for name in there.values():
        if "/" in name:
            raise ValueError(f"{name!r} can't be a file's name")

    def settle(at: str) -> None:
        (found,) = (f for f in Files(spark, f"{folder}/{part}/{at}").names() if f.startswith("part-"))
        files.remove(there[at])
        files.move(f"{part}/{at}/{found}", there[at])

    with ThreadPoolExecutor(AT_ONCE) as pool:  # names of one folder: a store answers many requests at a time
        list(pool.map(settle, there))
    files.remove(part)
    return len(there)


def pack_transcripts(segs: DataFrame, folder: str) -> int:
    """The texts of write_transcripts under the same names, as rows of a pack instead of a file each, so that requests grow with the tasks that write and not with the episodes. transcripts() and listing() read packs and files alike; ingest_available() watches files alone. A pack is written beside and then named; its texts stand for those of earlier writes. Returns how many.

    Rows lie in order of names, so that those of a show are read without the others; a group of rows holds 16 MB, so that readers hold no more at a time.
    """
    from ..functions.text import file_name, header
    from .store import Files

    spark, at = segs.sparkSession, f"{folder}/{PACKS}"
    key = ("show", "episode_number", "date")
    whole = segs.groupBy(*key).agg(F.min("title").alias("title"), F.array_sort(F.collect_list(F.struct("title", "seq", _lines().alias("line")))).alias("l"))
    text = F.concat(header(F.col("show"), F.col("episode_number"), F.col("title"), F.col("date")), F.array_join(F.transform("l", lambda x: x["line"]), "\n"))
    name = file_name(*(F.col(k) for k in key))
    name = F.when(name.contains("/"), F.raise_error(F.concat(name, F.lit(" can't be a file's name")))).otherwise(name)
    part, files = f".partial-{uuid.uuid4().hex}", Files(spark, at)
    whole.select(name.alias("name"), text.alias("text")).sortWithinPartitions("name").write.option("parquet.block.size", 16 << 20).parquet(f"{at}/{part}")
    pack = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    files.move(part, pack)
    return spark.read.schema("name string").parquet(f"{at}/{pack}").count()


def book_pages(texts: DataFrame, page_end: str = "\f") -> DataFrame:
    """(book, page from 1, text) of texts with page ends, blank pages left out."""
    parts = texts.select("book", F.posexplode(F.split("text", page_end)).alias("i", "text"))
    return parts.select("book", (F.col("i") + 1).alias("page"), "text").where(F.trim("text") != "")


def with_model(df: DataFrame, model: Callable[[pd.Series], pd.Series], column: str, out: str, kind: str = "array<float>", at_once: int = 1024) -> DataFrame:
    """The seam for any model: it gets batches of a column, of at_once rows at most, and out holds what it returns. No more than that is in memory, so that at_once should be small where results are large."""
    prepared(df.sparkSession)

    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            for i in range(0, len(batch), at_once):
                yield model(batch.iloc[i : i + at_once])

    return df.withColumn(out, F.pandas_udf(pieces, kind, F.PandasUDFType.SCALAR_ITER)(F.col(column)))


def hashed_encoder(dim: int = 64) -> Callable[[pd.Series], pd.Series]:
    """A stand-in for a text encoder, for tests: words are hashed into unit vectors; equal texts have equal ones."""
    import hashlib
    import math

    def encode(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            v, words = [0.0] * dim, (text or "").lower().split()
            for w in words:
                h = hashlib.blake2b(w.encode(), digest_size=8).digest()
                v[int.from_bytes(h[:4], "big") % dim] += 1.0 if h[4] & 1 else -1.0
            if words and not any(v):  # they cancel each other out
                v[int.from_bytes(hashlib.blake2b(" ".join(words).encode(), digest_size=4).digest(), "big") % dim] = 1.0
            n = math.sqrt(sum(x * x for x in v)) or 1.0
            out.append([x / n for x in v])
        return pd.Series(out)

    def batches(texts: pd.Series) -> pd.Series:
        return encode(texts)

    return batches


#: Sample rates of MPEG audio by version bits and rate bits.
MPEG_RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}


def mpeg_rate(data: bytes | None) -> int | None:
    """The sample rate of the first MPEG frame after an ID3v2 tag; null without one. A sync is a frame's only if its version, rate and bit rate are such as the format has; others are passed over."""
    if not data:
        return None
    at = 0
    if data[:3] == b"ID3" and len(data) >= 10:
        size = 0
        for b in data[6:10]:
            size = size << 7 | b & 127
        at = 10 + size
    while at + 3 < len(data):
        at = data.find(b"\xff", at)
        if at < 0 or at + 3 >= len(data):
            return None
        head = data[at + 1]
        rates, code = MPEG_RATES.get(head >> 3 & 3), data[at + 2] >> 2 & 3
        if head & 0xE0 == 0xE0 and rates and code < 3 and data[at + 2] >> 4 not in (0, 15):
            return rates[code]
        at += 1
    return None


def audio_rates(files: DataFrame, content: str = "content") -> DataFrame:
    """files with rate."""

    def rates(data: pd.Series) -> pd.Series:
        return data.map(mpeg_rate).astype("Int64")

    return with_model(files, rates, content, "rate", "int")


def checked_urls(df: DataFrame, head: Callable[[str], int], ranged: Callable[[str], int], url: str = "audio_url", at_once: int = 8) -> DataFrame:
    """df with verdict OK, DEAD or UNKNOWN: by the status of a head request, or of a ranged one where head isn't answered (403, 405, 501). The requests are the caller's; no more than at_once tasks make them."""
    prepared(df.sparkSession)

    def verdict(urls: pd.Series) -> pd.Series:
        def one(u: str) -> str:
            try:
                status = head(u)
                if status in (403, 405, 501):
                    status = ranged(u)
            except Exception:  # noqa: BLE001  whatever a network can raise
                return "UNKNOWN"
            return "OK" if status in (200, 206) else "DEAD" if status in (404, 410) else "UNKNOWN"

        return urls.map(one)

    return df.coalesce(at_once).withColumn("verdict", F.when(F.col(url).isNull(), "ABSENT").otherwise(F.pandas_udf("string")(verdict)(F.coalesce(F.col(url), F.lit("")))))


def embedded_crops(plan: DataFrame, embed: Callable[[str, float, float], list[float]], path: str = "audio_path", at_once: int = 8) -> DataFrame:
    """plan with vector, error and error_kind: the seam for a voice model. Rows of an episode come together, so that its audio is fetched once; a crop that fails has an error and no vector."""
    prepared(plan.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            vectors, errors, kinds = [], [], []
            for r in f.itertuples(index=False):
                try:
                    vectors.append(list(embed(getattr(r, path), r.crop_start_s, r.crop_length_s)))
                    errors.append(None)
                    kinds.append(None)
                except Exception as e:  # noqa: BLE001  a model's own errors
                    vectors.append(None)
                    errors.append(str(e))
                    kinds.append("download" if isinstance(e, OSError) else "crop")
            yield f.assign(vector=vectors, error=errors, error_kind=kinds)

    fields = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in plan.schema)
    return plan.repartition(at_once, "episode").sortWithinPartitions("episode").mapInPandas(run, f"{fields}, vector array<float>, error string, error_kind string")


def settings(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Where the store is and how to enter it; a missing value is named. Plain http is for this machine alone."""
    missing = [k for k in ("STORE_URL", "STORE_TOKEN") if not env.get(k)]
    if missing:
        raise KeyError(f"set {' and '.join(missing)}")
    url = env["STORE_URL"]
    if not re.match(r"https://|http://(localhost|127\.0\.0\.1)([:/]|$)|file:|hdfs:|s3a?:|abfss?:|gs:", url):
        raise ValueError("the store must be reached by https")
    return {"url": url, "token": env["STORE_TOKEN"]}
