"""RSS feeds as a Spark data source: a partition for each feed, as a batch or as a stream of what is new; and transcripts' segments as a table function."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import urlsplit
from urllib.request import urlopen
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType
from pyspark.sql.udtf import UserDefinedTableFunction

from ..functions.text import SEGMENT, feed_date, feed_guid, feed_number
from ..session import prepared

SCHEMA = "feed string, feed_pos long, title string, published string, guid string, is_link string, itunes_episode string, audio_url string, error string"
_ITUNES = re.compile(r"\{http://www\.itunes\.com/dtds/[^}]*\}episode", re.IGNORECASE)


class FeedPart(InputPartition):
    """A feed, and which of its items are wanted, counted from the oldest; all, if that isn't said."""

    def __init__(self, feed: str, first: int = 0, until: int | None = None) -> None:
        self.feed, self.first, self.until = feed, first, until


def opened(feed: str, timeout: float):
    """A feed's bytes: by http, from this machine, or from any store that Arrow knows."""
    scheme = urlsplit(feed).scheme
    if scheme in ("http", "https"):
        return urlopen(feed, timeout=timeout)  # noqa: S310  scheme is checked
    if scheme in ("", "file"):
        return open(urlsplit(feed).path or feed, "rb")
    from pyarrow.fs import FileSystem

    store, path = FileSystem.from_uri(feed)
    return store.open_input_stream(path)


def items(feed: str, timeout: float) -> Iterator[tuple]:
    """A feed's items as rows of SCHEMA, one after the other; no more of the file than an item is held."""
    with opened(feed, timeout) as source:
        at = 0
        above: list[ElementTree.Element] = []
        for event, found in ElementTree.iterparse(source, ("start", "end")):
            if event == "start":
                above.append(found)
                continue
            above.pop()
            if found.tag != "item":
                continue
            own = {"title": None, "pubDate": None, "guid": None}
            is_link = itunes = marked = enclosed = None
            for child in found:
                if child.tag in own and own[child.tag] is None:
                    own[child.tag] = child.text or ""
                    is_link = child.get("isPermaLink") if child.tag == "guid" else is_link
                elif _ITUNES.fullmatch(child.tag):
                    itunes = itunes if itunes is not None else child.text or ""
                elif child.tag == "link" and child.get("rel") == "enclosure":
                    marked = marked or child.get("href")
                elif child.tag == "enclosure":
                    enclosed = enclosed or child.get("url")
            yield feed, at, own["title"], own["pubDate"], own["guid"], is_link, itunes, marked or enclosed, None
            at += 1
            found.clear()
            if above:
                above[-1].remove(found)


class _Reading:
    def __init__(self, options: dict[str, str]) -> None:
        self.feeds = json.loads(options.get("feeds", "[]")) or [options["path"]]
        self.timeout, self.failing = float(options.get("timeout", "30")), options.get("mode", "FAILFAST").upper() == "FAILFAST"

    def read(self, part: FeedPart) -> Iterator[tuple]:
        count, held = 0, None
        if part.until is not None:  # newest items come first
            count = sum(1 for _ in items(part.feed, self.timeout))
        try:
            for held in items(part.feed, self.timeout):
                if part.until is None or part.first <= count - 1 - held[1] < part.until:
                    yield held
        except (OSError, ElementTree.ParseError) as e:
            if self.failing:
                raise
            yield part.feed, (held[1] + 1 if held else 0), *[None] * 6, f"{type(e).__name__}: {e}"


class _Batch(_Reading, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return [FeedPart(f) for f in self.feeds]


class _Stream(_Reading, DataSourceStreamReader):
    """Offsets are numbers of items for each feed: feeds keep their items and put new ones first. One that has fewer items than before, or can't be read just now, has nothing new."""

    def initialOffset(self) -> dict:  # noqa: N802  Spark's name
        return {f: 0 for f in self.feeds}

    def latestOffset(self) -> dict:  # noqa: N802
        found = {}
        for feed in self.feeds:
            try:
                found[feed] = sum(1 for _ in items(feed, self.timeout))
            except (OSError, ElementTree.ParseError):
                if self.failing:
                    raise
                found[feed] = 0
        return found

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [FeedPart(f, start.get(f, 0), n) for f, n in sorted(end.items()) if n > start.get(f, 0)]


class FeedSource(DataSource):
    """spark.read.format("rss_feeds").option("feeds", a JSON list of addresses): the raw fields of items, with their place in the feed. mode PERMISSIVE gives a feed that can't be read a row with its error."""

    @classmethod
    def name(cls) -> str:
        return "rss_feeds"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return _Stream(self.options)


def read_feeds(spark: SparkSession, feeds: dict[str, str | list[str]], *, stream: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """Episodes of the feeds of shows (show to address, or to those of its pages, each with feed_pos of its own), as readers.feed() gives those of one file: show, feed_pos, title, episode_number, audio_url, date, guid, published. Feeds are read side by side, one task each. A stream gives what came since the last batch."""
    prepared(spark).dataSource.register(FeedSource)
    shows: dict[str, list[str]] = {}
    for show, found in feeds.items():
        for at in [found] if isinstance(found, str) else found:
            shows.setdefault(at, []).append(show)
    rows = (spark.readStream if stream else spark.read).format("rss_feeds").option("feeds", json.dumps(sorted(shows))).option("mode", mode).load()
    named = F.create_map(*(F.lit(x) for at, s in shows.items() for x in (at, s)))  # as long as the call's own list
    of = F.explode(F.element_at(named, F.col("feed"))) if feeds else F.lit(None).cast("string")
    is_link = F.when(F.col("is_link") == "false", False).when(F.col("is_link") == "true", True)
    out = rows.select(of.alias("show"), "feed_pos", F.coalesce("title", F.lit("")).alias("title"), feed_number(F.col("itunes_episode"), F.col("title")).alias("episode_number"), "audio_url", feed_date(F.col("published")).alias("date"), feed_guid(F.col("guid"), is_link).alias("guid"), "published", *(["error"] if mode.upper() != "FAILFAST" else []))
    return out.where("coalesce(audio_url, '') != ''" + (" or error is not null" if mode.upper() != "FAILFAST" else ""))


class _Segments:
    """The segments of a transcript, one row each."""

    def eval(self, text: str | None) -> Iterator[tuple[int, str, float | None, str]]:
        line, seq = re.compile(SEGMENT), 0
        for raw in (text or "").splitlines():
            found = line.match(raw.strip())
            if found and not raw.strip().startswith("#"):
                try:
                    start = float(found[2])
                except ValueError:
                    start = None
                yield seq, found[1], start, found[3]
                seq += 1


def register_segments(spark: SparkSession, name: str = "transcript_segments") -> UserDefinedTableFunction:
    """Makes SQL know a transcript's segments: SELECT t.name, s.* FROM t, LATERAL transcript_segments(t.text) s. From Python, functions.text.segments() does the same without leaving the JVM."""
    made = F.udtf(_Segments, returnType="seq int, speaker string, start double, text string")
    return prepared(spark).udtf.register(name, made)
