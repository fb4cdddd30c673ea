"""Feeds as a data source: beside the reader of one file, as batches and as a stream."""

import pytest
from pyspark.sql import functions as F

from talkmill.functions.text import segments
from talkmill.sources import feeds, readers

HEAD = '<?xml version="1.0"?>\n<rss xmlns:itunes="http://www.itunes.com/dtds/podcast-1.0.dtd"><channel><title>no item</title>'
ITEMS = [
    '<item><title>Ep. 7: a &amp; b</title><pubDate>Tue, 05 Mar 2024 23:30:00 -0700</pubDate><guid isPermaLink="false">g7</guid><enclosure url="http://a/7" type="audio/mpeg"/></item>',
    '<item><title>no audio</title><guid>g6</guid></item>',
    '<item><title>five</title><pubDate>soon</pubDate><guid>http://x/5</guid><itunes:episode>5</itunes:episode><link>http://page</link><link rel="enclosure" href="http://l/5"/><enclosure url="http://a/5"/></item>',
    '<item><guid isPermaLink="true">g4</guid><enclosure url="http://a/4"/><enclosure url="http://a/4b"/></item>',
]


def feed(folder, name, found):
    at = folder / name
    at.write_text(HEAD + "".join(found) + "</channel></rss>")
    return str(at)


def rows(df):
    return sorted((r["show"], r["feed_pos"], r["title"], r["episode_number"], r["audio_url"], r["date"], r["guid"]) for r in df.collect())


def test_a_feed_reads_as_its_file_does(spark, tmp_path):
    one, two = feed(tmp_path, "one.xml", ITEMS), feed(tmp_path, "two.xml", ITEMS[1:])
    got = feeds.read_feeds(spark, {"A": one, "B": f"file://{two}", "C": one})
    assert got.columns == readers.feed(spark, one, "A").columns
    expected = rows(readers.feed(spark, one, "A")) + rows(readers.feed(spark, two, "B")) + rows(readers.feed(spark, one, "C"))
    assert rows(got) == sorted(expected) and len(expected) == 8
    assert got.rdd.getNumPartitions() == 2  # one for each feed


def test_feeds_that_cant_be_read(spark, tmp_path):
    good, broken = feed(tmp_path, "good.xml", ITEMS), tmp_path / "broken.xml"
    broken.write_text(HEAD + ITEMS[0] + "<item><title>cut")
    shows = {"A": good, "B": str(broken), "C": str(tmp_path / "none.xml")}
    with pytest.raises(Exception, match="none.xml|ParseError|unclosed|no element"):
        feeds.read_feeds(spark, shows).collect()
    got = feeds.read_feeds(spark, shows, mode="PERMISSIVE").groupBy("show").agg(F.count("audio_url").alias("n"), F.max("error").alias("error")).collect()
    told = {r["show"]: (r["n"], (r["error"] or "").split(":")[0]) for r in got}
    assert told == {"A": (3, ""), "B": (1, "ParseError"), "C": (0, "FileNotFoundError")}


def test_a_stream_gives_what_is_new(spark, tmp_path):
    """Feeds grow between runs, one of them is new; each item comes once, also where a run broke off."""
    a, out, held = feed(tmp_path, "a.xml", ITEMS[2:]), str(tmp_path / "out"), str(tmp_path / "held")
    b = feed(tmp_path, "b.xml", [])

    def run(broken=False):
        def take(batch, number):
            if broken:
                raise RuntimeError("broken off")
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

        feeds.read_feeds(spark, {"A": a, "B": b}, stream=True).writeStream.foreachBatch(take).option("checkpointLocation", held).trigger(availableNow=True).start().awaitTermination()
        return sorted((r["show"], r["audio_url"]) for r in spark.read.parquet(out).collect())

    first = run()
    assert first == [("A", "http://a/4"), ("A", "http://l/5")]
    assert run() == first
    feed(tmp_path, "a.xml", ITEMS)
    feed(tmp_path, "b.xml", ITEMS[:1])
    with pytest.raises(Exception, match="broken off"):
        run(broken=True)
    everything = [("A", "http://a/4"), ("A", "http://a/7"), ("A", "http://l/5"), ("B", "http://a/7")]
    assert run() == everything
    feed(tmp_path, "b.xml", [])  # a feed that lost its items has nothing new
    assert run() == everything


def test_segments_in_sql(spark):
    texts = ["# S - Episode 1\n[A] 0.5s - one two\n  [B] 3s - x [y] - z \nnoise\n[C] 1.2.3s - no start\r\n[D]  9s - \n# [E] 1s - a header", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "name int, text string")
    feeds.register_segments(spark)
    got = spark.sql("SELECT d.name, s.* FROM {d} d, LATERAL transcript_segments(d.text) s", d=df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, segments(df).select("name", "seq", "speaker", "start", "text").collect())) and got.count() >= 3


def test_items_leave_nothing_behind(tmp_path):
    """Memory doesn't grow with the number of items."""
    import tracemalloc

    from talkmill.sources import feeds

    def peak(n):
        (tmp_path / "f.xml").write_text("<rss><channel>" + "<item><title>t</title></item>\n" * n + "</channel></rss>")
        tracemalloc.start()
        assert sum(1 for _ in feeds.items(str(tmp_path / "f.xml"), 1)) == n
        _, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        return most

    peak(100)
    assert peak(40_000) < 2 * peak(4000) + 300_000


def test_a_feed_in_pages_keeps_its_order(spark, tmp_path):
    """Pages of a folder follow their names, whatever their sizes; a show may have pages as feeds of their own."""
    from talkmill.sources import feeds, readers

    for page, n in enumerate((1, 300, 20)):
        (tmp_path / f"{page}.xml").write_text('<?xml version="1.0"?>\n<rss><channel>\n' + "".join(f'<item><title>{page}-{i:03}</title><enclosure url="u{page}-{i:03}"/></item>\n' for i in range(n)) + "</channel></rss>\n")
    got = [r["title"] for r in readers.feed(spark, str(tmp_path), "S").orderBy("feed_pos").collect()]
    assert got == [f"{page}-{i:03}" for page, n in enumerate((1, 300, 20)) for i in range(n)]
    paged = feeds.read_feeds(spark, {"S": [str(tmp_path / f"{i}.xml") for i in range(3)]})
    assert sorted(r["title"] for r in paged.where("show = 'S'").collect()) == got


@pytest.mark.parametrize("name", ["s3_feed", "s4_audio_urls", "s3_feeds_source", "s3_feeds_stream"])
def test_queries_over_pages_equal_their_sql(spark, monkeypatch, name):
    """No task gets a feed whole: small pages give the same rows."""
    import duckdb

    from talkmill import queries, queries_io

    monkeypatch.setattr(queries_io, "PAGE", 1000)
    sf = "/root/testdata/sf0.001"
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{sf}/orders.parquet')")
        found = c.execute(queries.SQL[name])
        columns, want = [x[0] for x in found.description], sorted(map(repr, found.fetchall()))
    assert sorted(repr(tuple(r)) for r in queries.QUERIES[name](spark, sf).select(columns).collect()) == want and want
