"""Transcripts in packs read as files do, and cost no file each."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from talkmill import queries_io
from talkmill.sources import readers, store

SF = "/root/testdata/sf0.001"
SEGS = "show string, episode_number string, title string, date string, seq int, speaker string, start double, text string"


def segs(spark, word, episodes=(("A Show", "1"), ("A Show", "2"), ("A Show Too", "1"))):
    rows = [(show, number, "T", "2024-01-01", i, f"S{i % 2}", i * 1.25, f"{word} {i}, äöü") for show, number in episodes for i in range(12)]
    return spark.createDataFrame(rows, SEGS)


def told(df):
    return {r["name"]: tuple(r) for r in df.collect()}


def test_packs_read_as_files_do(spark, tmp_path):
    files, packs = str(tmp_path / "files"), str(tmp_path / "packs")
    assert readers.write_transcripts(segs(spark, "word"), files) == readers.pack_transcripts(segs(spark, "word"), packs) == 3
    names = os.listdir(packs)
    assert names == ["_packs"]
    for show in (None, "A Show", "A Show Too", "Another"):
        a, b = told(readers.transcripts(spark, files, show)), told(readers.transcripts(spark, packs, show))
        # Spark ends the last line of a file, which has no part in a segment
        assert {k: (*v[:-1], v[-1].rstrip("\n")) for k, v in a.items()} == b
        assert len(b) == {None: 3, "A Show": 2, "A Show Too": 1, "Another": 0}[show]
    assert set(readers.listing(spark, files).collect()) == set(readers.listing(spark, packs).collect())


def test_the_last_write_counts(spark, tmp_path):
    at = str(tmp_path / "in")
    readers.pack_transcripts(segs(spark, "old"), at)
    assert readers.pack_transcripts(segs(spark, "new", [("A Show", "2")]), at) == 1
    says = lambda: {r["name"]: r["text"].split("s - ")[1].split()[0] for r in readers.transcripts(spark, at).collect()}
    assert says() == {"A Show - Episode 1 - 2024-01-01.txt": "old", "A Show - Episode 2 - 2024-01-01.txt": "new", "A Show Too - Episode 1 - 2024-01-01.txt": "old"}
    readers.write_transcripts(segs(spark, "single", [("A Show", "1"), ("A Show", "3")]), at)
    for name in (f"A Show - Episode {i} - 2024-01-01.txt" for i in (1, 3)):
        os.utime(f"{at}/{name}", (4_000_000_000, 4_000_000_000))
    assert says() == {"A Show - Episode 1 - 2024-01-01.txt": "single", "A Show - Episode 2 - 2024-01-01.txt": "new", "A Show - Episode 3 - 2024-01-01.txt": "single", "A Show Too - Episode 1 - 2024-01-01.txt": "old"}
    assert readers.listing(spark, at).count() == 4


def test_an_episode_with_two_titles_is_one_text(spark, tmp_path):
    both = segs(spark, "word", [("A Show", "1")]).withColumn("title", F.when(F.col("seq") < 6, "T").otherwise("U"))
    assert readers.pack_transcripts(both, str(tmp_path)) == 1
    row = readers.transcripts(spark, str(tmp_path)).first()
    assert row["title"] == "T" and row["text"].count("s - word") == 12


def test_names_that_are_no_files(spark, tmp_path):
    with pytest.raises(Exception, match="can't be a file's name"):
        readers.pack_transcripts(segs(spark, "word", [("A/B", "1")]), str(tmp_path))
    assert not readers._packs(spark, str(tmp_path))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
def test_a_volume_has_files_by_tasks_and_not_by_episodes(spark):
    at = queries_io.volume(spark, SF).removeprefix("file://")
    found = [f for _, _, names in os.walk(at) for f in names if f.endswith((".txt", ".parquet"))]
    episodes = queries_io.conversation_segments(spark, SF).select("episode_number").distinct().count()
    assert episodes >= 10 and len(found) <= 4 and readers.listing(spark, at).count() == episodes


def values(spark, *ids):
    return spark.createDataFrame([(f"e{i}-0", i) for i in ids], "id string, value int")


def test_an_overtaken_merge_starts_again(spark, tmp_path, monkeypatch):
    a, b = (store.Collection(spark, f"file://{tmp_path}", "c", buckets=2, wait_s=30) for _ in "ab")
    a.merge(values(spark, 0))
    put, came = a._put, []

    def overtaken(*args, **more):
        if not came:
            came.append(b.files.remove("LOCK"))
            b.merge(values(spark, 1))
        put(*args, **more)

    monkeypatch.setattr(a, "_put", overtaken)
    a.merge(values(spark, 2))
    assert came and {r["value"] for r in a.read().collect()} == {0, 1, 2}


def test_writers_that_begin_at_once_wait_for_each_other(spark, tmp_path):
    of = [store.Collection(spark, f"file://{tmp_path}", "c", buckets=2, wait_s=60) for _ in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: of[i].merge(values(spark, i)), range(6)))
    assert {r["value"] for r in of[0].read().collect()} == set(range(6))
