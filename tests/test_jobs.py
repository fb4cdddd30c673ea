"""Jobs from end to end over small collections."""

import threading

import pytest
from pyspark.sql import functions as F

from talkmill.operators import migrate
from talkmill.plans import jobs
from talkmill.plans.planning import Refused
from talkmill.sources import readers, store

ENCODE = readers.hashed_encoder(8)
KEY = "show string, episode_number string, date string"


def write(folder, n, lines):
    body = "\n".join(f"[SPEAKER_0{i % 2}] {i * 20}.0s - words of line {i}" for i in range(lines))
    (folder / f"S - Episode {n} - 2024-01-0{n}.txt").write_text(f"# S - Episode {n}\n# T{n}\n# Published: 2024-01-0{n}\n\n{body}\n")


@pytest.fixture
def show(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in (1, 2):
        write(folder, n, 4)
    c = store.Collection(spark, f"file://{tmp_path}", "c")
    jobs.bulk_embed(spark, str(folder), "S", c, ENCODE)
    return folder, c


def test_bulk_embed_takes_what_is_new_and_carries_names(spark, show):
    folder, c = show
    assert c.count() == 8 and jobs.bulk_embed(spark, str(folder), "S", c, ENCODE) == {"written": 0, "pruned": 0}
    assigned = spark.createDataFrame([("S", "1", "2024-01-01", "SPEAKER_00", "Ann")], KEY + ", cluster string, person string")
    assert [tuple(r) for r in jobs.backfill(c, assigned, 2).collect()] == [("Ann", 2)]
    with pytest.raises(Refused):
        jobs.stamp(c, assigned, 3)
    assert jobs.stamp(c, assigned, 4) == (4, 8)
    write(folder, 1, 3)
    assert jobs.bulk_embed(spark, str(folder), "S", c, ENCODE) == {"written": 3, "pruned": 1}
    rows = c.read().where("episode_number = '1'").collect()
    assert {(r["speaker"], r["speaker_id"], r["identity_version"]) for r in rows} == {("SPEAKER_00", "Ann", "1@1"), ("SPEAKER_01", None, "1@1")}


def test_a_night_is_planned_for_all_shows(spark, show):
    folder, c = show
    feed = spark.createDataFrame([("S", 0, "1", "2024-01-01", "g1"), ("S", 1, "2", "2024-01-02", "g2"), ("S", 2, "3", "2024-01-03", "g3")], "show string, feed_pos int, episode_number string, date string, guid string")
    exc = spark.createDataFrame([("S", "x", "y", "g2")], KEY + ", guid string")
    got = jobs.plan_all(feed, readers.transcripts(spark, str(folder)), c.read(), exc, cap=5)
    assert {r["episode_number"]: r["action"] for r in got["plan"].collect()} == {"1": "IDENTIFY_ONLY", "2": "EXCLUDE", "3": "TRANSCRIBE"}
    assert got["transcribe"].count() == 1 and got["identify"].count() == 1 and got["refused"].count() == 0
    assert jobs.plan_all(feed, readers.transcripts(spark, str(folder)), c.read(), exc, threshold=0)["refused"].first()["n"] == 1


def test_books_are_never_pruned(spark, show):
    folder, c = show
    pages = spark.createDataFrame([(1, "some words"), (2, "more words")], "page int, text string")
    assert jobs.upload_book(c, pages, ENCODE, title="S", author="A", date="2024-01-01") == 1
    write(folder, 1, 2)
    jobs.bulk_embed(spark, str(folder), "S", c, ENCODE)
    assert c.read().where("source = 'book'").count() == 1


def test_renumber(spark, show):
    _, c = show
    c.replace(c.read().withColumn("episode_guid", F.concat(F.lit("g"), "episode_number")))
    feed = spark.createDataFrame([("S", "101", "2024-01-01", "g1"), ("S", "2", "2024-01-02", "g2")], KEY + ", guid string")
    volume = spark.createDataFrame([("S", "1", "2024-01-01"), ("S", "2", "2024-01-02"), ("S", "9", "2020-01-01")], KEY)
    stored = c.read().select("show", "episode_number", "date", F.col("episode_guid").alias("guid")).distinct()
    none = spark.createDataFrame([], KEY + ", guid string")
    v = migrate.renumber_verdicts(feed, volume, stored, none)
    lost = migrate.orphans(feed, volume, stored, none, v)
    assert [r["episode_number"] for r in lost.collect()] == ["9"]
    with pytest.raises(Refused):
        jobs.apply_renumber(c, v, lost, expect_renames=1, expect_orphans=0)
    assert jobs.apply_renumber(c, v, lost, expect_renames=1, expect_orphans=1) == 1
    assert {r["id"].rsplit("-", 1)[0] for r in c.read().collect()} == {"S-ep101-2024-01-01", "S-ep2-2024-01-02"}
    assert [r["prefix"] for r in jobs.old_prefixes(v).collect()] == ["S-ep1-2024-01-01"]


def test_identify(spark):
    rows = [("e", i, f"SPEAKER_0{i // 2 % 2}", i * 25.0, "x") for i in range(9)] + [("e", 9, "UNKNOWN", None, "x")]
    segs = spark.createDataFrame(rows, "episode string, seq int, speaker string, start double, text string")
    audio = spark.createDataFrame([("e", "path")], "episode string, audio_path string")
    people = spark.createDataFrame([("Ann", [1.0, 0.0]), ("Bob", [0.0, 1.0])], "person string, centroid array<double>")

    def embed(path, start, length):
        return [1.0, 0.1] if start // 50 % 2 == 0 else [0.5, 0.5]

    got = jobs.identify_clusters(segs, audio, embed, people, threshold=0.516, margin=0.074)
    assert [tuple(r) for r in got.collect()] == [("e", "SPEAKER_00", "Ann")]


def test_a_failing_show_doesnt_stop_the_others(spark, show):
    folder, c = show
    feed = spark.createDataFrame([("S", 0, "1", "2024-01-01", "g1"), ("S", 1, "3", "2024-01-03", "g3"), ("T", 0, "1", "2024-01-01", "h1")], "show string, feed_pos int, episode_number string, date string, guid string")
    none = spark.createDataFrame([], KEY + ", guid string")
    write(folder, 3, 5)
    run = lambda s: jobs.run_show(spark, s, str(folder), feed, c, none, ENCODE, threshold=0)
    ran = []
    with pytest.raises(ExceptionGroup, match="1 of 2 shows failed: T") as e:
        jobs.nightly(["T", "S"], lambda s: ran.append(s) or run(s))
    assert sorted(ran) == ["S", "T"] and isinstance(e.value.exceptions[0], Refused)
    assert c.read().where("episode_number = '3'").count() == 5
    assert jobs.nightly(["S"], run) == {"S": {"IDENTIFY_ONLY": 2, "written": 0, "pruned": 0}}


def test_shows_run_side_by_side(spark):
    """Each waits for all others, which only ends if none waits for its turn; each has a pool of its own and what its caller set."""
    together, seen = threading.Barrier(3, timeout=60), {}
    spark.sparkContext.setLocalProperty("talkmill.night", "7")

    def run(show):
        together.wait()
        get = spark.sparkContext.getLocalProperty
        seen[show] = (get("spark.scheduler.pool"), get("talkmill.night"), spark.range(1000).where("id % 2 = 0").count())
        if show == "b":
            raise ValueError("b is broken")
        return {"show": show}

    with pytest.raises(ExceptionGroup, match="1 of 3 shows failed: b") as e:
        jobs.nightly(["a", "b", "c"], run, at_once=3)
    assert [str(x) for x in e.value.exceptions] == ["b is broken"]
    assert seen == {s: (s, "7", 500) for s in "abc"} and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    slow = threading.Event()
    order = []

    def turn(show):
        if show == "slow":
            assert slow.wait(60)
        order.append(show)
        if len(order) == 4:
            slow.set()
        return {}

    assert list(jobs.nightly(["slow", "w", "x", "y", "z"], turn, at_once=2)) == ["slow", "w", "x", "y", "z"] and order[-1] == "slow"
    spark.sparkContext.setLocalProperty("talkmill.night", None)
