"""Plans, audits, snapshots, exports, readers and the stream."""

import json
import threading
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from talkmill.operators import migrate, reconcile, sampling
from talkmill.operators.search import search, where
from talkmill.plans import planning
from talkmill.sources import readers, store
from talkmill.streaming.ingest import ingest_available

KEY = ["show", "episode_number", "date"]


@pytest.mark.parametrize(
    "over, expected",
    [
        ({}, "SKIP"),
        ({"excluded": True}, "EXCLUDE"),
        ({"excluded": True, "exists": False}, "EXCLUDE"),
        ({"exists": False}, "TRANSCRIBE"),
        ({"exists": False, "parses": False}, "TRANSCRIBE"),
        ({"parses": False}, "UNPARSEABLE"),
        ({"complete": False}, "EMBED_ONLY"),
        ({"complete": False, "identity": "0@1"}, "EMBED_ONLY"),
        ({"rules": "0"}, "EMBED_ONLY"),
        ({"rules": None}, "EMBED_ONLY"),
        ({"identity": "0@1"}, "IDENTIFY_ONLY"),
        ({"identity": None}, "IDENTIFY_ONLY"),
    ],
)
def test_decide(spark, over, expected):
    base = {"excluded": False, "exists": True, "parses": True, "complete": True, "rules": "1", "identity": "1@1"} | over
    args = {k: F.lit(v).cast("string" if k in ("rules", "identity") else "boolean") for k, v in base.items()}
    assert spark.range(1).select(planning.decide(**args, current_rules="1", current_identity="1@1").alias("a")).first()["a"] == expected


def test_cap_and_guard(spark):
    df = spark.createDataFrame([("s", i) for i in range(11)], "show string, feed_pos int")
    got = planning.cap_work(df, 3).orderBy("feed_pos").collect()
    assert [(r["feed_pos"], r["left_over"]) for r in got] == [(0, 8), (1, 8), (2, 8)] and planning.cap_work(df, 0).collect() == []
    assert planning.guard(df).where("not refused").count() == 0 and planning.guard(df.where("feed_pos < 10")).where("not refused").count() == 10


@pytest.mark.parametrize("n, expect, ok", [(3, 3, True), (0, 0, True), (3, -1, False), (0, -1, False), (3, 2, False)])
def test_gate(n, expect, ok):
    if ok:
        planning.require_expected(n, expect)
    else:
        with pytest.raises(planning.Refused):
            planning.require_expected(n, expect)


@pytest.mark.parametrize("indices, n, ok", [([0, 1, 2], 3, True), ([0, 1, 2, 3], 3, False), ([0, 2], 2, False), ([5, 6], 2, False), (["x"], 1, False), ([0, 0, 1], 2, True), ([0], None, False)])
def test_complete(spark, indices, n, ok):
    df = spark.createDataFrame([("S", "1", "d", f"p-{i}", 3) for i in indices], "show string, episode_number string, date string, id string, n_chunks int")
    got = reconcile.completeness(df).select(reconcile.is_complete(F.lit(n).cast("int")).alias("ok"))
    assert got.first()["ok"] == ok


REC = "show string, episode_number string, date string, id string, n_chunks int, source string, episode_guid string"


def rec(show, number, date, index, n=None, source=None, guid=None, prefix=None):
    return (show, number, date, f"{prefix or f'{show}-ep{number}-{date}'}-{index}".replace(" ", "_"), n, source, guid)


def audit(spark, volume, records, feed, excluded=()):
    of = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    triple = "show string, episode_number string, date string"
    found = reconcile.report(of(volume, triple), of(records, REC), of(feed, triple), of(excluded, triple + ", guid string"))
    return {(r["fault_class"], r["episode_number"] or r["prefix"]) for r in found.collect()}, reconcile.is_clean(found).first()["is_clean"]


BOOK = rec("GC", "N/A", "2021-01-01", 0, source="book")


@pytest.mark.parametrize(
    "volume, records, feed, excluded, faults, clean",
    [
        ([("GC", "1", "d")], [rec("GC", "1", "d", 0, 1), BOOK], [("GC", "1", "d")], [], set(), True),
        ([("GC", "1", "d")], [rec("GC", "1", "d", 0, 1)], [], [], {("feed_unreachable", "1")}, True),
        ([("GC", "1", "d")], [BOOK], [("GC", "1", "d")], [], {("missing", "1")}, False),
        ([("GC", "1", "d")], [BOOK], [("GC", "1", "d")], [("GC", "1", "d", None)], set(), True),
        ([], [rec("GC", "2", "d", 0, 1)], [], [], {("extra", "2")}, False),
        ([], [rec("GC", "9", "d", 0, 1, guid="g")], [], [("GC", "Unknown", "d", "g")], {("excluded_with_records", "9")}, False),
        ([("GC", "1", "d")], [rec("GC", "1", "d", 0, 2)], [("GC", "1", "d")], [], {("incomplete", "1")}, False),
        ([("GC", "1", "d")], [rec("GC", "1", "d", 1)], [("GC", "1", "d")], [], {("non_contiguous", "1")}, False),
    ],
)
def test_audit(spark, volume, records, feed, excluded, faults, clean):
    assert audit(spark, volume, records, feed, excluded) == (faults, clean)


def test_shared_prefix(spark):
    got, clean = audit(spark, [("GC", "1", "d"), ("GC", "1", "e")], [rec("GC", "1", "d", 0, prefix="p"), rec("GC", "1", "e", 0, prefix="p")], [("GC", "1", "d"), ("GC", "1", "e")])
    assert got == {("shared_prefixes", "p")} and not clean


CHUNK = "id string, document string, show string, episode_number string, date string, episode_guid string, source string, embedding array<float>"


def chunks(spark, n, number="1", date="d", guid=None, show="S", mark="x"):
    return spark.createDataFrame([(f"{show}-ep{number}-{date}-{i}", f"{mark}{i}", show, number, date, guid, None, [float(i), 1.0]) for i in range(n)], CHUNK)


def test_write_and_prune(spark, tmp_path):
    c = store.Collection(spark, f"file://{tmp_path}", "c")
    with pytest.raises(LookupError):
        c.read()
    with pytest.raises(ValueError):
        store.Collection(spark, str(tmp_path), "other", allowed=("c",))
    assert store.upsert_then_prune(c, chunks(spark, 43)) == {"written": 43, "pruned": 0}
    assert store.upsert_then_prune(c, chunks(spark, 30, mark="y")) == {"written": 30, "pruned": 13}
    assert c.count() == 30 and {r["document"][0] for r in c.read().collect()} == {"y"}
    # a guid finds records under another number, within the show; books and other shows stay
    book = spark.createDataFrame([("S-p1-0", "b", "S", "1", "d", "g", "book", [0.0, 1.0])], CHUNK)
    c.replace(c.read().unionByName(book).unionByName(chunks(spark, 5, number="7", guid="g")).unionByName(chunks(spark, 2, show="T", guid="g")))
    assert store.upsert_then_prune(c, chunks(spark, 4, guid="g")) == {"written": 4, "pruned": 31}
    assert sorted({r["show"] + (r["source"] or "") for r in c.read().collect()}) == ["S", "Sbook", "T"]


def test_merge_adds_and_never_removes(spark):
    old = spark.createDataFrame([("a", "1", "x"), ("b", "2", None)], "id string, u string, v string")
    new = spark.createDataFrame([("a", None, "y"), ("c", "3", None)], "id string, u string, w string")
    got = {r["id"]: (r["u"], r["v"], r["w"]) for r in store.merged(old, new).collect()}
    assert got == {"a": ("1", "x", "y"), "b": ("2", None, None), "c": ("3", None, None)}


def test_gated_updates(spark, tmp_path):
    c = store.Collection(spark, f"file://{tmp_path}", "c")
    c.replace(chunks(spark, 5))
    ups = c.read().limit(2).select("id", F.lit("book").alias("source"))
    with pytest.raises(planning.Refused):
        store.apply_updates(c, ups, 3)
    assert store.apply_updates(c, ups, 2) == 2 and c.read().where("source = 'book'").count() == 2


def test_export_restore_and_copy(spark, tmp_path):
    root = f"file://{tmp_path}"
    c = store.Collection(spark, root, "c")
    c.replace(chunks(spark, 50), {"space": "cosine"})
    names = [store.backup(c, f"{root}/backups", keep=2, name=f"b{i}") for i in range(3)][-1]
    assert names == ["b1", "b2"]
    manifest = store.verify_export(spark, f"{root}/backups/b2")
    assert (manifest["count"], manifest["dimension"], store.distance_space(manifest)) == (50, 2, "cosine")
    back = store.Collection(spark, root, "back")
    assert store.restore_into(back, f"{root}/backups/b2") == 50
    assert migrate.validate(c.read().withColumn("metadata", F.create_map(F.lit("show"), "show")), back.read().withColumn("metadata", F.create_map(F.lit("show"), "show"))).collect() == []
    with pytest.raises(planning.Refused):
        store.restore_into(back, f"{root}/backups/b2")
    spark.read.parquet(f"{root}/backups/b1/vectors").limit(49).write.mode("append").parquet(f"{root}/backups/b1/vectors")
    with pytest.raises(planning.Refused):
        store.verify_export(spark, f"{root}/backups/b1")
    assert store.copy_collection(c, store.Collection(spark, root, "copy")) == 50
    with pytest.raises(planning.Refused):
        store.copy_collection(c, back)
    assert {r["name"]: r["records"] for r in store.summary(spark, root).collect()} == {"c": 50, "back": 50, "copy": 50}
    with pytest.raises(ValueError):
        store.distance_space({})


def test_validate_tolerance_follows_the_copy(spark):
    row = lambda x: spark.createDataFrame([("a", "d", {"k": "v"}, [x])], "id string, document string, metadata map<string,string>, embedding array<double>")
    assert migrate.validate(row(100.0011), row(100.0), atol=1e-4).collect() == []
    assert [r["problem"] for r in migrate.validate(row(100.0012), row(100.0), atol=1e-4).collect()] == ["embedding"]


@pytest.mark.parametrize("id_, source, expected", [("GC-ep73-17", None, ("GC-ep73-2026-07-29-17", "remapped")), ("GC-ep73-2026-07-29-1", None, ("GC-ep73-2026-07-29-1", "remapped")), ("GC-p42-17", "book", ("GC-p42-17", "passthrough_non_episode")), ("other-ep73-1", None, ("other-ep73-1", "passthrough_unmatched")), ("loose", None, ("loose", "passthrough_non_episode"))])
def test_remap(spark, id_, source, expected):
    df = spark.createDataFrame([(id_, source, "GC", "73", "2026-07-29")], "id string, source string, show string, episode_number string, date string")
    r = migrate.remap_ids(df).first()
    assert (r["new_id"], r["classification"]) == expected


def test_rekey_refuses_strangers(spark):
    df = spark.createDataFrame([("S-ep1-d-0", "S", "1", "d"), ("T-ep1-d-0", "S", "1", "d")], "id string, show string, episode_number string, date string")
    with pytest.raises(Exception, match="re-key"):
        migrate.rekey(df, F.lit("2"), F.lit("1")).collect()
    assert migrate.rekey(df.where("id like 'S-%'"), F.lit("2"), F.lit("1")).first()["id"] == "S-ep2-d-0"


def test_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    assert df.where(where({"k": {"$eq": "a"}})).count() == 1 and df.where(where({"k": {"$ne": "a"}})).count() == 1 and df.where(where(None)).count() == 2
    with pytest.raises(ValueError):
        where({"k": {"$near": 1}})
    people = spark.createDataFrame([("p", "Ann")], "speaker_id string, display string")
    with pytest.raises(ValueError, match="Ann"):
        search(df, [1.0], speaker="Bob", people=people)


def test_log_resume(spark):
    plan = spark.createDataFrame([("e", "C", i, 10.0) for i in range(2)] + [("f", "C", 0, 10.0)], "episode string, cluster string, draw int, length_s double")
    rows = [("e", "C", 0, 10.0, "download", 1), ("e", "C", 1, 10.0, "crop", 2), ("f", "C", 0, 10.0, "download", 3), ("e", "C", 0, 10.0, None, 4)]
    log = spark.createDataFrame(rows, "episode string, cluster string, draw int, length_s double, error_kind string, seq int")
    assert [r["episode"] for r in planning.completed_episodes(log, plan).collect()] == ["e"]
    assert [(r["seq"], r["first_seq"]) for r in planning.dedupe_records(log).where("episode = 'e' and draw = 0").collect()] == [(4, 1)]


FEED = """<?xml version="1.0"?><rss xmlns:itunes="x"><channel>
<item><title>Ep 5 first</title><pubDate>Tue, 1 Oct 2024 23:30:00 -0700</pubDate><guid isPermaLink="false">g1</guid><enclosure url="http://a/1.mp3"/></item>
<item><title>no audio</title><pubDate>Wed, 2 Oct 2024 00:00:00 +0000</pubDate><guid>http://link</guid></item>
<item><title>Episode 7</title><itunes:episode>9</itunes:episode><pubDate>soon</pubDate><guid>http://link2</guid><link rel="enclosure" href="http://a/2.mp3"/><enclosure url="http://b/2.mp3"/></item>
</channel></rss>"""


def test_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(FEED)
    rows = readers.feed(spark, str(tmp_path / "feed.xml"), "S").orderBy("feed_pos").collect()
    assert [(r["episode_number"], r["date"], r["guid"], r["audio_url"]) for r in rows] == [("5", "2024-10-01", "g1", "http://a/1.mp3"), ("9", "Unknown Date", None, "http://a/2.mp3")]


def test_transcripts_round_trip(spark, tmp_path):
    segs = spark.createDataFrame([("A Show", "1", "T", "2024-01-01", i, "SPEAKER_00", i * 1.5, f"words {i}") for i in range(3)], "show string, episode_number string, title string, date string, seq int, speaker string, start double, text string")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "A Show - Episode 1 - 2024-01-01.txt").write_text("# A Show - Episode 1\n# T\n# Published: 2024-01-01\n\n[SPEAKER_00] 1.5s - words 1\n")
    (tmp_path / "in" / "notes.txt").write_text("nothing")
    t = readers.transcripts(spark, str(tmp_path / "in"))
    assert {(r["show"], r["year"], r["title"]) for r in t.collect()} == {("A Show", "2024", "T"), ("", "unparsed", "")}
    assert [tuple(r) for r in readers.listing(spark, str(tmp_path / "in")).collect()] == [("A Show", "1", "2024-01-01")]
    assert readers.episodes(t, 30.0)["turns"].count() == 1
    assert readers.write_transcripts(segs, str(tmp_path / "out")) == readers.write_transcripts(segs, str(tmp_path / "out"))
    text = (tmp_path / "out" / "A Show - Episode 1 - 2024-01-01.txt").read_text()
    assert text.startswith("# A Show - Episode 1\n# T\n# Published: 2024-01-01\n\n[SPEAKER_00] 0.0s - words 0\n")


def test_json_sources(spark, tmp_path):
    (tmp_path / "labels.json").write_text(json.dumps({"c1": {"person": "Ann", "basis": "voice"}, "c2": {"person": None, "basis": "skipped"}}))
    rows = readers.json_map(spark, str(tmp_path / "labels.json"), "struct<person:string,basis:string>", "clip_id").collect()
    assert {tuple(r) for r in rows} == {("c1", "Ann", "voice"), ("c2", None, "skipped")}
    (tmp_path / "log.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert [r["a"] for r in readers.log(spark, str(tmp_path / "log.jsonl"), "a int").orderBy("seq").collect()] == [1, 2]


@pytest.mark.parametrize("data, rate", [(b"\xff\xfb\x90\x00", 44100), (b"ID3\x04\x00\x00\x00\x00\x00\x05hello\xff\xfb\x94\x00", 48000), (b"\x00\xff\xf3\x98\x00", 16000), (b"\xff\xfb\x9c\x00", None), (b"", None), (None, None)])
def test_mpeg_rate(spark, data, rate):
    assert readers.mpeg_rate(data) == rate
    got = readers.audio_rates(spark.createDataFrame([(data,)], "content binary")).first()["rate"]
    assert got == rate


def test_book_pages_and_settings(spark):
    df = spark.createDataFrame([("b", "one\f \ftwo")], "book string, text string")
    assert [(r["page"], r["text"]) for r in readers.book_pages(df).collect()] == [(1, "one"), (3, "two")]
    with pytest.raises(KeyError, match="STORE_TOKEN"):
        readers.settings({"STORE_URL": "https://x"})
    with pytest.raises(ValueError):
        readers.settings({"STORE_URL": "http://far", "STORE_TOKEN": "t"})
    assert readers.settings({"STORE_URL": "http://localhost:1", "STORE_TOKEN": "t"})["url"]


def test_seams(spark):
    def head(u):
        return {"ok": 200, "shy": 405, "dead": 404}.get(u, 500)

    df = spark.createDataFrame([("ok",), ("shy",), ("dead",), ("odd",), (None,)], "audio_url string")
    got = {r["audio_url"]: r["verdict"] for r in readers.checked_urls(df, head, lambda u: 206).collect()}
    assert got == {"ok": "OK", "shy": "OK", "dead": "DEAD", "odd": "UNKNOWN", None: "ABSENT"}

    def embed(path, start, length):
        if path == "bad":
            raise ValueError("short")
        if path == "gone":
            raise OSError("no file")
        return [start, length]

    plan = spark.createDataFrame([("e", p, 1.0, 2.0) for p in ("fine", "bad", "gone")], "episode string, audio_path string, crop_start_s double, crop_length_s double")
    got = {r["audio_path"]: (r["vector"], r["error_kind"]) for r in readers.embedded_crops(plan, embed).collect()}
    assert got == {"fine": ([1.0, 2.0], None), "bad": (None, "crop"), "gone": (None, "download")}


def test_ledger_and_urls(spark):
    feed = spark.createDataFrame([("S", "1", "d", 0, "u0"), ("S", "1", "d", 1, "u1"), ("S", "2", "d", 2, None)], "show string, episode_number string, date string, feed_pos int, audio_url string")
    plan = spark.createDataFrame([("S", "1", "d")], ", ".join(f"{k} string" for k in KEY))
    assert sampling.resolved_urls(plan, feed).first()["audio_url"] == "u1"
    with pytest.raises(RuntimeError):
        sampling.resolved_urls(spark.createDataFrame([("S", "2", "d")], plan.schema), feed)


def test_stream_takes_what_is_new(spark, tmp_path):
    folder, root = tmp_path / "in", f"file://{tmp_path}"
    folder.mkdir()
    text = "# S - Episode {n}\n# T\n# Published: 2024-01-0{n}\n\n" + "\n".join(f"[SPEAKER_00] {i}.0s - some words here" for i in range(5))
    c = store.Collection(spark, root, "live")
    for n in (1, 2):
        (folder / f"S - Episode {n} - 2024-01-0{n}.txt").write_text(text.format(n=n))
        assert ingest_available(spark, str(folder), c, readers.hashed_encoder(8), f"{root}/ck") == 1
        assert c.count() == n
    assert ingest_available(spark, str(folder), c, readers.hashed_encoder(8), f"{root}/ck") == 0
    r = c.read().where("episode_number = '2'").first()
    assert (r["id"], r["date_ts"], r["n_chunks"], r["episode_title"], len(r["embedding"])) == ("S-ep2-2024-01-02-0", 20240102, 1, "T", 8)


def files_of(root):
    return {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_a_write_leaves_other_buckets_alone(spark, tmp_path):
    c = store.Collection(spark, f"file://{tmp_path}", "c", buckets=16)
    whole = chunks(spark, 5)
    for n in range(2, 30):
        whole = whole.unionByName(chunks(spark, 3, number=str(n)))
    c.replace(whole, {"space": "cosine"})
    before = files_of(tmp_path)
    assert len({p.parent.name for p in before}) > 8
    assert store.upsert_then_prune(c, chunks(spark, 3, mark="y").withColumn("note", F.lit("new"))) == {"written": 3, "pruned": 2}
    after = files_of(tmp_path)
    assert before.items() <= after.items() and len({p.parent for p in set(after) - set(before)}) == 1
    rows = c.read().collect()
    assert len(rows) == 3 + 28 * 3 and sum(r["note"] == "new" for r in rows) == 3 and c.metadata() == {"space": "cosine"}
    assert c.merge(drop=c.read().where("episode_number = '7'")) == 1 and c.count() == 3 + 27 * 3
    assert c.merge(chunks(spark, 0)) == 0


def test_old_files_go_after_a_while(spark, tmp_path):
    c = store.Collection(spark, f"file://{tmp_path}", "c", buckets=4)
    c.replace(chunks(spark, 3))
    held = c.read()
    c.replace(chunks(spark, 2, mark="y"))
    c.replace(chunks(spark, 2, mark="z"))
    assert held.count() == 3  # within the grace period
    c.merge(chunks(spark, 1, mark="w"), keep=1, grace_s=0)
    assert {p.parent.parent.name for p in files_of(tmp_path)} == set(c._manifest()["buckets"].values()) and [r["document"] for r in c.read().orderBy("id").collect()] == ["w0", "z1"]


def test_one_writer_at_a_time(spark, tmp_path):
    a, b = (store.Collection(spark, f"file://{tmp_path}", "c") for _ in range(2))
    a.replace(chunks(spark, 1))
    with a._writer(), pytest.raises(planning.Refused, match="being written"):
        b.replace(chunks(spark, 2))
    b.replace(chunks(spark, 2))
    a.files.claim("LOCK", "left-behind 0")
    a.replace(chunks(spark, 3))
    assert b.count() == 3 and a.files.read("LOCK") is None


def test_a_destination_is_made_like_its_source(spark, tmp_path):
    a, b = (store.Collection(spark, f"file://{tmp_path}", n) for n in "ab")
    a.replace(chunks(spark, 2))
    with pytest.raises(ValueError):
        store.create_destination(a, b)
    a.replace(chunks(spark, 2), {"space": "l2"})
    assert store.create_destination(a, b) == {"space": "l2"} and b.count() == 0 and b.read().schema == a.read().schema
    b.replace(b.read(), {"space": "ip"})
    assert store.create_destination(a, b) == {"space": "ip"} and store.copy_collection(a, b) == 2


def test_names_beyond_ten_thousand(spark):
    from talkmill.operators.search import rendered

    people = spark.range(12_000).select(F.concat(F.lit("p"), "id").alias("speaker_id"), F.concat(F.lit("Person "), "id").alias("display"))
    rows = spark.createDataFrame([(1, [1.0, 0.0], "S", "1", "T", "2024-01-01", 20240101, "SPEAKER_0", "p11999", 0.0, "x")], "id int, embedding array<double>, show string, episode_number string, episode_title string, date string, date_ts int, speaker string, speaker_id string, start_time double, document string")
    hits = search(rows, [1.0, 0.0], 5, people=people, speaker=None)
    assert "Person 11999" in rendered(hits, people).first()["text"]
    assert search(rows.withColumn("speaker_id", F.lit("Person 11999")), [1.0, 0.0], people=people, speaker="Person 11999").count() == 1
    with pytest.raises(ValueError, match="and more"):
        search(rows, [1.0, 0.0], people=people, speaker="nobody")


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as Fake

    from talkmill.session import shared_dir

    unset = Fake(isDefined=lambda: False)
    spark = lambda master: Fake(conf=Fake(get=lambda k, d: None), sparkContext=Fake(master=master, _jsc=Fake(sc=lambda: Fake(getCheckpointDir=lambda: unset)), setCheckpointDir=lambda at: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(spark("spark://host:7077"))
    assert shared_dir(spark("local[4]"))


@pytest.mark.parametrize("dim", [3, 128, 129, 1024])
def test_search_over_vectors_of_any_size(spark, dim):
    r = __import__("random").Random(dim)
    rows = [(i, [r.uniform(-1, 1) for _ in range(dim)]) for i in range(40)]
    query = [r.uniform(-1, 1) for _ in range(dim)]
    cosine = lambda v: sum(a * b for a, b in zip(v, query)) / (sum(a * a for a in v) * sum(b * b for b in query)) ** 0.5
    from talkmill.operators.search import nearest

    got = [x["id"] for x in nearest(spark.createDataFrame(rows, "id int, embedding array<double>"), query, 5).collect()]
    assert got == [i for i, _ in sorted(rows, key=lambda x: -cosine(x[1]))[:5]]


def _rows(spark, ids, value):
    return spark.createDataFrame([(f"e{i}-0", value) for i in ids], "id string, value string")


def test_two_writers_that_both_took_a_lock_for_left_behind(spark, tmp_path, monkeypatch):
    """Both get in, from the same records; the one that ends last is refused, and nothing of the first one's is lost."""
    a, b = (store.Collection(spark, f"file://{tmp_path}", "c", buckets=4) for _ in range(2))
    a.replace(_rows(spark, range(10), "old"))
    with b._writer() as base:
        b.files.remove("LOCK")  # as if it had been taken for left behind
        a.merge(_rows(spark, [1, 20], "a"))
        with pytest.raises(planning.Refused, match="meanwhile"):
            b._put(_rows(spark, range(5), "b"), base, None, None)
    got = {r["id"]: r["value"] for r in a.read().collect()}
    assert got == {f"e{i}-0": "a" if i in (1, 20) else "old" for i in [*range(10), 20]}
    assert len([n for n in a.files.names() if n.startswith("v-")]) == 2
    b.merge(_rows(spark, [2], "b"))
    assert a.read().where("value = 'b'").count() == 1


def test_a_write_that_broke_off_before_current_moved(spark, tmp_path, monkeypatch):
    c = store.Collection(spark, f"file://{tmp_path}", "c", buckets=2)
    c.replace(_rows(spark, range(3), "old"))
    write = c.files.write

    def breaks(name, text):
        if name == "CURRENT":
            raise OSError("gone")
        write(name, text)

    monkeypatch.setattr(c.files, "write", breaks)
    with pytest.raises(OSError):
        c.merge(_rows(spark, [1], "new"))
    again = store.Collection(spark, f"file://{tmp_path}", "c")
    assert again.read().where("value = 'new'").count() == 1 and again.count() == 3  # what was settled counts
    again.merge(_rows(spark, [2], "later"))
    assert {r["value"] for r in again.read().collect()} == {"old", "new", "later"}


def test_a_lock_is_renewed_and_waited_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store.Collection, "LOCK_S", 4)
    a, b = store.Collection(spark, f"file://{tmp_path}", "c"), store.Collection(spark, f"file://{tmp_path}", "c", wait_s=30)
    with a._writer():
        first = a.files.read("LOCK")
        time.sleep(5)
        assert a.files.read("LOCK") != first
        with pytest.raises(planning.Refused):
            store.Collection(spark, f"file://{tmp_path}", "c").replace(_rows(spark, [1], "x"))
        waiting = threading.Thread(target=lambda: b.replace(_rows(spark, [1], "waited")))
        waiting.start()
        time.sleep(1)
        assert not a.exists()
    waiting.join()
    assert a.read().first()["value"] == "waited" and a.files.read("LOCK") is None


def test_buckets_change_when_all_is_replaced(spark, tmp_path):
    store.Collection(spark, f"file://{tmp_path}", "c", buckets=2).replace(_rows(spark, range(40), "x"))
    more = store.Collection(spark, f"file://{tmp_path}", "c", buckets=16)
    more.merge(_rows(spark, [3], "y"))
    assert more._manifest()["of"] == 2
    more.replace(more.read())
    assert more._manifest()["of"] == 16 and len(more._manifest()["buckets"]) > 2 and more.count() == 40
    assert more.merge(_rows(spark, [3], "z")) == 1 and more.read().where("value = 'z'").count() == 1


def test_a_lookup_reads_little(spark, tmp_path):
    c = store.Collection(spark, f"file://{tmp_path}", "c", buckets=64)
    c.replace(spark.range(64_000).selectExpr("concat('e', id % 6400, '-', id) as id", "repeat(cast(id as string), 20) as document"))
    ids = [f"e{i}-{i}" for i in range(0, 50, 5)] + ["e1-none"]
    found = c.lookup(ids)
    assert sorted(r["id"] for r in found.collect()) == sorted(ids[:-1])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(id" in plan
    scanned = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "FileSourceScanExec":
            scanned.append((node.metrics().apply("numFiles").value(), node.metrics().apply("numOutputRows").value()))
        inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
        for child in inner or [node.children().apply(i) for i in range(node.children().size())]:
            walk(child)

    found._jdf.collectToPython()
    walk(found._jdf.queryExecution().executedPlan())
    assert scanned and sum(files for files, _ in scanned) <= 11 and sum(rows for _, rows in scanned) < 0.2 * 64_000
    (footer,) = {f for p in tmp_path.rglob("*.parquet") for f in [pq.ParquetFile(p).metadata.row_group(0).column(0).path_in_schema]}
    assert footer == "id"
    names = [pq.read_table(p, columns=["id"]).column(0).to_pylist() for p in tmp_path.rglob("*.parquet")]
    assert all(n == sorted(n) for n in names)
    with pytest.raises(LookupError):
        store.Collection(spark, f"file://{tmp_path}", "none").lookup(["x"])
