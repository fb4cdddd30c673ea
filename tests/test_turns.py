"""Turns, shares, crops, chunks: figures worked out by hand, and an independent fold for chunks."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talkmill.operators import chunking, sampling, stats, turns

ROWS = [("e", 0, "SPEAKER_00", 0.0, "one two"), ("e", 1, "SPEAKER_00", 10.0, "three"), ("e", 2, "SPEAKER_01", 15.0, "four five six"), ("e", 3, "SPEAKER_00", 20.0, "seven")]
SEG = "episode string, seq int, speaker string, start double, text string"
TURN = "episode string, turn_idx long, speaker string, start double, duration_s double, n_words long"


def frame(spark, rows, schema=SEG):
    return spark.createDataFrame(rows, schema)


def test_turns(spark):
    got = turns.merge_turns(frame(spark, ROWS), 30.0).orderBy("turn_idx").collect()
    assert [(r["speaker"], r["start"], r["duration_s"], r["n_words"], r["n_segments"]) for r in got] == [("SPEAKER_00", 0, 15, 3, 2), ("SPEAKER_01", 15, 5, 3, 1), ("SPEAKER_00", 20, 0, 1, 1)]


@pytest.mark.parametrize("cap, seconds", [(30.0, 40.0), (float("inf"), 610.0)])
def test_gap_cap(spark, cap, seconds):
    rows = [("e", i, "A", float(s), "x") for i, s in enumerate((0, 600, 610))]
    assert turns.merge_turns(frame(spark, rows), cap).first()["duration_s"] == seconds


def test_backward_starts(spark):
    df = frame(spark, [("e", i, "A", float(s), "x") for i, s in enumerate((100, 40, 50))])
    assert turns.merge_turns(df, 30.0).first()["duration_s"] == 10.0
    assert turns.non_monotonic(df).first()["non_monotonic"] == 1
    assert turns.merge_turns(df.limit(0), 30.0).collect() == []


def test_shares(spark):
    rows = [("e", 0, "A", 0.0, 60.0, 100), ("e", 1, "B", 60.0, 30.0, 50), ("e", 2, "C", 90.0, 10.0, 20), ("e", 3, "A", 100.0, 1.0, 2), ("short", 0, "A", 0.0, 1.0, 2)]
    got = {r["episode"]: r for r in turns.speech_shares(frame(spark, rows, TURN), 1.5).collect()}
    e = got["e"]
    assert (e["total_s"], e["total_words"], e["n_speakers"], e["n_turns"], e["dominant"]) == (100, 170, 3, 3, "A")
    assert (e["top1_s_share"], e["top2_s_share"]) == (0.6, 0.9) and abs(e["top1_words_share"] - 100 / 170) < 1e-12
    assert got["short"]["total_s"] == 0 and got["short"]["top1_s_share"] == 0 and got["short"]["dominant"] is None


CROPS = [("e", i, s, float(a), float(n), w) for i, (s, a, n, w) in enumerate([("SPEAKER_00", 0, 40, 100), ("SPEAKER_00", 100, 15, 40), ("SPEAKER_00", 200, 60, 150), ("SPEAKER_00", 300, 5, 10), ("SPEAKER_01", 400, 90, 200), ("UNKNOWN", 500, 80, 180)])]


def test_crops(spark):
    df = frame(spark, CROPS, TURN)
    top = turns.longest_turns(df.where("speaker = 'SPEAKER_00'")).orderBy("draw").collect()
    assert [r["duration_s"] for r in top] == [60, 40, 15]
    plan = turns.crop_plan(df).collect()
    assert len(plan) == 8 and {r["cluster"] for r in plan} == {"SPEAKER_00", "SPEAKER_01"}
    assert all(r["crop_start_s"] + r["crop_length_s"] <= r["turn_start"] + r["turn_duration_s"] for r in plan)
    assert turns.longest_turns(df, min_turn_s=120.0).collect() == []


def test_draws_dont_repeat(spark):
    df = frame(spark, CROPS, TURN).where("speaker = 'SPEAKER_00'")
    first = [turns.drawn_turn(df, "seed", i).first()["turn_idx"] for i in range(6)]
    assert sorted(first[:3]) == [0, 1, 2] and first[3:] == first[:3]


def made_rows(df):
    """How many rows each operator of the plan that ran has made."""
    execution, out = df._jdf.queryExecution(), []
    df._jdf.collectToPython()

    def walk(node):
        shown = node.metrics().get("numOutputRows")
        out.extend([shown.get().value()] if shown.isDefined() else [])
        kind = node.getClass().getSimpleName()
        inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
        for child in inner or [node.children().apply(i) for i in range(node.children().size())]:
            walk(child)

    walk(execution.executedPlan())
    return out


def test_speaker_at(spark):
    t = frame(spark, [("e", 0, "A", 0.0, 10.0, 1), ("e", 1, "B", 5.0, 10.0, 1)], TURN)
    p = spark.createDataFrame([("e", 0, 5.0), ("e", 1, 10.0), ("e", 2, 15.0), ("x", 3, 1.0)], "episode string, id int, t double")
    assert {r["id"]: r["speaker_at"] for r in turns.speaker_at(p, t).collect()} == {0: "A", 1: "B", 2: None, 3: None}


def test_speaker_at_beside_asking_every_turn(spark, monkeypatch):
    """Overlaps, gaps, turns of no length, starts that go back, several keys, stretches shorter than turns."""
    monkeypatch.setattr(turns, "STRETCH_S", 7.0)
    r = random.Random(5)
    given = [(e, y, i, r.choice(["A", "B", "C", None]), float(r.randint(-20, 80)), float(r.choice([0, 1, 3, 9, 40, -2]))) for e in "ef" for y in (1, 2) for i in r.sample(range(60), 40)]
    asked = [(r.choice(["e", "f", "g", None]), r.choice([1, 2]), n, r.choice([None, float("nan"), r.randint(-30, 130) / 2])) for n in range(400)] + [("e", 1, 0, 5.0)] * 3
    t = spark.createDataFrame(given, "episode string, year int, turn_idx int, speaker string, start double, duration_s double")
    p = spark.createDataFrame(asked, "episode string, year int, turn_idx int, at double")
    first = lambda e, y, x: next((s for _, k, _, s, b, d in sorted(((0, (g, h), i, s, b, d) for g, h, i, s, b, d in given if (g, h) == (e, y) and x is not None and b <= x < b + d), key=lambda v: v[2])), None)
    got = turns.speaker_at(p, t, "at", ("episode", "year"))
    assert got.columns == ["episode", "year", "turn_idx", "at", "speaker_at"]
    assert Counter((x["episode"], x["year"], x["turn_idx"], str(x["at"]), x["speaker_at"]) for x in got.collect()) == Counter((e, y, n, str(x), first(e, y, x)) for e, y, n, x in asked)
    assert turns.speaker_at(p.limit(0), t, "at", ("episode", "year")).collect() == [] and turns.speaker_at(p, t.limit(0), "at", ("episode", "year")).where("speaker_at is not null").isEmpty()


def test_rows_of_speaker_at_grow_with_points_and_turns(spark):
    """One episode of 20,000 turns and as many points, with a turn over all of it."""
    t = spark.range(20_000).selectExpr("'e' as episode", "id as turn_idx", "concat('s', id % 7) as speaker", "id * 10.0D as start", "10.0D as duration_s").union(spark.sql("select 'e', 20000L, 'all', 0.0D, 250000.0D"))
    p = spark.range(20_000).selectExpr("'e' as episode", "id", "id * 12.0D + 1 as t")
    got = turns.speaker_at(p, t)
    assert got.groupBy((F.col("t") < 200_000).alias("early"), (F.col("speaker_at") == "all").alias("whole")).count().collect().__len__() == 2
    assert got.where("t < 200000 and speaker_at != concat('s', floor(t / 10) % 7)").isEmpty()
    rows = made_rows(got)
    assert 20_000 < max(rows) < 110_000, rows


def fold(segments):
    """Chunks by a plain walk."""
    out, speaker, held, start = [], None, [], 0.0
    for s, at, text in segments:
        words = text.split()
        if s != speaker and held:
            out.append((speaker, start, held))
            held, start = held[-50:], at
        if not held:
            start = at
        speaker, held = s, held + words
        while len(held) >= 400:
            out.append((speaker, start, held[:400]))
            held, start = held[-50:], at
    return out + ([(speaker, start, held)] if held else [])


@pytest.mark.parametrize("sizes, expected", [([1000], [400, 50]), ([300, 300], [400, 50]), ([399], [399]), ([400], [400, 50]), ([450], [400, 50]), ([0], []), ([], [])])
def test_chunk_sizes(spark, sizes, expected):
    df = frame(spark, [("e", i, "A", float(i), " ".join(f"w{k}" for k in range(n))) for i, n in enumerate(sizes)] or [], SEG)
    assert [r["n_words"] for r in chunking.build_chunks(df).orderBy("chunk_index").collect()] == expected


def test_chunks_equal_a_plain_walk(spark):
    r = random.Random(5)
    rows, want = [], {}
    for e in range(40):
        segs = [(r.choice("AB"), float(i * 3), " ".join(f"{e}.{i}.{k}" for k in range(r.choice((0, 1, 30, 120, 399, 400, 700))))) for i in range(r.randrange(14))]
        rows += [(f"e{e}", i, *s) for i, s in enumerate(segs)]
        want[f"e{e}"] = [(s, at, f"[{s}] " + " ".join(w)) for s, at, w in fold(segs)]
    for build in (chunking.build_chunks, chunking.build_chunks_streamed, chunking.fold_chunks):
        got = {}
        for x in build(frame(spark, rows)).orderBy("episode", "chunk_index").collect():
            got.setdefault(x["episode"], []).append((x["speaker"], x["start_time"], x["text"]))
        assert got == {k: v for k, v in want.items() if v}


def test_folded_counts_and_odd_segments(spark):
    rows = [("e", 1, None, None, "a b"), ("e", 2, "B", 2.0, "  "), ("e", 3, "A", 3.0, None), ("f", 0, "A", 0.0, ""), (None, 0, "A", 1.0, "x\u00a0y\x1cz"), (None, 1, "A", 2.0, "w " * 900)]
    df = frame(spark, rows)
    by = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert by(chunking.fold_chunks(df)) == by(chunking.build_chunks(df).select("episode", "chunk_index", "n_chunks", "speaker", "start_time", "text", "n_words"))
    assert by(chunking.fold_counts(df)) == by(chunking.expected_chunks(df))
    assert chunking.fold_chunks(df.limit(0)).collect() == [] and chunking.fold_counts(df.where("episode = 'f'")).collect() == []
    two = df.withColumn("show", F.lit(1))
    assert by(chunking.fold_chunks(two, ("show", "episode"), max_words=5, overlap=0)) == by(chunking.build_chunks(two, ("show", "episode"), max_words=5, overlap=0).select("show", "episode", "chunk_index", "n_chunks", "speaker", "start_time", "text", "n_words"))


def test_an_episode_of_a_million_segments(spark):
    """Its chunks come from a worker that keeps to itself what little it holds."""
    n = 1_000_000
    df = spark.range(n).selectExpr("'e' as episode", "id as seq", "concat('s', floor(id / 1000) % 5) as speaker", "id * 1.0D as start", "concat('w', id, ' v', id) as text")
    chunks = chunking.fold_chunks(df).agg(F.count("*").alias("n"), F.max("n_chunks").alias("said"), F.sum("n_words").alias("words"), F.max("chunk_index").alias("last")).first()
    # a speaker's 2000 words, and the 50 that come over: a full chunk of 400 takes 350 new ones
    assert chunks["n"] == chunks["said"] == chunks["last"] + 1 == chunking.fold_counts(df).first()["n_chunks"]
    assert chunks["words"] == 2 * n + 50 * (chunks["n"] - 1)
    held = []
    batches = (pa.RecordBatch.from_pydict({"episode": ["e"] * 1000, "seq": list(range(i, i + 1000)), "speaker": ["s"] * 1000, "start": [0.0] * 1000, "text": ["one two three"] * 1000}) for i in range(0, 20_000, 1000))
    for found in chunking._closed(batches, 1, 400, 50):
        held.append(len(found))
    assert max(held) <= 3000 / 350 + 1


def test_book_windows(spark):
    pages = spark.createDataFrame([("b", 1, " ".join(f"a{i}" for i in range(380))), ("b", 2, " "), ("b", 3, " ".join(f"c{i}" for i in range(30)))], "book string, page int, text string")
    got = chunking.book_chunks(pages).orderBy("chunk_index").collect()
    assert [(r["page"], r["n_words"]) for r in got] == [(1, 400), (1, 60)] and got[1]["text"].startswith("a350 ")


def test_percentiles_are_not_interpolated(spark):
    df = frame(spark, [("e", i, "A", float(s), "x") for i, s in enumerate((0, 1, 3, 6, 10))])
    r = stats.gap_percentiles(df).first()
    assert (r["gaps"], r["p50"], r["p99"], r["max_gap"]) == (4, 3.0, 4.0, 4.0)


@pytest.mark.parametrize("count, target", [(295, 150), (3, 10), (0, 5), (10, 0), (7, 7), (100, 33), (11, 10)])
def test_evenly_spaced(spark, count, target):
    df = spark.range(count).select(F.col("id"))
    want = list(range(count)) if target >= count and target > 0 else [int(i * (count / target)) for i in range(target)] if target > 0 and count else []
    assert sorted(r["index"] for r in sampling.evenly_spaced(df, ["id"], target).collect()) == want


@pytest.mark.parametrize("picks, count, gone, chosen", [([0, 2, 4], 10, [2], [0, 3, 4]), ([2, 3], 10, [2], [3, 4]), ([0], 10, [0, 1, 2], [3]), ([9], 10, [9], [])])
def test_substitutes(spark, picks, count, gone, chosen):
    df = spark.createDataFrame([("s", i, count, gone) for i in picks], "stratum string, index long, count long, unavailable array<long>")
    assert sorted(r["chosen"] for r in sampling.substitute_unavailable(df).collect() if r["chosen"] is not None) == chosen


def test_substitutes_against_a_walk(spark):
    r = random.Random(11)
    rows, want = [], {}
    for s in range(40):
        n = r.randint(1, 30)
        picks, gone = sorted(r.sample(range(n), r.randint(1, n))), r.sample(range(n), r.randint(0, n))
        rows += [(f"s{s}", i, n, gone) for i in picks]
        used = set(picks)
        for i in picks:
            at = i if i not in gone else next((j for j in range(i + 1, n) if j not in used and j not in gone), None)
            used.add(at)
            want[f"s{s}", i] = at
    df = spark.createDataFrame(rows, "stratum string, index long, count long, unavailable array<long>")
    assert {(x["stratum"], x["index"]): x["chosen"] for x in sampling.substitute_unavailable(df.repartition(3)).collect()} == want


def test_rows_are_numbered_over_ranges(spark):
    rows = [(i * 7919 % 1000, f"g{i % 3}" if i % 3 else None) for i in range(1000)]
    got = sampling.numbered(spark.createDataFrame(rows, "id long, g string").repartition(7), ["id"], ["g"]).collect()
    for g in ("g1", "g2", None):
        mine = sorted((r["index"], r["id"]) for r in got if r["g"] == g)
        assert mine == list(enumerate(sorted(i for i, x in rows if x == g))) and {r["n_"] for r in got if r["g"] == g} == {len(mine)}


MPEG = [(b"\xff\xfb\x90\x00", 44100), (b"\xff\xfb\xf0\x00", None), (b"\xff\xfb\x00\x00", None), (b"\xff\xfb\xf0\x00\xff\xf3\x94\x00", 24000), (b"\xff\xfb\x9c\x00", None), (b"\xff\xeb\x90\x00", None), (b"ID3\x04\x00\x00\x00\x00\x00\x05\xff\xfb\x90\x00\x00\xff\xe3\x98\x00", 8000), (b"", None), (None, None)]


@pytest.mark.parametrize("data, rate", MPEG)
def test_mpeg_rates(data, rate):
    from talkmill.sources.readers import mpeg_rate

    assert mpeg_rate(data) == rate
