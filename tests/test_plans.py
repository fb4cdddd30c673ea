"""Physical plans: what is read, pushed down, broadcast and shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from talkmill.operators import chunking, identity, reconcile, search, turns
from talkmill.plans import planning

REC = "id string, document string, embedding array<float>, show string, episode_number string, episode_title string, date string, date_ts int, speaker string, speaker_id string, start_time double, n_chunks int, rules_version string, identity_version string, episode_guid string, source string"


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('records')}/r"
    rows = [(f"S-ep{i // 5}-2024-01-01-{i % 5}", "d", [float(i), 1.0], "S", str(i // 5), "t", "2024-01-01", 20240101, "SPEAKER_00", None, 0.0, 5, "1", "1@1", None, None) for i in range(50)]
    spark.createDataFrame(rows, REC).write.parquet(at)
    return spark.read.parquet(at)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(text):
    return set(re.findall(r"ReadSchema: struct<([^>]*)", text))


def test_search_pushes_filters_and_keeps_a_heap(records):
    text = plan(search.nearest(records, [1.0, 2.0], 3, search.filters(show="S", after_date="2024-01-01")))
    assert "TakeOrderedAndProject" in text and "EqualTo(show,S)" in text and "GreaterThanOrEqual(date_ts,20240101)" in text and "Exchange" not in text


def test_planning_and_audits_read_no_vectors(records):
    for df in (planning.episode_state(records), reconcile.incomplete(records), reconcile.shared_prefixes(records), identity.has_identity(records, reconcile.KEY)):
        assert not any("embedding" in s or "document" in s for s in scanned(plan(df)))


def test_turns_take_one_shuffle(spark):
    seg = spark.createDataFrame([("e", 0, "A", 0.0, "x")], "episode string, seq int, speaker string, start double, text string")
    assert plan(turns.merge_turns(seg)).count("Exchange hashpartitioning") == 1


def test_chunks_take_one_shuffle_and_no_python(spark):
    seg = spark.createDataFrame([("e", 0, "A", 0.0, "x")], "episode string, seq int, speaker string, start double, text string")
    text = plan(chunking.build_chunks(seg))
    assert text.count("Exchange hashpartitioning") == 1 and not re.search("Python|Arrow|Pandas", text)


def test_exclusions_are_no_nested_loop(records, spark):
    exc = spark.createDataFrame([("S", "1", "2024-01-01", "g")], "show string, episode_number string, date string, guid string")
    text = plan(reconcile.not_excluded(records, exc))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_speaker_at_joins_by_episode(spark):
    t = spark.createDataFrame([("e", 0, "A", 0.0, 10.0)], "episode string, turn_idx long, speaker string, start double, duration_s double")
    p = spark.createDataFrame([("e", 5.0)], "episode string, t double")
    text = plan(turns.speaker_at(p, t))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_people_are_broadcast_only_up_to_a_count(spark, monkeypatch):
    v = spark.createDataFrame([(1, [1.0])], "k int, vector array<double>")
    p = spark.createDataFrame([("a", [1.0]), ("b", [1.0])], "person string, centroid array<double>")
    hinted = lambda: "strategy=broadcast" in identity.score(v, p, ["k"])._jdf.queryExecution().analyzed().toString()
    assert hinted()
    monkeypatch.setattr(identity, "MAX_PEOPLE", 1)
    assert not hinted()


def test_state_is_marked_where_records_disagree(spark):
    df = spark.createDataFrame([("S", "1", "d", "p-0", 2), ("S", "1", "d", "p-1", 3)], "show string, episode_number string, date string, id string, n_chunks int")
    assert reconcile.completeness(df).select("is_uniform", F.col("stored_n")).first()["is_uniform"] is False


def test_first_people_are_picked_before_the_shuffle(spark):
    """Of all people's scores, each task keeps two for a vector; only these are shuffled and sorted together."""
    v = spark.createDataFrame([(1, [1.0, 0.0])], "k int, vector array<double>")
    p = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.6, 0.8])], "person string, centroid array<double>")
    text = plan(identity.assign(identity.score(v, p, ["k"]), ["k"], 0.5, 0.1))
    assert "WindowGroupLimit" in text and text.index("WindowGroupLimit") < text.rindex("WindowGroupLimit")


def test_old_tables_go(spark):
    from talkmill.session import clear_written, shared_dir, written

    kept = written(spark.range(3), "kept")
    assert clear_written(spark, 3600) == 0 and kept.count() == 3
    assert clear_written(spark, -1) >= 1 and clear_written(spark, -1) == 0 and shared_dir(spark)
