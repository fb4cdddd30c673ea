"""Transcript lines, names, ids, feed fields and rendering."""

import random

import pytest
from pyspark.sql import functions as F

from talkmill.functions import text as X

TRANSCRIPT = """# Harbour Talk - Episode 1
# Opening Night
# Published: 2025-03-14

[SPEAKER_00] 3.1s - Good evening from the harbour to all of you.
[SPEAKER_00] 6.9s - We each say a word before the bell rings.
[SPEAKER_01] 52.8s - So the boats are in and we can begin.
[UNKNOWN] 61.0s - Someone else speaks.
this line is malformed and must be skipped
"""


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_segments(spark):
    df = spark.createDataFrame([("e", TRANSCRIPT), ("none", "")], "episode string, text string")
    rows = X.segments(df).orderBy("seq").collect()
    assert [(r["speaker"], r["start"]) for r in rows] == [("SPEAKER_00", 3.1), ("SPEAKER_00", 6.9), ("SPEAKER_01", 52.8), ("UNKNOWN", 61.0)]
    assert rows[0]["text"].startswith("Good evening") and {r["episode"] for r in rows} == {"e"}


def test_title(spark):
    assert value(spark, X.title_of(F.lit(TRANSCRIPT))) == "Opening Night"


@pytest.mark.parametrize("text, n", [("a b", 2), ("  a b\x1cc ", 3), ("", 0), ("　", 0), ("a\x85b", 2)])
def test_words_split_at_unicode_blanks(spark, text, n):
    assert value(spark, F.size(X.words(F.lit(text)))) == n


def test_lines_split_at_all_ends(spark):
    assert value(spark, X.lines(F.lit("a\r\nb\x0bc d\re"))) == list("abcde")


@pytest.mark.parametrize("name, ok", [("S - Episode 7 - 2024-01-31.txt", True), ("S - Episode Unknown - Unknown Date.txt", True), ("S - Episode 7 - 2024-13-01.txt", False), ("S - Episode 7 - 2024-01-32.txt", False), ("S - Episode a b - 2024-01-01.txt", False)])
def test_file_names(spark, name, ok):
    got = value(spark, X.file_triple(F.lit(name)))
    assert (got is not None) == ok
    if ok:
        assert value(spark, X.file_name(*(F.lit(x) for x in got))) == name


def test_ids(spark):
    p = X.id_prefix(F.lit("Harbour Talk"), F.lit("73"), F.lit("2026-07-29"))
    assert value(spark, X.chunk_id(p, F.lit(17))) == "Harbour_Talk-ep73-2026-07-29-17"
    assert value(spark, X.id_index(F.lit("a-b-17"))) == 17 and value(spark, X.id_index(F.lit("ab"))) is None and value(spark, X.id_suffix(F.lit("ab"))) == "ab"
    assert value(spark, X.date_number(F.lit("Unknown Date"))) == 0 and value(spark, X.date_number(F.lit("2025-03-14"))) == 20250314


@pytest.mark.parametrize("guid, is_link, expected", [("g", False, "g"), ("g", True, None), ("g", None, None), ("", False, None), (None, False, None)])
def test_guid(spark, guid, is_link, expected):
    assert value(spark, X.feed_guid(F.lit(guid).cast("string"), F.lit(is_link).cast("boolean"))) == expected


@pytest.mark.parametrize("itunes, title, expected", [("12", "Ep 5", "12"), (None, "Ep 5", "5"), (None, "Ep. 5", "5"), (None, "Ep5", "5"), (None, "Episode 5", "Unknown"), ("", None, "Unknown")])
def test_number(spark, itunes, title, expected):
    assert value(spark, X.feed_number(F.lit(itunes).cast("string"), F.lit(title).cast("string"))) == expected


def test_date_is_in_the_stamps_own_zone(spark):
    assert value(spark, X.feed_date(F.lit("Tue, 1 Oct 2024 23:30:00 -0700"))) == "2024-10-01"
    assert value(spark, X.feed_date(F.lit("soon"))) == "Unknown Date"


def test_next_ingest_rolls_over_at_the_hour(spark):
    due = lambda t: str(value(spark, X.next_ingest(F.lit(t).cast("timestamp"))))
    assert due("2024-05-01 08:59:59").startswith("2024-05-01 09") and due("2024-05-01 09:00:00").startswith("2024-05-02 09")


def test_header_changes_only_where_it_is_the_old_one(spark):
    new = lambda t: value(spark, X.rewritten_header(F.lit(t), F.lit("S"), F.lit("7"), F.lit("9")))
    assert new("# S - Episode 7\r\nbody") == "# S - Episode 9\r\nbody" and new("# S - Episode 7\nb") == "# S - Episode 9\nb"
    assert new("# S - Episode 77\nb") == "# S - Episode 77\nb"


@pytest.mark.parametrize("speaker_id, name, speaker, expected", [("p1", "Ann", "SPEAKER_01", "Ann"), ("grp_007", None, "SPEAKER_01", "unidentified voice (grp_007)"), ("", None, "SPEAKER_01", "unidentified voice (SPEAKER_01)"), (None, None, "UNKNOWN", "unidentified"), (None, None, None, "unidentified")])
def test_display(spark, speaker_id, name, speaker, expected):
    assert value(spark, X.display_speaker(*(F.lit(x).cast("string") for x in (speaker_id, name, speaker)))) == expected


def test_prefix_goes_only_if_it_matches(spark):
    strip = lambda t, s: value(spark, X.strip_speaker(F.lit(t), F.lit(s)))
    assert strip("[A] x", "A") == "x" and strip("[B] x", "A") == "[B] x"


def test_second_tier(spark):
    f = lambda show, t: value(spark, X.routes_to_second_tier(F.lit(show), F.lit(t), ["Two"], {"One": ["ostrow"]}))
    assert f("Two", "") and f("One", "OSTROW said") and not f("One", "Marlo Reed") and not f("Other", "ostrow")


def test_rounding_is_that_of_the_exact_value(spark):
    """Halves go to even; what only looks like a half goes where its binary value lies."""
    r = random.Random(3)
    values = [0.0625, 0.1875, 2.675, 2.665, 0.0005, 0.0015, 0.25, 0.35, 1e-9, -0.0625, 0.9995, 123456.0005, 86399.95, 0.05, -2.675]
    values += [k / 2**r.randint(1, 12) for k in range(-2000, 2000)] + [round(r.uniform(0, 1), 4) for _ in range(2000)] + [r.randint(0, 10**7) / 1000 + 0.0005 for _ in range(2000)] + [r.randint(0, 10**6) / 10 + 0.05 for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (1, 3):
        got = [x["y"] for x in df.select(X.to_places(F.col("x"), digits).alias("y")).collect()]
        assert got == [round(v, digits) for v in values]
    shown = [x["y"] for x in df.select(X.to_places(F.col("x"), 1).cast("decimal(30,1)").cast("string").alias("y")).collect()]
    assert shown == [f"{v:.1f}" if f"{v:.1f}" != "-0.0" else "0.0" for v in values]
