"""Of rows that share an id, near dedup drops only those whose text repeats one that stays."""

import random

import brute

from talkmill.llm import minhash

R = random.Random(3)
PROSE = [" ".join(R.choice("abcdefghij") + str(R.randrange(500)) for _ in range(60)) for _ in range(4)]


def edited(text, word="other"):
    return f"{word} {text}"


def test_each_text_of_an_id_is_judged_by_itself(spark):
    rows = [
        (7, PROSE[0], "clean and smaller"),
        (7, PROSE[1] + " and some more words", "larger, near 2"),
        (2, PROSE[1], "first of its group"),
        (9, PROSE[2], "repeats"),
        (9, PROSE[2], "repeats"),
        (9, edited(PROSE[2]), "repeats"),
        (9, PROSE[3], "another"),
        (11, "", "blank"),
        (11, None, "blank"),
        (12, " ", "blank of 12"),
        (None, PROSE[0], "no id"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, note string")
    got = minhash.keep_one(df.repartition(3))
    assert got.columns == df.columns
    assert sorted(r["note"] for r in got.collect()) == sorted(["clean and smaller", "first of its group", "repeats", "another", "blank", "blank of 12", "no id"])


def test_equals_brute_force_over_repeated_ids(spark):
    texts = [edited(t, f"w{k}") if k else t for t in (" ".join(R.choice("klmnop") + str(R.randrange(300)) for _ in range(40)) for _ in range(12)) for k in range(R.randint(1, 4))]
    rows = [(R.randrange(10), t) for t in texts]
    group = brute.components([(i, t) for i, (_, t) in enumerate(rows)])
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[group[i]] = min(least.get(group[i], doc), doc)
    got = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    at = {t: i for i, (_, t) in enumerate(rows)}
    assert sorted((group[at[r["text"]]], r["doc_id"]) for r in got) == sorted(least.items())
