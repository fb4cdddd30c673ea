"""Nulls, empty and long texts, repeated rows, empty tables and clashing names for every operator."""

import pytest
from pyspark.sql import functions as F

from talkmill.llm import chat, linededup, minhash, mixing, packing, quality, queries, sharding, surrogates, tiff, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LINES = [f"line number {i} says several rather different words" for i in range(4)]
LONG = " ".join(f"word{i % 9973}x{i}" for i in range(60_000))
ROWS = [
    (1, "\n".join(LINES), "en", "a", 1),
    (1, "\n".join(LINES), "en", "a", 1),
    (2, "\n".join([*LINES, "and one more line at the end"]), None, None, None),
    (3, None, "en", "b", 0),
    (4, "", "xx", "b", 0),
    (5, " \n\t ", "de", None, 3),
    (None, "a text without an id", "en", "a", 5),
    (None, None, None, None, None),
    (6, LONG, "en", "a", len(LONG)),
    (7, "Ünïcödé – 日本語 🙂", "fr", "c", 9),
]
CLASH = ["kept", "shard", "slot", "n_words", "tokens", "probability", "sampled", "n_lines", "w_id", "lines", "h", "q_text", "q", "s_key", "m_tokens", "kept_id", "id", "key", "ids", "score", "spans", "media", "page"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def odd(docs):
    return docs.withColumns({c: F.lit(i) for i, c in enumerate(CLASH)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


OPERATORS = {
    "quality": quality.judge,
    "lines": linededup.dedup_lines,
    "near": minhash.near_duplicates,
    "keep_one": minhash.keep_one,
    "pack": lambda d: packing.pack(d, tokenizer_path=queries.tokenizer_path()),
    "surrogates": lambda d: surrogates.replace(d, key=b"k"),
    "shards": lambda d: sharding.shard_rows(d, [F.col("text")]),
    "mix": mixing.mix,
    "tiff": lambda d: tiff.digest(tiff.read_pages(tiff.write_pages(d))),
    "toxicity": lambda d: toxicity.score(d, toxicity.fit(["you idiot", "fine words"] * 5, [1, 0] * 5)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_gives_no_rows(empty, name):
    assert OPERATORS[name](empty).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_change_nothing(docs, odd, name):
    plain, more = OPERATORS[name](docs), OPERATORS[name](odd)
    shared = [c for c in plain.columns if c in more.columns]
    assert sorted(map(repr, plain.select(shared).collect())) == sorted(map(repr, more.select(shared).collect()))


def test_quality(docs):
    rows = quality.judge(docs).collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert (by[3]["n_words"], by[3]["base_failed"], by[3]["kept"]) == (0, True, False)
    assert by[5]["word_chars"] == 0 and by[4]["n_words"] == 0
    assert by[6]["n_words"] == 60_000 and by[7]["word_chars"] == len("Ünïcödé–日本語🙂")


def test_lines(docs):
    rows = linededup.dedup_lines(docs).collect()
    assert len(rows) == len(ROWS)
    texts = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert [r["n_removed"] for r in rows if r["doc_id"] == 1] == [0, 0]
    assert texts[2]["text"] == "and one more line at the end" and texts[2]["n_removed"] == 4
    assert texts[3]["text"] is None and texts[3]["n_lines"] == 0 and texts[4]["n_lines"] == 1


def test_near(docs, spark):
    rows = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7]
    assert rows[2]["component_id"] == 1 and not rows[2]["kept"]
    assert rows[3]["n_shingles"] == 0 and rows[3]["kept"] and rows[7]["n_shingles"] == 1
    kept = minhash.keep_one(docs).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 0, 1, 3, 4, 5, 6, 7]


def test_pack(docs):
    rows = packing.pack(docs, tokenizer_path=queries.tokenizer_path()).collect()
    blank = [r for r in rows if r["doc_id"] in (3, 4, 5)]
    assert [(r["start"], r["length"], r["ids"]) for r in blank] == [(0, 1, [2])] * 3
    long = sorted((r for r in rows if r["doc_id"] == 6), key=lambda r: r["start"])
    assert sum(r["length"] for r in long) == long[0]["doc_tokens"] > 60_000


def test_shards(docs):
    rows = sharding.shard_rows(docs, [F.col("text")], n_shards=3).collect()
    sizes = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(3)]
    assert [len(s) for s in sizes] == [4, 3, 3] and all(s == list(range(len(s))) for s in sizes)


def test_mix(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS) and all(r["probability"] is not None and r["sampled"] is not None for r in rows)


def test_surrogates(docs, spark):
    rows = surrogates.replace(docs, key=b"k").collect()
    assert {r["doc_id"]: r["text"] for r in rows if r["doc_id"]}[3] is None and len(rows) == len(ROWS)


def test_tiff(docs):
    rows = {r["doc_id"]: r for r in tiff.digest(tiff.read_pages(tiff.write_pages(docs))).collect() if r["doc_id"]}
    assert (rows[3]["n_bytes"], rows[3]["payload_bytes"]) == (0, 576) and rows[6]["n_bytes"] == len(LONG)
    assert rows[3]["payload_sha256"] == rows[4]["payload_sha256"]


def test_toxicity(docs):
    model = toxicity.fit(["you idiot there", "fine words there"] * 20, [1, 0] * 20)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 0, "assistant", "first"), (2, 0, "assistant", "first"), (None, None, None, None), (3, None, "user", "null turn first"), (3, 0, "assistant", "yes")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("loss", F.lit(1))
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert (out[1]["n_turns"], out[1]["in_order"], out[1]["loss_chars"]) == (2, True, 0)
    assert (out[2]["n_turns"], out[2]["in_order"], out[2]["loss_chars"]) == (2, False, 10)
    assert out[None]["n_turns"] == 1 and out[3]["in_order"] and out[3]["loss_chars"] == 3
    assert chat.read_back(chat.format_turns(df.limit(0))).collect() == []
