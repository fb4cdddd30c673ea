"""Chat formatting: broken texts are refused at once, templates that can't be read back too; the query against a plain version."""

import hashlib
import random
import time

import pytest

from talkmill.llm import chat, queries


@pytest.mark.parametrize("text", ["### User: " + "a" * 1_000_000, "### User: " + "\\#" * 500_000, "### " + "a" * 1_000_000, "### User: " + "# <" * 300_000 + "</turn> x", "a" * 1_000_000, "### User: x </turn>\n" * 40_000 + "###", "### User: x ###", "### User: x\\ </turn>\n", "### User: x</turn>\n", "### " + "\\" * 1_000_001])
def test_broken_texts_are_refused_soon(text):
    began = time.time()
    with pytest.raises(ValueError):
        chat.Template().read(text)
    assert time.time() - began < 1


@pytest.mark.parametrize("odd", [{"escape": ""}, {"escape": "\\\\"}, {"escape": "#"}, {"open": "User "}, {"close": "\n"}, {"colon": ""}, {"controls": ("aa",), "open": "aa", "close": "aa"}, {"controls": ("",)}, {"shown": {"user": "A", "assistant": "A"}}, {"shown": {"user": "=A"}}])
def test_templates_that_cant_be_read_back(odd):
    with pytest.raises(ValueError):
        chat.Template(**odd)


@pytest.mark.parametrize("template", [chat.Template(), chat.Template(open="<|im_start|>", colon="\n", close="<|im_end|>\n", controls=("<|im_start|>", "<|im_end|>"), escape="^"), chat.Template(open="[INST]", colon="|", close="[/INST]", controls=("[INST]", "[/INST]"), escape="~")])
def test_round_trip(template):
    r = random.Random(5)
    pieces = ["\\", "^", "~", "|", "#", "###", "<|im_start|>", "<|im_end|>", "<|", "[INST]", "[/INST]", "[/", " </turn>\n", "</turn", ">", "\n", ": ", " ", "é", "=", "a"]
    for _ in range(3000):
        turns = [(r.choice(["user", "assistant", "a|b", "", "=", "User", "\n"]), "".join(r.choices(pieces, k=r.randint(0, 8)))) for _ in range(r.randint(0, 4))]
        assert template.read("".join(s for x in turns for s, _ in template.turn(*x))) == turns


def test_broken_segments_have_an_error(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "ho"), (2, 0, "user", "x")], "conv_id long, turn int, role string, text string")
    from pyspark.sql import functions as F

    segments = chat.format_turns(df)
    broken = segments.withColumn("text", F.when((F.col("conv_id") == 1) & (F.col("turn_no") == 0) & (F.col("segment_no") == 2), F.lit(None)).otherwise(F.col("text")))
    rows = {r["conv_id"]: r for r in chat.read_back(broken).collect()}
    assert rows[1]["error"] and rows[1]["n_turns"] == 1 and rows[1]["loss_chars"] == 2 and rows[2]["error"] is None and rows[2]["n_turns"] == 1


def test_the_query_against_a_plain_version(spark, tmp_path):
    r, rows = random.Random(7), []
    for conv in range(40):
        for turn in range(r.randint(1, 7)):
            rows.append((conv, turn, ["user", "assistant", "system", "tool"][r.randrange(4)], r.choice([None, "", "a\\b ### </turn>\n", "é" * 50, queries.HOSTILE])))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    rows += [(-7, 0, "user", queries.HOSTILE), (-7, 1, "assistant", queries.HOSTILE)]
    got = {x["conv_id"]: x for x in queries.op7_chat_machine(spark, str(tmp_path)).collect()}
    assert set(got) == {x[0] for x in rows}
    for conv, x in got.items():
        mine = [(role, text or "") for c, _, role, text in sorted(rows, key=lambda x: x[:2]) if c == conv]
        said = "".join(t for role, t in mine if role == "assistant")
        assert x["n_turns"] == len(mine) and x["error"] is None
        assert x["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{t}\n" for role, t in mine).encode()).hexdigest()
        assert x["loss_chars"] == len(said) and x["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert x["formatted_chars"] == sum(len(s) for role, t in mine for s, _ in chat.Template().turn(role, t))
