"""Strings found twice: suffix orders beside sorting, removal beside counting every string."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talkmill.llm import suffixdedup
from talkmill.llm.suffixorder import suffix_order

STRINGS = st.lists(st.one_of(st.lists(st.integers(1, 3), max_size=30), st.lists(st.integers(1, 257), max_size=30), st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=5), st.integers(0, 9)).map(lambda x: x[0] * x[1])), min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(STRINGS)
def test_orders_of_many_strings(strings):
    strings = [[*s, 0] for s in strings]
    starts = np.cumsum([0, *map(len, strings)])[:-1]
    expected = [at + i for at, s in zip(starts, strings) for i in sorted(range(len(s)), key=lambda i: s[i:])]
    assert suffix_order(np.array(sum(strings, []), np.uint16), starts).tolist() == expected


def test_orders_of_long_repeats():
    word = [5, 9, 7, 200, 3, 8]
    strings = [[7] * 3000 + [0], list(range(250, 1, -1)) * 5 + [0], (word * 300 + [1] + word * 200) + [0]]
    starts = np.cumsum([0, *map(len, strings)])[:-1]
    expected = [at + i for at, s in zip(starts, strings) for i in sorted(range(len(s)), key=lambda i: s[i:])]
    assert suffix_order(np.array(sum(strings, []), np.uint16), starts).tolist() == expected


def brute(texts, window):
    """(removed spans, rest) of each text."""
    raw, seen, out = [(t or "").encode() for t in texts], {}, []
    for x in raw:
        for i in range(len(x) - window + 1):
            seen[x[i : i + window]] = seen.get(x[i : i + window], 0) + 1
    for x in raw:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - window + 1):
            if seen[x[i : i + window]] > 1:
                gone[i : i + window] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((list(zip(edges[::2].tolist(), edges[1::2].tolist())), np.frombuffer(x, np.uint8)[~gone].tobytes()))
    return out


def found(df, **more):
    rows = suffixdedup.remove_repeats(df, **more).collect()
    return {r["doc_id"]: ([(s["start"], s["end"]) for s in r["removed"]], bytes(r["rest"])) for r in rows}


def corpus(seed, n, window):
    """Invented texts that share passages, with edits, copies, periods and marks of several bytes."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéßя語") for _ in range(r.randint(1, 7))) for _ in range(60)]
    prose = lambda k: " ".join(r.choice(words) for _ in range(k))
    passages, texts = [prose(r.randint(window // 4, window)) for _ in range(6)], []
    for i in range(n):
        kind, t = i % 8, " ".join(prose(r.randint(0, 60)) if r.random() < 0.6 else r.choice(passages) for _ in range(r.randint(1, 6)))
        if kind == 1 and texts:
            t = texts[-1]
        elif kind == 2 and texts:
            at = r.randrange(len(texts[-1]) or 1)
            t = texts[-1][:at] + "x" + texts[-1][at:]
        elif kind == 3:
            t = r.choice(["ab", "a", "abcabd"]) * r.randint(1, 300)
        elif kind == 4:
            p = r.choice(passages)
            t = prose(3) + p[r.randrange(len(p)) :] + p[: r.randrange(len(p))]
        texts.append(t)
    return texts


@pytest.mark.parametrize(("seed", "window", "anchor", "bucket"), [(1, 200, 64, 64), (2, 40, 16, 64), (3, 40, 16, 2), (4, 24, 8, 1), (5, 30, 30, 3), (6, 30, 1, 2)])
def test_removal_beside_counting_every_string(spark, seed, window, anchor, bucket):
    texts = corpus(seed, 90, window)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got, expected = found(df, window=window, anchor=anchor, bucket=bucket), brute(texts, window)
    assert [got[i] for i in range(len(texts))] == expected
    assert any(spans for spans, _ in expected) and any(not spans for spans, _ in expected)


def test_texts_longer_than_a_piece(spark):
    r = random.Random(3)
    long = "".join(r.choice("abcdefgh ") for _ in range(2 * suffixdedup.PIECE + 777))
    at = suffixdedup.PIECE
    texts = [long, "q" * 300, long[at - 150 : at + 150] + "!", long[-200:], "z" + long[:199]]
    got = found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert got[0][0] == [(at - 150, at + 150), (len(long) - 200, len(long))] and got[0][1].decode() == long[: at - 150] + long[at + 150 : -200]
    assert got[1] == ([(0, 300)], b"") and got[2] == ([(0, 300)], b"!") and got[3] == ([(0, 200)], b"") and got[4][0] == []


def test_copies_nulls_and_clashing_names(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, "own " * 10), (None, text[:250]), (2, None), (3, ""), (4, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    names = ["rest", "removed", "id", "th", "h", "c", "k", "n", "lo", "bytes", "wanted", "k_id", "K_TEXT", "spans", "runs", "w"]
    odd = df.withColumns({c: F.lit(i) for i, c in enumerate(names)})
    out = suffixdedup.remove_repeats(odd)
    assert out.columns == ["doc_id", "text", *names[2:], "rest", "removed"]
    got = sorted((r["doc_id"] or 0, r["text"] or "", bytes(r["rest"]).decode(), len(r["removed"])) for r in out.collect())
    assert got == sorted([(1, text, "", 1), (1, text, "", 1), (0, "own " * 10, "own " * 10, 0), (0, text[:250], "", 1), (2, "", "", 0), (3, "", "", 0), (4, "short", "short", 0)])
    assert suffixdedup.remove_repeats(df.limit(0)).collect() == []
    by_name = df.selectExpr("cast(doc_id as string) as name", "text as body")
    assert suffixdedup.remove_repeats(by_name, id_col="name", text_col="body").where("size(removed) > 0").count() == 3


def test_a_hot_bucket_in_parts(spark):
    """One passage in many texts, each with its own words around: all parts of its buckets agree."""
    r = random.Random(8)
    passage = "".join(r.choice("abcdef ") for _ in range(500))
    texts = ["".join(r.choice("ghijkl ") for _ in range(150)) + passage + "".join(r.choice("mnopqr ") for _ in range(150)) for _ in range(150)]
    texts += [passage[:260], passage[300:499], "s" * 199]
    got = found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), bucket=8)
    assert [got[i] for i in range(len(texts))] == brute(texts, 200)


def test_runs_of_marks_within_owners():
    got = suffixdedup._runs(np.array([1, 1, 0, 1, 1, 1, 0, 0], bool), np.array([0, 0, 0, 0, 2, 2, 2, 2]), 4)
    assert got.to_pylist() == [[0, 2, 3, 4], [], [0, 2], []] and isinstance(got, pa.ListArray)
