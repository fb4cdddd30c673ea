"""Near duplicates among texts that share a template: what is compared grows with the texts, not with their pairs."""

import random

import brute
import pytest

from talkmill import session
from talkmill.llm import minhash


def family(n, shared, own, seed=1, twins=0):
    r = random.Random(seed)
    template = [f"t{i}" for i in range(shared)]
    rows = [(i, " ".join(template + [f"w{r.randrange(10**9)}" for _ in range(own)])) for i in range(n)]
    return rows + [(n + i, rows[i * 7][1] + " more") for i in range(twins)]


@pytest.fixture
def counted(monkeypatch):
    """How many pairs were brought together, before any test on a pair."""
    counts, plain = [], minhash.formed
    monkeypatch.setattr(minhash, "formed", lambda *args: counts.append(plain(*args).count()) or plain(*args))
    return counts


@pytest.mark.parametrize("shared", [64, 75, 84])
@pytest.mark.parametrize("n", [300, 1200])
def test_unlinked_pages_of_one_template(spark, counted, n, shared):
    rows = family(n, shared, 100 - shared, twins=5)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i if i < n else (i - n) * 7 for i, _ in rows}
    assert sum(counted) <= n


def test_a_longer_page_in_the_midst_of_linked_ones(spark):
    """Pages that are linked with each other, beside one with much more text that holds all they share."""
    rows = family(60, 90, 8) + [(1000, family(1, 90, 0)[0][1] + " " + " ".join(f"c{i}" for i in range(60)))] + [(2000 + i, t) for i, t in family(40, 70, 30, seed=3)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.components(rows) and got[1000] == 1000 and got[59] == 0


def test_two_templates_with_a_part_in_common(spark):
    r = random.Random(8)
    rows = []
    for i in range(150):
        middle = [f"{'ab'[i % 2]}{k}" for k in range(30)]
        rows.append((i, " ".join([f"t{k}" for k in range(40)] + middle + [f"w{r.randrange(10**9 if i % 3 else 40)}" for _ in range(20)])))
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.components(rows)


def test_formed_against_all_pairs(spark):
    r = random.Random(4)
    rows = [(k, i * 10 + k, r.choice([1, 2, 3, 100 + i]), n, r.randint(1, n)) for k in range(3) for i in range(60) for n in [r.randint(1, 60)]]
    df = spark.createDataFrame(rows, "key long, doc_id long, component_id long, n_shingles long, bound long")
    able = lambda a, b: a[0] == b[0] and a[2] != b[2] and 175 * min(a[4], b[4]) >= 75 * (a[3] + b[3])
    want = {(a[1], b[1]) for a in rows for b in rows if a[1] < b[1] and able(a, b)}
    pairs = [tuple(sorted(x)) for x in minhash.formed(df, ["key"], 75).select("doc_id", "doc_id_").collect()]
    assert len(pairs) == len(set(pairs)) and want <= set(pairs) and len(want) > 20
    at = {x[1]: x for x in rows}
    for a, b in pairs:  # within the width of a class
        assert at[a][2] != at[b][2] and 175 * min(at[a][4], at[b][4]) >= 75 * (at[a][3] + at[b][3]) / minhash.WIDTH - 75


def test_ids_that_are_no_numbers(spark):
    rows = [("b", "one two three four five six"), ("a", "One two three four five six"), ("c", "other words than those are here"), (None, "one two three four five six"), ("d", None)]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "name string, text string"), id_col="name")
    assert sorted(map(tuple, out.collect())) == [("a", 2, "a", True), ("b", 2, "a", False), ("c", 2, "c", True), ("d", 0, "d", True)]
    kept = minhash.keep_one(spark.createDataFrame(rows, "name string, text string"), id_col="name")
    assert sorted(str(r["name"]) for r in kept.collect()) == ["None", "a", "c", "d"]


def test_only_the_result_stays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: f"file://{tmp_path}")
    out = minhash.near_duplicates(spark.createDataFrame(family(40, 90, 8), "doc_id long, text string"))
    assert [p.name.split("-")[0] for p in (tmp_path / "talkmill").iterdir()] == ["near"] and out.count() == 40


def test_recall_over_the_given_documents(spark):
    """All links at 0.75 and above are found: components equal those of all pairs with a common shingle."""
    from collections import defaultdict

    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    sets, having, root = {i: brute.shingles(t) for i, t in rows}, defaultdict(list), {i: i for i, _ in rows}
    for i, s in sets.items():
        for x in s:
            having[x].append(i)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in {(a, b) for ids in having.values() for a in ids for b in ids if a < b}:
        x = len(sets[a] & sets[b])
        if 100 * x >= 75 * (len(sets[a]) + len(sets[b]) - x):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df).collect()}
    assert got == {i: find(i) for i in sets}
