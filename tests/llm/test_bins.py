"""Harmonic packing: all ids once, sequences gapless, whole documents kept whole, little padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from talkmill.llm import packing, queries


def packed(lengths, capacity=4096):
    """Pieces of one worker: (document, start, length, sequence, offset)."""
    bins = packing.Bins(capacity, 5 << 32)
    out = [x for i, n in enumerate(lengths) for x in bins.put(i, np.arange(n, dtype=np.int32))]
    out += bins.rest()
    assert all(np.array_equal(ids, np.arange(start, start + len(ids))) and total == lengths[i] for i, start, ids, total, _, _ in out)
    return [(i, start, len(ids), seq, offset) for i, start, ids, _, seq, offset in out]


def held(pieces, lengths, capacity=4096):
    """Checks the contract; returns padding, documents cut that would fit, and pieces shorter than a 64th of the capacity."""
    docs, seqs = defaultdict(list), defaultdict(list)
    for i, start, n, seq, offset in pieces:
        docs[i].append((start, n))
        seqs[seq].append((offset, n))
    for table, sizes in ((docs, dict(enumerate(lengths))), (seqs, {})):
        for key, parts in table.items():
            at = 0
            for start, n in sorted(parts):
                assert start == at and n > 0
                at += n
            assert at == sizes.get(key, at)
            sizes[key] = at
    assert len(docs) == len(lengths) and sorted(seqs) == list(range(5 << 32, (5 << 32) + len(seqs)))
    filled = [sum(n for _, n in parts) for parts in seqs.values()]
    assert max(filled, default=0) <= capacity
    padding = sum(0 if n & (n - 1) == 0 else capacity - n for n in filled)
    return padding, sum(len(p) > 1 and lengths[i] <= capacity for i, p in docs.items()), sum(n < max(1, capacity // 64) and n < lengths[i] for i, _, n, _, _ in pieces)


@pytest.mark.parametrize("seed", range(60))
def test_any_lengths(seed):
    r = random.Random(seed)
    capacity = r.choice([64, 100, 4096])
    lengths = [r.choice([r.randint(1, 5), r.randint(1, capacity), r.randint(1, 5 * capacity), capacity, capacity + 1]) for _ in range(r.randint(0, 300))]
    padding, _, short = held(packed(lengths, capacity), lengths, capacity)
    assert padding <= 0.02 * sum(lengths) + 2 * capacity and short <= 12


def test_lengths_like_those_of_documents():
    r = random.Random(1)
    lengths = [min(50_000, int(r.lognormvariate(6.3, 1.1)) + 1) for _ in range(5000)]
    padding, cut, short = held(packed(lengths), lengths)
    assert padding < 0.005 * sum(lengths) and cut < 0.02 * len(lengths) and short <= 8


def test_documents_over_half_the_capacity_are_filled_by_few_cuts():
    r = random.Random(2)
    lengths = [r.randint(2100, 4096) for _ in range(2000)]
    padding, cut, _ = held(packed(lengths), lengths)
    assert padding < 0.005 * sum(lengths) and cut < 0.3 * len(lengths)


def test_a_bin_begins_with_the_count_of_its_class():
    pieces = packed([1300] * 3 + [900] * 4)
    sequence = {i: seq for i, start, _, seq, _ in pieces if not start}
    assert sequence[0] == sequence[1] == sequence[2] != sequence[3] and len({sequence[i] for i in (3, 4, 5)}) == 1


def test_memory_of_a_worker_is_bounded():
    r, bins, most = random.Random(3), packing.Bins(4096, 0), 0
    for i in range(20_000):
        for _ in bins.put(i, np.zeros(r.choice([r.randint(1, 64), r.randint(2049, 4096), r.randint(1, 4096)]), np.int32)):
            pass
        most = max(most, bins.stocked + sum(len(p[2]) for b in bins.waiting for p in b[1]) + sum(len(p[2]) for mine in bins.open.values() for p in mine))
    assert most < 4096 * 120


def test_long_words_are_not_remembered():
    w = packing.WordIds(queries.tokenizer_path())
    texts = ["a" * 500_000, "short words " + "x1" * 5000, "short"]
    want = [w.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [x.tolist() for x in w(texts)] == want
    assert set(w.known) == {b"short", b"words"}


def test_the_query_against_a_plain_version(spark, tmp_path):
    """The contract's columns from the tokenizer alone: each id once, the digests of the pieces, gapless sequences."""
    from tokenizers import Tokenizer

    r, t = random.Random(6), Tokenizer.from_file(queries.tokenizer_path())
    texts = [None, "", " \n", "É" * 9000, *(" ".join(r.choice(["the", "of", "Zürich", "12.5", "naïve", "x" * 70]) for _ in range(r.choice([3, 300, 3000, 9000]))) for _ in range(60))]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    ids = [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]
    rows = queries.op4_harmonic_packing(spark, str(tmp_path)).collect()
    parts, seqs = defaultdict(list), defaultdict(list)
    for x in rows:
        mine = ids[x["doc_id"]][x["start"] : x["start"] + x["length"]]
        assert len(mine) == x["length"] and zlib.crc32(np.array(mine, "<u4").tobytes()) == x["ids_crc32"] and x["doc_tokens"] == len(ids[x["doc_id"]])
        parts[x["doc_id"]].append((x["start"], x["length"]))
        seqs[x["sequence_id"]].append((x["offset"], x["length"]))
    for table, size in ((parts, lambda k: len(ids[k])), (seqs, lambda k: None)):
        for key, found in table.items():
            at = 0
            for start, n in sorted(found):
                assert start == at
                at += n
            assert size(key) in (None, at) and (size(key) or at <= 4096)
    assert len(parts) == len(texts)
