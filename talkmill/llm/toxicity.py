"""Toxicity by a linear-chain conditional random field over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Places of the table of word weights.
WORDS = 1 << 20
#: Texts that training walks through at a time.
GROUP = 256
#: Words from which a text is walked through in blocks side by side.
LONG = 4096


def tokens(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first and last byte places of the words of a whole text, and its bytes. Words are runs of letters, digits and bytes beyond ASCII; A-Z count as a-z."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    lower = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    starts, ends = common.spans(~((lower >= 128) | ((lower >= 97) & (lower <= 122)) | ((lower >= 48) & (lower <= 57))))
    return (common.span_hashes(lower, starts, ends) if len(starts) else np.empty(0, np.uint64)), starts, ends, raw


@dataclass
class Crf:
    """Two states, clean and toxic. emit: by place in the word table, what a word adds to toxic; bias: what every word does; move: 2 x 2, from state to state, of logarithms; calibration turns a document's sums into a probability."""

    emit: np.ndarray
    bias: float
    move: np.ndarray
    calibration: np.ndarray

    def scores(self, hashed: np.ndarray) -> np.ndarray:
        return self.emit[(hashed % np.uint64(WORDS)).astype(np.int64)] + self.bias


def _blocked(scores: np.ndarray, cc: float, ct: float, tc: float, tt: float) -> np.ndarray:
    """The forward log ratios of one long sequence, in steps of the order of its length's square root: what a block does to any start is a 2 x 2 matrix, found for all blocks at once; starts then go from block to block, and all blocks walk from their starts side by side."""
    rest = scores[1:]
    size = int(np.ceil(np.sqrt(len(rest))))
    blocks = np.zeros((-(-len(rest) // size), size))
    blocks.ravel()[: len(rest)] = rest
    grow = np.exp(np.clip(blocks, -60, 60))
    effect = np.tile(np.eye(2), (len(blocks), 1, 1))  # columns: a clean and a toxic start
    for t in range(size):
        clean = cc * effect[:, 0] + tc * effect[:, 1]
        toxic = grow[:, t, None] * (ct * effect[:, 0] + tt * effect[:, 1])
        effect = np.stack([clean, toxic], 1)
        effect /= effect.max((1, 2), keepdims=True)
    start, ratio = np.array([1.0, np.exp(np.clip(scores[0], -60, 60))]), np.empty(len(blocks))
    for b, e in enumerate(effect):
        ratio[b] = np.log(max(start[1], 1e-300)) - np.log(max(start[0], 1e-300))
        start = e @ start
        start /= start.max()
    out = np.empty_like(blocks)
    for t in range(size):
        e = np.exp(np.clip(ratio, -60, 60))
        ratio = blocks[:, t] + np.log((ct + e * tt) / (cc + e * tc))
        out[:, t] = ratio
    return np.concatenate((scores[:1], out.ravel()[: len(rest)]))


def forward_backward(scores: list[np.ndarray], move: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each sequence the marginal probability of toxic at each word; and the expected moves, summed. Sequences walk side by side, longest first, so that a step is one operation for all still running; those over LONG words go in blocks of their own.

    In two states the forward and backward values are kept as log ratios, toxic to clean. The backward ones with the word's own score are forward ones of the sequence read from its end, with the moves turned round.
    """
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    sizes = np.array([len(scores[i]) for i in order])
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1].astype(np.int64)
    flat = np.concatenate([scores[i] for i in order]) if sizes.sum() else np.empty(0)
    (cc, ct), (tc, tt) = np.exp(move)
    ahead, back = np.empty(len(flat)), np.empty(len(flat))
    n_long = int((sizes > LONG).sum())
    for first, size in zip(starts[:n_long].tolist(), sizes[:n_long].tolist()):
        mine = flat[first : first + size]
        ahead[first : first + size] = _blocked(mine, cc, ct, tc, tt)
        back[first : first + size] = _blocked(mine[::-1], cc, tc, ct, tt)[::-1] - mine
    short, begin = sizes[n_long:], starts[n_long:]
    longest = int(short[0]) if len(short) else 0
    running = (len(short) - np.searchsorted(short[::-1], np.arange(longest), side="right")).tolist()
    ratio = np.ones(0)
    for t in range(longest):
        at = begin[: running[t]] + t
        if t:
            e = np.exp(np.clip(ratio[: running[t]], -60, 60))
            ratio = flat[at] + np.log((ct + e * tt) / (cc + e * tc))
        else:
            ratio = flat[at].copy()
        ahead[at] = ratio
    beta = np.zeros(len(short))
    for t in range(longest - 1, -1, -1):
        n = running[t]
        at = begin[:n] + t
        more = running[t + 1] if t + 1 < longest else 0
        if more:
            e = np.exp(np.clip(flat[begin[:more] + t + 1] + beta[:more], -60, 60))
            beta[:more] = np.log((tc + e * tt) / (cc + e * ct))
        beta[more:n] = 0.0
        back[at] = beta[:n]
    marginal = 1 / (1 + np.exp(-np.clip(ahead + back, -60, 60)))
    moves = np.zeros((2, 2))
    if sizes.max(initial=0) > 1:
        inner = np.ones(len(flat), bool)
        inner[(starts + sizes - 1)[sizes > 0]] = False
        i = np.flatnonzero(inner)
        a = np.exp(np.clip(ahead[i], -60, 60))
        b = np.exp(np.clip(flat[i + 1] + back[i + 1], -60, 60))
        parts = np.stack([cc * np.ones_like(a), ct * b, a * tc, a * tt * b])
        moves = (parts / parts.sum(0)).sum(1).reshape(2, 2)
    out: list[np.ndarray] = [np.empty(0)] * len(scores)
    for k, i in enumerate(order):
        out[i] = marginal[starts[k] : starts[k] + sizes[k]]
    return out, moves


def features(marginals: np.ndarray) -> np.ndarray:
    """What is held against the calibration: expected toxic words, the share of them, the surest one, and that none is toxic."""
    if not len(marginals):
        return np.array([1.0, 0.0, 0.0, 0.0, 0.0])
    total = float(marginals.sum())
    return np.array([1.0, np.log1p(total), min(1.0, 20 * total / len(marginals)), float(marginals.max()), float(total > 1.5)])


def fit(texts: list[str | None], labels: np.ndarray, *, rounds: int = 25, least: int = 3, lift: float = 2.5, sure: float = 4.0) -> Crf:
    """A CRF from texts with labels 0 and 1 for the whole text.

    Words get labels first: in a text of label 1 a word counts as toxic if it stands in at least `least` such texts and its odds to stand in one are exp(lift) times those of a text of label 0 or more and over 1 by `sure` standard errors, counts with a half added; all else is clean. The chain is then fitted to these sequences by gradient ascent on their conditional likelihood (adagrad), with the expected moves and words from forward-backward. Last, a logistic regression of the texts' labels on features of their marginals calibrates the score.
    """
    labels = np.asarray(labels, float)
    places = [(tokens(t)[0] % np.uint64(WORDS)).astype(np.int32) for t in texts]
    seen = np.zeros((2, WORDS), np.int32)
    for p, y in zip(places, labels):
        seen[int(y), np.unique(p)] += 1
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    odds = np.log((seen[1] + 0.5) / (n1 - seen[1] + 0.5)) - np.log((seen[0] + 0.5) / (n0 - seen[0] + 0.5))
    error = np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))
    marked = (seen[1] >= least) & (odds >= lift) & (odds >= sure * error)
    model = Crf(np.where(marked, 2.0, 0.0), -3.0, np.zeros((2, 2)), np.array([-3.0, 0, 0, 0, 0]))
    del seen, odds, error
    # texts of like length walk together, in groups that bound what is held at a time
    order = sorted(range(len(places)), key=lambda i: len(places[i]))
    groups = [order[i : i + GROUP] for i in range(0, len(order), GROUP)]
    truth = lambda i: (marked[places[i]] & (labels[i] > 0)).astype(float)
    moved = np.zeros((2, 2))
    for i in order:
        t = truth(i).astype(int)
        if len(t) > 1:
            moved += np.bincount(t[:-1] * 2 + t[1:], minlength=4).reshape(2, 2)
    emit2, bias2, move2 = np.full(WORDS, 1e-3), 1e-3, np.full((2, 2), 1e-3)
    for _ in range(rounds if any(len(p) for p in places) else 0):
        g, gb, gm = -0.05 * model.emit, 0.0, moved - 0.05 * model.move
        for group in groups:
            marginals, moves = forward_backward([model.emit[places[i]] + model.bias for i in group], model.move)
            for i, m in zip(group, marginals):
                gap = truth(i) - m
                np.add.at(g, places[i], gap)
                gb += gap.sum()
            gm = gm - moves
        emit2 += g * g
        bias2 += gb * gb
        move2 += gm * gm
        model.emit += 0.5 * g / np.sqrt(emit2)
        model.bias += 0.5 * gb / np.sqrt(bias2)
        model.move += 0.3 * gm / np.sqrt(move2)
    x = np.zeros((len(places), 5))
    for group in groups:
        for i, m in zip(group, forward_backward([model.emit[places[i]] + model.bias for i in group], model.move)[0]):
            x[i] = features(m)
    w = np.zeros(5)
    for _ in range(30):  # Newton's method with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(5)
        w += np.linalg.solve(h, x.T @ (labels - p) - 0.1 * w)
    model.calibration = w
    return model


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = 5000, max_bytes: int = 24 << 20, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Crf:
    """Fits on labelled documents whose crc32(id) modulo 4 isn't 2: a sample of at most max_rows of them, the first by a hash of the id, and of these texts of max_bytes in all. These two bounds hold for training alone; texts of the sample are used whole.

    Rows of labels without an id or label don't count; of labels that repeat, the highest does. Without any labelled text every text gets the same score.
    """
    own = common.col(id_col)
    ids = labels.select(own.alias("doc_id"), common.col(label_col).cast("int").alias("y")).where("y is not null and doc_id is not null").where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    ids = ids.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    found = docs.select(own.alias("doc_id"), common.col(text_col).cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    sizes = found.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "h").limit(max_rows).collect()
    kept, total = [], 0
    for r in sizes:
        if total + r["size"] <= max_bytes:
            kept.append((r["doc_id"],))
            total += r["size"]
    chosen = docs.sparkSession.createDataFrame(kept, found.select("doc_id").schema).distinct()  # max_rows rows at most
    rows = found.join(F.broadcast(chosen), "doc_id", "left_semi").collect() if kept else []
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    return fit([r["text"] for r in rows], np.array([r["y"] for r in rows]))


def score(docs: DataFrame, model: Crf, *, threshold: float = 0.3, span_from: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score (0 to 1), predicted (1 from threshold on), n_toxic (expected toxic words), spans (array of start, length, probability): each run of words whose marginal is span_from or more, in code points of the whole text, with the highest marginal in it.

    Null, empty and wordless texts get the score of a text without toxic words. Ids, null and repeated ones too, are passed through row by row. An empty table gives no rows. The model is broadcast once; its word table has WORDS places, whatever it was fitted on.
    """
    spark = common.ready(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast((np.flatnonzero(model.emit), model.emit[np.flatnonzero(model.emit)], model.bias, model.move, model.calibration))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, values, bias, move, calibration = shared.value
        emit = np.zeros(WORDS)
        emit[where] = values
        crf = Crf(emit, bias, move, calibration)

        def scored(ids: pa.Array, texts: list) -> pa.RecordBatch:
            found = [tokens(t) for t in texts]
            marginals, _ = forward_backward([crf.scores(f[0]) for f in found], crf.move)
            values, sums, spans = [], [], []
            for m, (_, starts, ends, raw) in zip(marginals, found):
                values.append(float(1 / (1 + np.exp(-np.clip(features(m) @ crf.calibration, -30, 30)))))
                sums.append(float(m.sum()))
                on = m >= span_from
                if not on.any():
                    spans.append([])
                    continue
                first, last = common.spans(~on)
                points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                spans.append([{"start": int(points[starts[a]]), "length": int(points[ends[b - 1]] - points[starts[a]]), "probability": float(m[a:b].max())} for a, b in zip(first.tolist(), last.tolist())])
            kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("probability", pa.float64())]))
            return pa.RecordBatch.from_arrays([ids, pa.array(values), pa.array([int(v >= threshold) for v in values], pa.int32()), pa.array(sums), pa.array(spans, kinds)], ["doc_id", "score", "predicted", "n_toxic", "spans"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part, size = [], 0
                for text in batch.column(1)[at:]:
                    part.append(text.as_py())
                    size += len(part[-1] or "")
                    if size >= 4 << 20 or len(part) >= 2048:
                        break
                yield scored(batch.column(0)[at : at + len(part)], part)
                at += len(part)

    out = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(common.lean(run), f"doc_id {kind}, score double, predicted int, n_toxic double, spans array<struct<start:long,length:long,probability:double>>")
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)
