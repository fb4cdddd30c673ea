"""The first few of many scored rows, kept while blocks of them pass by in a task."""

from __future__ import annotations

import numpy as np


class Best:
    """The k best rows that each of n slots was offered: higher scores first, ties by the smaller id. What it holds is n times k, however many rows pass."""

    def __init__(self, n: int, k: int, score: type, id_: type | np.dtype):
        self.k, self.least = k, -np.inf if np.dtype(score).kind == "f" else np.iinfo(score).min
        self.scores, self.ids, self.held = np.full((n, k), self.least, score), np.zeros((n, k), id_), np.zeros(n, np.int64)

    def floor(self, slots: np.ndarray) -> np.ndarray:
        """What a score must reach to be kept; the least of all numbers where a slot has room."""
        return self.scores[slots, -1]

    def offer(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Rows, each for a slot."""
        if not len(slots):
            return
        had = np.unique(slots)
        there = np.arange(self.k) < self.held[had][:, None]
        slots = np.concatenate([np.repeat(had, self.k)[there.ravel()], slots])
        scores, ids = np.concatenate([self.scores[had][there], scores]), np.concatenate([self.ids[had][there], ids])
        order = np.lexsort((ids, -scores, slots))
        slots, scores, ids = slots[order], scores[order], ids[order]
        begins = np.flatnonzero(np.diff(slots, prepend=slots[0] - 1))
        sizes = np.diff(begins, append=len(slots))
        place = np.arange(len(slots)) - np.repeat(begins, sizes)
        first = place < self.k
        self.scores[slots[first], place[first]], self.ids[slots[first], place[first]] = scores[first], ids[first]
        self.held[slots[begins]] = np.minimum(sizes, self.k)

    def offer_tile(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, wanted: np.ndarray | None = None, digits: int | None = None) -> None:
        """Scores of slots and rows, all or where wanted; they are rounded to so many digits first, where given. Only those that can be among the best are looked at one by one."""
        slack = 0 if digits is None else 2 * 10.0**-digits  # twice as much as rounding can part two scores
        near = scores >= self.floor(slots)[:, None] - slack
        wanted = near if wanted is None else wanted & near
        many = 4 * self.k * len(slots) if scores.shape[1] > self.k else scores.size
        if np.count_nonzero(wanted) > many:  # at the start
            kth = np.partition(np.where(wanted, scores, self.least), -self.k, axis=1)[:, -self.k, None]
            wanted &= scores >= kth - slack
        if np.count_nonzero(wanted) > many:  # many are equal: of those the ones with the smallest ids
            by_id = np.argsort(ids, kind="stable")
            ids, wanted, scores = ids[by_id], wanted[:, by_id], scores[:, by_id]
            scores, digits = scores if digits is None else np.round(scores, digits), None
            scores = np.where(wanted, scores, self.least)
            kth = np.partition(scores, -self.k, axis=1)[:, -self.k, None]
            equal = wanted & (scores == kth)
            wanted = wanted & (scores > kth) | equal & (np.cumsum(equal, axis=1) <= self.k)
        i, j = np.nonzero(wanted)
        found = scores[i, j] if digits is None else np.round(scores[i, j], digits)
        self.offer(slots[i], found, ids[j])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slot, score and id of all that is held, slot by slot, best first."""
        there = np.arange(self.k) < self.held[:, None]
        return np.repeat(np.arange(len(self.held)), self.held), self.scores[there], self.ids[there]
