"""Suffix orders of many short strings at once, by linear grouping: suffixes are grouped by their longest Lyndon prefix, then each group's order is emitted."""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Where a run of rows that are equal in all keys begins."""
    new = np.ones(len(keys[0]), bool)
    if len(new) > 1:
        np.not_equal(keys[0][1:], keys[0][:-1], out=new[1:])
        for key in keys[1:]:
            new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def suffix_order(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The suffix arrays of strings laid out one after the other: in each string's places, its positions by rising suffix.

    text holds uint16; starts are where strings begin. Each string ends with a 0, which is found in no other place of it.

    All strings go through the steps together; each step takes the highest group of each string that still has one to process.

    1. Groups begin as the suffixes with an equal first character, and are held as ranges of the order. The highest group's suffixes are final: their common prefix is their longest Lyndon prefix. What is processed leaves a list of positions, so that a suffix's left neighbour in it is the previous smaller suffix, or one of its own group; runs of the latter share the pointer of their first. A suffix that m such pointers lead to has its prefix extended by m copies of the group's. Of each group, suffixes so extended go up, into new groups behind the rest, in the order of m.
    2. A suffix is its Lyndon prefix, repeated k times, then a smaller suffix, its root. Within a group suffixes stand by k, then by their root's place; a group is emitted once all roots are placed, which lie in lower groups.
    """
    n = len(text)
    ends = np.append(starts[1:], n)
    string = np.repeat(np.arange(len(starts)), ends - starts)
    order = np.argsort(text, kind="stable")
    order = order[np.argsort(string[order].astype(np.uint16 if len(starts) < 1 << 16 else np.int64), kind="stable")].astype(np.int32)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    first = _changes(string[order], text[order])
    group, size = np.empty(n, np.int32), np.zeros(n, np.int32)
    size[first] = np.diff(np.append(first, n))
    group[order] = np.repeat(first, size[first])
    del string
    left, right = np.arange(-1, n, dtype=np.int32), np.arange(1, n + 2, dtype=np.int32)  # place n stands for none
    left[starts], right[ends - 1] = n, n
    repeats, root = np.ones(n, np.int32), np.full(n, n, np.int32)
    moved = np.zeros(n, bool)

    base, top = starts.copy(), ends.copy()
    while True:
        going = top - base > 1
        if not going.all():
            base, top = base[going], top[going]
            if not len(base):
                break
        low = group[order[top - 1]].astype(np.int64)
        members = order[_ranges(low, top - low)] if (top - low).max() > 1 else order[low]
        members = np.sort(members)  # strings lie in order, so that this sorts in each
        top = low
        before = left[members]
        new = np.ones(len(members), bool)
        np.not_equal(before[1:], members[:-1], out=new[1:])
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(members)))
        target, after = before[first], right[members[np.append(first[1:], len(members)) - 1]]
        right[target], left[after] = after, target
        root[members] = np.repeat(after, length)
        if len(first) < len(members):
            repeats[members] = np.repeat(length + first, length) - np.arange(len(members))
        there = target < n
        if not there.all():
            target, length = target[there], length[there]
            if not len(target):
                continue
        of = group[target]
        if length.max() > 1:
            by = np.lexsort((length, of))
        else:
            by = np.argsort(of, kind="stable")
        target, of, length = target[by], of[by], length[by]
        begin = _changes(of)
        count = np.diff(np.append(begin, len(of)))
        old = of[begin]
        tail = old + size[old] - count
        to = _ranges(tail, count).astype(np.int32)
        was, there = place[target], order[to]
        moved[target] = True
        out = there[~moved[there]]
        if len(out):
            holes = was[was < np.repeat(tail, count)]
            order[holes], place[out] = out, holes
        moved[target] = False
        order[to], place[target] = target, to
        size[old] -= count.astype(np.int32)
        begin = _changes(of, length)
        size[to[begin]] = np.diff(np.append(begin, len(of)))
        group[target] = np.repeat(to[begin], size[to[begin]])

    rank = np.full(n + 1, -1, np.int32)
    single = size[group] == 1
    rank[:-1][single] = group[single]
    waiting = order[~single[order]]
    while len(waiting):
        behind = rank[root[waiting]]
        begin = _changes(group[waiting])
        count = np.diff(np.append(begin, len(waiting)))
        ready = np.repeat(np.minimum.reduceat(behind, begin) >= 0, count)
        now = waiting[ready]
        now = now[np.lexsort((behind[ready], repeats[now], group[now]))]
        begin = _changes(group[now])
        count = np.diff(np.append(begin, len(now)))
        at = _ranges(group[now[begin]].astype(np.int64), count)
        order[at], rank[now] = now, at
        waiting = waiting[~ready]
    return order
