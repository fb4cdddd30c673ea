"""Plain versions of the operators, for small inputs."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

from talkmill.llm import mixing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    seen, covered = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), set()
    for i in range(len(w) - 4):
        if seen[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def _classes(text):
    kinds = [str.islower, lambda c: c in " \t\n\x0b\f\r", str.isupper, str.isdecimal, lambda c: c in ".,;:'\"()?!-"]
    out = [0] * 6
    for c in text or "":
        out[next((i for i, k in enumerate(kinds) if k(c)), 5)] += 1
    return out


def _js(a, b):
    ta, tb = sum(a), sum(b)
    if not ta or not tb:
        return None
    d = 0.0
    for x, y in zip(a, b):
        p, q = x / ta, y / tb
        m = (p + q) / 2
        d += ((p * math.log2(p / m) if p else 0) + (q * math.log2(q / m) if q else 0)) / 2
    return math.sqrt(max(d, 0.0))


def judged(docs):
    """{doc_id: kept} of op1's rules; docs: (doc_id, text, lang, source)."""
    hist, refs = {}, defaultdict(lambda: ([0] * 6, [0] * 21))
    passes = {}
    for i, text, lang, _ in docs:
        n_words, *_, rep = base(text)
        passes[i] = n_words >= 10 and 100 * rep <= 20 * n_words
        listed = quality.COMMON_WORDS.get(lang)
        low = [w.lower() for w in words(text)]
        common = [low.count(k) for k in listed] if listed else []
        common += [len(low) - sum(common)] if listed else []
        hist[i] = (lang if listed else "other", len(low), _classes(text), common)
        if len(low) >= 50 and passes[i]:
            r = refs[hist[i][0]]
            for into, add in zip(r, hist[i][2:]):
                for k, x in enumerate(add):
                    into[k] += x
    out = {}
    for i, text, _, _ in docs:
        ref, n, classes, common = hist[i]
        ok = passes[i]
        if ok and n >= 50:
            chance = lambda bins, size: math.sqrt((bins - 1) / (8 * math.log(2)) / max(size, 1))
            c, w = _js(classes, refs[ref][0]), _js(common, refs[ref][1]) if common else None
            ok = (c is None or round(c, 6) - chance(6, len(text)) <= 0.22) and (w is None or round(w, 6) - chance(21, n) <= 0.11)
        out[i] = ok
    return out


def without_lines(docs):
    """{doc_id: text} after op2; docs: (doc_id, text ...)."""
    first, parts = {}, {}
    for i, text, *_ in docs:
        lines = (text or "").split("\n")
        full = [k for k, x in enumerate(lines) if WORD.search(x)]
        bare = [lines[k].strip(" \t\n\x0b\f\r") for k in full]
        parts[i] = (lines, full, bare)
        for k in range(len(bare) - 2):
            key = tuple(bare[k : k + 3])
            first[key] = min(first.get(key, (math.inf, 0)), (i, k))
    out = {}
    for i, (lines, full, bare) in parts.items():
        gone = set()
        for k in range(len(bare) - 2):
            if first[tuple(bare[k : k + 3])] != (i, k):
                gone.update(full[k : k + 3])
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(docs):
    """{doc_id: least id of its group}; docs: (doc_id, text ...)."""
    sets = {i: shingles(t) for i, t, *_ in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x = len(sets[a] & sets[b])
        if x and 100 * x >= 75 * (len(sets[a]) + len(sets[b]) - x):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def sampled(docs, fraction=0.8, seed="mix"):
    """{doc_id: sampled} of op8; docs: (doc_id, text, lang, source)."""
    t, cell, size = mixing.TARGETS, {}, Counter()
    pool = lambda x, dim: x if x in t[dim] and x != "other" else "other"
    for i, text, lang, source in docs:
        n = len(words(text))
        topic = next((name for name, p in mixing.TOPICS if re.search(p.replace("\\\\", "\\"), text or "")), "short" if n < 100 else "other")
        cell[i] = (pool(source, "source"), pool(lang, "lang"), topic)
        size[cell[i]] += n
    there = [{c[k] for c in size} for k in range(3)]
    share = [{v: t[d][v] / sum(t[d][x] for x in there[k]) for v in there[k]} for k, d in enumerate(t)]
    total = sum(size.values())
    part = {c: n / total for c, n in size.items()}
    w = dict(part)
    for _ in range(mixing.ROUNDS):
        for k in range(3):
            sums = defaultdict(float)
            for c, x in w.items():
                sums[c[k]] += x
            w = {c: x * share[k][c[k]] / sums[c[k]] if sums[c[k]] else 0.0 for c, x in w.items()}
        w = {c: max(min(x, part[c] / fraction), part[c] / mixing.TRIM) for c, x in w.items()}
    p = {c: round(min(1.0, fraction * w[c] / part[c]), 6) if part[c] else 1.0 for c in w}
    return {i: int(hashlib.md5(f"{seed}|{i}".encode()).hexdigest()[:8], 16) / 2**32 < p[cell[i]] for i in cell}
