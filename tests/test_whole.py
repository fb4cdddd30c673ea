"""Queries that have no SQL take in all of their tables: held against plain versions."""

import math
import os
import random

import pytest

from talkmill import queries
from talkmill.operators import sampling
from talkmill.operators.turns import CLIP_S, LEAD_IN_S

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


def test_offset_scan_hears_all_people(spark):
    types, ratios = ["click", "view", "error", "purchase", "signup"], [1.0, 0.75, 0.5, 0.3628, 0.3333]
    unit = lambda v: [x / math.sqrt(sum(y * y for y in v)) for x in v]
    rows = [(r["vec_id"], r["label"], list(map(float, r["embedding"]))) for r in queries.table(spark, SF, "embeddings").collect()]
    voices = {}
    for label in sorted({x[1] for x in rows}):
        own = [v for i, k, v in rows if k == label and i % 2 == 0]
        voices[f"{types[label % 5]}-{label // 5}"] = unit([sum(x) / len(own) for x in zip(*own)])
    assert len(voices) == 10
    sets = max(x[1] for x in rows) // 5 + 1
    turns = {}
    for t in queries.event_turns(spark, SF).collect():
        turns.setdefault(t["episode"] % 50, []).append((t["start"], t["episode"], t["turn_idx"], t["duration_s"], f"{t['speaker']}-{t['turn_idx'] % sets}"))
    want = {r: [0, 0, 0, 0] for r in ratios}
    for i, _, v in rows:
        best = max(voices, key=lambda c: sum(a * b for a, b in zip(unit(v), voices[c])))
        mine = sorted(turns.get(i % 50, []))
        for r in ratios:
            t = i * 997.0 * r
            heard = next((s for b, _, _, n, s in mine if b - mine[0][0] <= t < b - mine[0][0] + n), None)
            want[r][2 if heard is None else 3 if heard not in voices else 0 if heard == best else 1] += 1
    share = {r: h / (h + m) if h + m else 0.0 for r, (h, m, *_) in want.items()}
    got = {x["r"]: x for x in queries.QUERIES["a32_offset_scan"](spark, SF).collect()}
    assert {r: [x["hit"], x["miss"], x["uncovered"], x["no_reference"]] for r, x in got.items()} == want
    assert sum(w[0] + w[1] for w in want.values()) > 0 and [r for r in ratios if got[r]["peak"]] == [max(ratios, key=lambda r: share[r])]


def order_of(seed, n):
    order = list(range(n))
    random.Random(seed).shuffle(order)
    return order


def test_seeded_draws_are_those_of_the_generator(spark):
    turns = {}
    for t in queries.event_turns(spark, SF).collect():
        if t["duration_s"] >= LEAD_IN_S + CLIP_S:
            turns.setdefault((t["episode"], t["speaker"]), []).append(t["turn_idx"])
    want = {k: sorted(v)[order_of("campaign-1", len(v))[1 % len(v)]] for k, v in turns.items()}
    assert {(r["episode"], r["speaker"]): r["turn_idx"] for r in queries.QUERIES["w10_seeded_draw"](spark, SF).collect()} == want


def spaced(items, target):
    return items if target >= len(items) else [items[int(i * (len(items) / target))] for i in range(target)]


@pytest.mark.parametrize("sf, sample", [(SF, 150), (SF.replace("0.001", "0.01"), 30)])
def test_clip_plan_against_a_plain_one(spark, sf, sample):
    """What the plan holds and counts, from lists of turns and episodes; with few picks, so that substitutes are needed."""
    given = queries._plan_inputs(spark, sf)
    turns, gone = {}, {r["episode"] for r in given["unavailable"].collect()}
    for t in sorted(given["turns"].collect(), key=lambda t: t["turn_idx"]):
        turns.setdefault((t["episode"], t["speaker"]), []).append((t["start"], t["duration_s"]))
    of = lambda e, who, least: [t for t in turns.get((e, who), []) if t[1] >= least]
    episodes = sorted(given["episodes"].collect(), key=lambda e: (e["show"], e["date"], e["episode"]))
    able = [e for e in episodes if not e["second_tier"] and e["dominant"] and of(e["episode"], e["dominant"], 12)]
    old, new = [e for e in able if e["year"] < "2026"], [e for e in able if e["year"] >= "2026"]
    picks = spaced(list(range(len(old))), sample)
    taken, chosen, moved = set(picks), [], {}
    for i in picks:
        if old[i]["episode"] in gone:
            free = next((j for j in range(i + 1, len(old)) if j not in taken and old[j]["episode"] not in gone), None)
            moved[old[i]["episode"]] = None if free is None else old[free]["episode"]
            if free is None:
                continue
            taken.add(free)
            i = free
        chosen.append(i)
    first, later = [old[i] for i in sorted(chosen)], [e for e in new if e["episode"] not in gone]
    want = {}

    def add(e, who, purpose, draw, seed, least, lead, length, mark):
        found = of(e["episode"], who, least)
        if found:
            start, n = found[order_of(seed, len(found))[draw % len(found)]]
            cut = (start + lead, min(length, n - lead)) if n > lead else (start, min(length, n))
            want.setdefault(f"{e['episode'][:-4]}--{who}--{mark}{draw}", [set(), start, *cut])[0].add(purpose)
        return bool(found)

    for e in first + later:
        add(e, e["dominant"], "precision", 0, f"campaign-1:{e['episode']}", 12, 2, 10, "d")
    some = spaced(first, 20) + spaced(later, 10)
    covered = [(e, who) for e in some for who in sorted({k[1] for k in turns if k[0] == e["episode"]}) if add(e, who, "coverage", 0, f"campaign-1:{e['episode']}", 12, 2, 10, "d")]
    enough = [(e, who) for e, who in covered if len(of(e["episode"], who, 6)) >= 10]
    for e, who in spaced(enough, 15):
        for draw in range(10):
            add(e, who, "impurity", draw, f"campaign-1:{e['episode']}:{who}", 6, 1, 5, "i")
    parts = sampling.clip_parts(**given, sample=sample)
    got = {r["clip_id"]: [set(r["purposes"]), r["turn_start"], r["clip_start_s"], r["clip_length_s"]] for r in parts["plan"].collect()}
    assert got == want and len(want) > 20
    assert {r["replaced"]: r["by"] for r in parts["substitutions"].collect()} == moved and moved
    assert {r["episode"] for r in parts["lost"].collect()} == {e["episode"] for e in new if e["episode"] in gone}
    counts = parts["counts"].first().asDict()
    assert counts == {
        "old_pool": len(old), "old_selected": len(first), "substituted": sum(v is not None for v in moved.values()), "not_substituted": sum(v is None for v in moved.values()),
        "recent_lost": len(new) - len(later), "recent_selected": len(later), "second_tier": sum(e["second_tier"] for e in episodes), "no_clippable_turn": sum(not e["second_tier"] and e["dominant"] is not None for e in episodes) - len(able),
        "coverage_episodes": len({e["episode"] for e, _ in covered}), "coverage_clusters": len(covered), "impurity_clusters": min(15, len(enough)), "impurity_too_short": len(covered) - len(enough), "old_stride": len(old) / len(first) if first else 0.0,
    }


def test_queries_of_the_plan_are_whole(spark):
    counts = queries.QUERIES["a43_plan_counts"](spark, SF).first()
    plan = queries.QUERIES["h9_clip_plan"](spark, SF).where("array_contains(purposes, 'precision')")
    assert plan.count() == counts["old_selected"] + counts["recent_selected"] > 0
