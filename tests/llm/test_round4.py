"""The similarity join on groups of near copies that are just not similar enough, and its tables by part."""

import random

import numpy as np

from epiframe.llm import jaccard
from epiframe.llm.common import Scratch

SCHEMA = "doc_id long, text string"
TAGGED = "doc_id long, text string, tag string"


def edited(group: int, copies: int, edits: int) -> list[str]:
    """Copies of one text of 300 words, each with so many words of its own."""
    rng = random.Random(group)
    base = [f"g{group}w{rng.randrange(10**6)}" for _ in range(300)]
    out = []
    for i in range(copies):
        w = list(base)
        for at in rng.sample(range(300), edits):
            w[at] = f"e{group}x{i}x{at}"
        out.append(" ".join(w))
    return out


def sets_of(texts, size):
    words = [t.split() for t in texts]
    return [{tuple(w[i : i + size]) for i in range(len(w) - size + 1)} for w in words]


def similar(a, b, percent):
    return 100 * len(a & b) >= percent * len(a | b)


def test_parity_maps_bound_the_difference():
    rng = np.random.default_rng(4)
    for n in (1, 5, 300, 3000):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[n // 5 :], rng.integers(0, 2**63, n // 7).astype(np.uint64)])
        maps = [jaccard.parity_map(np.sort(x)) for x in (a, b)]
        assert all(m.dtype == np.int64 and len(m) == jaccard.MAP for m in maps)
        flipped = sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(maps[0].tolist(), maps[1].tolist(), strict=True))
        assert flipped <= len(set(a.tolist()) ^ set(b.tolist())) and (n > 300 or flipped >= (n // 5 + n // 7) // 2)


def test_near_misses_leave_few_pairs(spark):
    """Pairs of a group at a similarity of about 0.67 are not compared one by one."""
    texts = edited(1, 60, 6) + edited(2, 8, 2)
    rows = list(enumerate(texts))
    sets = sets_of(texts, 5)
    links = {(a, b) for b in range(len(rows)) for a in range(b) if similar(sets[a], sets[b], 80)}
    assert len(links) < 60 and any(a >= 60 for a, _ in links)
    join = jaccard.Join(spark.createDataFrame([(*r, None) for r in rows], TAGGED).repartition(3), 5, 80)
    named = {r.id: r.doc_id for r in join.reps.collect()}
    left = join.remaining(None).collect()
    pairs = [tuple(sorted((named[r.a], named[r.b]))) for r in left]
    assert len(pairs) == len(set(pairs)) and links <= set(pairs)
    assert len(pairs) < len(links) + 60  # 1770 pairs of the first group share lists
    join.scratch.clear()


def test_long_and_short_sets_keep_their_links(spark):
    """Linked pairs whose sets have more tokens than the maps have bits, or fewer than a window, are found."""
    rng = random.Random(9)
    long = [f"l{rng.randrange(10**6)}" for _ in range(3000)]
    other = [w if i % 40 else f"o{i}" for i, w in enumerate(long)]  # five in 40 windows differ: similarity 0.78
    near = [w if i % 60 else f"n{i}" for i, w in enumerate(long)]
    texts = [" ".join(long), " ".join(other), " ".join(near), "a b", "a  B", "a b c", "x", "", *edited(3, 12, 4), *edited(4, 12, 6)]
    sets = sets_of(texts, 5)
    for i, t in enumerate(texts):
        sets[i] = sets[i] or ({tuple(t.lower().split())} if t.split() else set())
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and similar(sets[a], sets[b], 80):
                label = [label[b] if x == label[a] else x for x in label]
    expected = {i: min(j for j in range(len(texts)) if label[j] == label[i]) for i in range(len(texts))}
    got = jaccard.near_classes(spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(4), 5, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == expected


def test_sets_and_lists_are_built_by_part(spark, monkeypatch):
    """No table that holds the prefixes, nor a shuffle for it, has much more than its part of the sets."""
    rows = [(i, t) for i, t in enumerate(edited(5, 40, 4) + [" ".join(f"u{i}w{j}" for j in range(60)) for i in range(200)])]
    rows += [(1000 + i, t) for i, t in rows[:50]]
    wide, cut = [], Scratch.cut

    def watch(self, df, name="table"):
        out = cut(self, df, name)
        if name == "reps" and "prefix" in out.columns:
            wide.append([r.id for r in out.collect()])
        return out

    monkeypatch.setattr(Scratch, "cut", watch)
    join = jaccard.Join(spark.createDataFrame([(*r, None) for r in rows], TAGGED), 5, 80)
    numbers = [i for part in wide for i in part]
    assert len(wide) == jaccard.SLICES and max(map(len, wide)) < 120
    assert len(numbers) == len(set(numbers)) == 240 == join.reps.count()
    assert sorted(numbers) == sorted(r.id for r in join.reps.collect())
    assert join.core.count() == 40
    join.scratch.clear()
