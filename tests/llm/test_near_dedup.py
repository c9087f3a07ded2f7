from __future__ import annotations

import random
import re

import numpy as np
import pytest

from runstar.llm import near_dedup
from runstar.llm.components import components
from runstar.sources.workspace import Workspace
from tests.llm.conftest import ODD, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text, size):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def _brute(rows, size, percent=80):
    sets = [_set(t, size) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    ids = {}
    for (d, _), x in zip(rows, label, strict=True):
        ids[x] = min([y for y in (ids.get(x), d) if y is not None], default=None)
    return sorted(((d, len(s), ids[x]) for (d, _), s, x in zip(rows, sets, label, strict=True)), key=str)


def _edited(text, n, seed):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("size", [2, 5])
def test_components_by_brute_force(table, size):
    base = prose(1, 200)
    rows = [*ODD, (20, base), (21, base.upper()), *((30 + i, _edited(base, i // 2, i)) for i in range(24)),
            *((60 + i, prose(100 + i, 30 + i)) for i in range(20))]
    # a chain: each is like the next, the ends aren't
    chain = prose(50, 120)
    for i in range(8):
        rows.append((90 - i, chain))
        chain = _edited(chain, 4, 900 + i)
    found = near_dedup.near_duplicates(table(rows), size).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == _brute(rows, size)
    firsts = {}
    for r in found:
        firsts.setdefault(r.component_id if r.n_shingles else (r.doc_id, r.node), []).append(r)
    for own in firsts.values():
        assert [r.first for r in own].count(True) == 1
        assert next(r.doc_id for r in own if r.first) == own[0].component_id


def test_long_text_and_empty_table(table, none):
    long = prose(3, 60_000)
    found = near_dedup.near_duplicates(table([(1, long), (2, long + " more"), (3, "x")]), 2).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3}
    assert near_dedup.near_duplicates(none).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 3, 50, 5000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        assert (near_dedup.sketch(a) != near_dedup._EMPTY).all()
        assert (near_dedup.sketch(a) == near_dedup.sketch(a[::-1].copy())).all()
    whole = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    x, y = near_dedup.sketch(whole[:900]), near_dedup.sketch(whole[100:])
    assert abs((x == y).mean() - 0.8) < 0.1


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 102), (102, 101)], "a long, b long")
    got = {r.node: r.component for r in components(links, Workspace(spark)).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def _fast_brute(rows, size):
    """The same as ``_brute`` for many sets, by counts of common elements."""
    sets = [_set(t, size) for _, t in rows]
    place = {e: i for i, e in enumerate(sorted({e for s in sets for e in s}))}
    holds = np.zeros((len(sets), len(place)), np.float32)
    for i, s in enumerate(sets):
        holds[i, [place[e] for e in s]] = 1
    both, n = holds @ holds.T, np.array([len(s) for s in sets])
    linked = 100 * both >= 80 * (n[:, None] + n - both)
    label = np.arange(len(sets))
    while True:
        least = np.where(linked, label, len(sets)).min(1)
        if (least == label).all():
            break
        label = least
    ids = np.array([d for d, _ in rows])
    return sorted((int(ids[i]), int(n[i]), int(ids[label == label[i]].min())) for i in range(len(rows))), linked


@pytest.mark.parametrize("size, low, high", [(2, 2, 12), (5, 1, 6)])
def test_many_copies_around_the_threshold(spark, table, size, low, high):
    """One text changed in many places, three ways, and copies of copies: similarities from 0.5 to 0.95, all in the same buckets."""
    rng, base, few = random.Random(size), prose(77, 150).split(), [f"w{i}" for i in range(40)]
    texts = [base]
    for i in range(1500):
        w = list(base if i % 5 else rng.choice(texts))
        for _ in range(rng.randrange(low, high)):
            at = rng.randrange(len(w))
            how = rng.random()
            if how < 0.5:
                w[at] = rng.choice(few) if how < 0.2 else f"new{rng.randrange(10**6)}"
            elif how < 0.75:
                del w[at]
            else:
                w.insert(at, rng.choice(few))
        texts.append(w[:len(w) - rng.choice([0, 0, 0, 5, 10])])
    rows = [(1000 + i, " ".join(w)) for i, w in enumerate(texts)]
    rng.shuffle(rows)
    want, linked = _fast_brute(rows, size)
    assert 0.01 < linked.mean() < 0.9 and len({c for _, _, c in want}) > 20
    work = Workspace(spark)
    found = near_dedup.near_duplicates(table(rows).repartition(4), size, work=work).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == want
    # far fewer comparisons than pairs
    rarest = spark.read.parquet(work.path("rarest"))
    assert near_dedup._close_pairs(rarest, 80).count() < 0.15 * len(rows) ** 2 / 2


def test_templates_below_the_threshold(spark, table):
    """Texts of four templates in a cluster whose hub is of one of them: what the others' texts share is in all their differences. Only
    planted copies are linked, and pairs of other texts are not compared for what a template gives them."""
    rng, rows, templates = random.Random(5), [], [prose(900 + i, 30).split() for i in range(4)]
    shared = prose(899, 14).split()
    for i in range(800):
        own = [f"x{rng.randrange(10**7)}" for _ in range(rng.randrange(8, 12))]
        w = shared + templates[i % 4] + own
        rows.append((i, " ".join(w)))
        if i % 40 == 0:
            rows.append((5000 + i, " ".join(w + ["more"])))
    want, _ = _fast_brute(rows, 2)
    work = Workspace(spark)
    found = near_dedup.near_duplicates(table(rows).repartition(4), 2, work=work).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == want
    # hardly more comparisons than the 20 planted copies need
    assert near_dedup._close_pairs(spark.read.parquet(work.path("rarest")), 80).count() < 100
