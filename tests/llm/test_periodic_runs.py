from __future__ import annotations

import random
import re
from fractions import Fraction
from hashlib import sha256
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from runstar.llm import periodic_runs as pr
from tests.llm.conftest import ODD, prose


def _brute(w):
    """(start, length, period) of every run, from the definition."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            part = w[i:i + length]
            if length >= max(6, 4 * q) and all(part[p:] != part[:-p] for p in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _expected(doc_id, text):
    w = _words(text)
    n = len(w)
    h = crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = _brute(w)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
            sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def _found(texts):
    first = np.cumsum([0, *map(len, texts)])
    runs = pr.find_runs(np.array([x for t in texts for x in t], np.uint64), first)
    return [[tuple(r[1:]) for r in runs.tolist() if r[0] == i] for i in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=0, max_size=7), st.integers(1, 9)), max_size=6), st.integers(0, 3))
def test_runs_by_brute_force(parts, other):
    text = [x for block, times in parts for x in block * times]
    texts = [text, [other] * 5, [], text[::-1], [other] * 9]
    assert _found(texts) == [_brute(t) for t in texts]


def test_nested_runs_and_texts_side_by_side():
    inner = [1, 1, 1, 1, 1, 1, 2]
    texts = [inner * 4, inner * 3, [1, 2] * 40 + [1, 3] * 40, [1] * 5, [1] * 6, list(range(50)) * 4, list(range(50)) * 4 + [0, 1]]
    assert _found(texts) == [_brute(t) for t in texts]
    assert _found([list(range(50)) * 4])[0] == [(0, 200, 50)] and _found([list(range(50)) * 4][0:0]) == []


def _rows():
    rng = random.Random(5)
    rows = [*ODD, *((100 + i, prose(i, rng.choice([3, 30, 200]))) for i in range(80))]
    rows += [(300 + i, " \n".join(["again and again"] * i + [prose(i, 20)] + ["x"] * i)) for i in range(20)]
    return rows


def test_report_by_brute_force(table):
    rows = _rows()
    assert sum(crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i) > 4
    got = pr.run_report(table(rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(_expected(i, t)) for i, t in rows)


def test_long_text_of_one_word(table):
    i = next(i for i in range(1000, 2000) if crc32(str(i).encode()) % 10)
    r = pr.run_report(table([(i, "go " * 400_000), (i, "a b c " * 300_000)])).orderBy("period").collect()
    assert [(x.n_runs, x.start, x.length, x.period, x.exponent_milli) for x in r] == [
        (1, 0, 400_000, 1, 400_000_000), (1, 0, 900_000, 3, 300_000_000)]
    assert r[0].collapsed_sha256 == sha256(b"go").hexdigest() and r[1].collapsed_sha256 == sha256(b"a b c").hexdigest()


def test_rows_and_texts(table, none):
    docs = table(_rows())
    got = {}
    for r in pr.periodic_runs(docs).collect():
        got.setdefault(r.key, set()).add(tuple(r)[1:])
    want = {}
    for i, t in _rows():
        if _brute(_words(t)):
            want.setdefault(i, set()).update(_brute(_words(t)))
    assert got == want
    texts = {r.key: r for r in pr.collapse_runs(docs).collect()}
    assert texts[310].text == " ".join(["again and again"] + _words(prose(10, 20)) + ["x"])
    assert texts[310].n_dropped == 3 * 9 + 9 and texts[1].text == "" and texts[8].n_dropped == 0
    for of in (pr.run_report, pr.periodic_runs, pr.collapse_runs):
        assert of(none).count() == 0
