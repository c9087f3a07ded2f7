from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
import pyarrow as pa

from runstar.llm import fingerprints as fp
from runstar.llm.hashing import mix, running, spans
from tests.llm.conftest import ODD, prose


def _brute(text, gram=fp.GRAM, window=fp.WINDOW):
    total = running(mix(np.array([ord(c) for c in text], np.uint64) + np.uint64(1)))
    n = len(text)
    if not n:
        return []
    gram = min(gram, n)
    hashes = [int(spans(total, np.array([i]), np.array([i + gram]))[0]) for i in range(n - gram + 1)]
    out = set()
    for s in range(max(1, len(hashes) - window + 1)):
        part = hashes[s:s + window]
        place = max(i for i, h in enumerate(part) if h == min(part))
        out.add((s + place, part[place]))
    return sorted(out)


def test_marks_by_brute_force():
    rng = random.Random(1)
    texts = [None, "", "a", "x" * 300, *("".join(rng.choice("abé 𝄞") for _ in range(rng.choice([10, 30, 63, 64, 65, 400])))
                                         for _ in range(40))]
    got = [[(int(p), int(h)) for h, p in zip(*m, strict=True)] for m in fp.winnow(pa.array(texts))]
    assert got == [_brute(t or "") for t in texts]


def test_shared_passages_share_a_mark():
    passage = prose(1, 40)[:fp.GRAM + fp.WINDOW - 1]
    a, b = fp.winnow(pa.array([prose(2, 50) + passage + prose(3, 50), prose(4, 90) + passage + prose(5, 10)]))
    assert set(a[0].tolist()) & set(b[0].tolist())


def _expected(rows):
    line = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, t), (_, n) in zip(line, line[1:] + line[:1], strict=True):
        t, n = t or "", n or ""
        half = len(t) // 2
        changed = t[:len(t) - half] + n[:half]
        out.append((i, len(t), sha256(changed.encode()).hexdigest()))
    return sorted(out, key=str)


def test_edits_and_neighbours(table):
    rows = [r for r in dict(ODD).items()] + [(100 + i, prose(i, 5 * i)) for i in range(60)] + [(400, prose(9, 30_000))]
    got = fp.compare_with_edits(table(rows)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == _expected(rows)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(dict(rows)[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    long = [r for r in got if r.n_chars > 800]
    assert all(0.15 < r.near_edited < 0.8 for r in long) and max(r.near_next for r in long) < 0.1


def test_repeated_rows_one_row_and_none(table, none):
    assert fp.compare_with_edits(none).count() == 0
    same = fp.compare_with_edits(table([(5, "same text")] * 3)).collect()
    assert len(same) == 3 and {(r.near_edited, r.near_next) for r in same} <= {(0.0, 1.0), (1.0, 1.0)}
    alone = fp.compare_with_edits(table([(1, "abcd")])).first()
    assert alone.edited_sha256 == sha256(b"abab").hexdigest()


def test_places(table):
    r = fp.fingerprints(table([(1, prose(1, 60))])).first()
    assert [(m.place, m.hash % (1 << 64)) for m in r.marks] == _brute(prose(1, 60))
