from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from runstar.llm import substring_dedup
from runstar.llm.fm_index import Index, WaveletMatrix
from tests.llm.conftest import ODD, WORDS, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(rows, window):
    texts = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, texts, strict=True):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def _rows():
    passage, short = prose(999, 45), prose(998, 34)
    rows = [*ODD, (50, prose(1, 200)), (51, prose(1, 200)), (52, prose(2, 60) + " " + passage + " " + prose(3, 10)),
            (53, passage + "\n\t" + prose(4, 50)), (54, short + " x " + prose(5, 40)), (55, short + " y " + prose(6, 40)),
            (56, "again and again " * 60), (57, passage), (58, passage), (58, passage), (60, prose(7, 30_000))]
    rng = random.Random(1)
    for i in range(30):  # edited copies
        w = prose(8, 300).split()
        for _ in range(i % 7):
            w[rng.randrange(300)] = "edit"
        rows.append((100 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize(("hot", "shard"), [(50_000, 1 << 19), (2, 200)])
def test_report_by_brute_force(table, monkeypatch, hot, shard):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "SHARD", shard)
    rows = _rows()
    got = substring_dedup.removal_report(table(rows), 35).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == _brute(rows, 35)


def test_rewritten_texts_and_empty_table(table, none):
    rows = _rows()
    docs = table(rows)
    out = substring_dedup.remove_repeats(docs, 35)
    assert out.columns == docs.columns
    want = {(d, n, k, h) for d, n, k, h in _brute(rows, 35)}
    texts = dict(rows)
    for r in out.collect():
        kept = " ".join(WORD.findall(r.text or ""))
        assert any(x[0] == r.doc_id and x[3] == sha256(kept.encode()).hexdigest() for x in want)
        if not any(x[0] == r.doc_id and x[2] for x in want):
            assert r.text == texts[r.doc_id]
    assert substring_dedup.remove_repeats(none, 35).count() == 0 == substring_dedup.removal_report(none).count()


def test_index_by_brute_force():
    rng = random.Random(2)
    sequences = list({tuple(rng.randrange(1, 5) for _ in range(rng.randint(6, 30))) for _ in range(60)})
    weights = [rng.randint(1, 3) for _ in sequences]
    arrays = [np.array(s, np.int64) for s in sequences]
    seen = Counter()
    for s, w in zip(sequences, weights, strict=True):
        for i in range(len(s) - 5):
            seen[s[i:i + 6]] += w
    got = Index(arrays, weights, 6).window_weights(arrays)
    assert [x.tolist() for x in got] == [[seen[s[i:i + 6]] for i in range(len(s) - 5)] for s in sequences]


def test_ranks():
    symbols = np.random.default_rng(1).integers(0, 37, 1000)
    tree, at = WaveletMatrix(symbols, 36), np.array([0, 1, 63, 64, 65, 500, 1000])
    for s in (0, 1, 17, 36):
        assert tree.rank(np.full(len(at), s), at).tolist() == [int((symbols[:i] == s).sum()) for i in at]


def test_unusual_words_only(table):
    rows = [(i, " ".join(WORDS) * 2) for i in range(3)]
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in
                  substring_dedup.removal_report(table(rows)).collect()) == _brute(rows, 35)
