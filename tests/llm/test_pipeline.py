"""The pipeline on a small fixture, each stage against plain Python on what the stage before kept."""

from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline
from runstar.sources.workspace import Workspace
from tests.llm.conftest import prose
from tests.llm.test_near_dedup import _brute as components
from tests.llm.test_packing import _check
from tests.llm.test_packing import library  # noqa: F401  the tokenizer's own ids
from tests.llm.test_secrets import _brute as spans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _documents():
    passage = prose(999, 60)
    rows = [(i, prose(i, 80 + i)) for i in range(30)]
    rows += [(40, rows[3][1]), (41, rows[3][1] + " extra"), (42, "!!! ??? 123"), (43, None), (44, ""), (45, rows[5][1]), (45, rows[5][1])]
    rows += [(50 + i, prose(500 + i, 70) + " " + passage + " " + prose(600 + i, 20)) for i in range(4)]
    rows += [(60, prose(61, 50) + " password=hunter2222 " + prose(62, 30)), (61, prose(63, 3000))]
    return [(i, t, "en", "src", len(t or "")) for i, t in rows]


@pytest.fixture(scope="module")
def stages(spark):
    work, out = Workspace(spark), []
    docs = work.keep("documents", spark.createDataFrame(_documents(), SCHEMA))
    for name, stage in corpus_pipeline.STAGES:
        docs = work.keep(name, stage(spark, docs, "unused"))
        out.append(docs)
    return out


def _pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_have_the_columns_of_documents(stages):
    assert [s.columns for s in stages[:-1]] == [["doc_id", "text", "lang", "source", "n_chars"]] * 4
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    for s in stages[2:-1]:
        assert all(r.n_chars == len(r.text) for r in s.collect())


def test_language_drops_only_what_has_none(stages):
    want = [(i, t) for i, t, *_ in _documents() if re.search("[a-z]", t or "")]
    assert _pairs(stages[0]) == sorted(want, key=str)


def test_language_is_the_one_that_the_evidence_shows(spark):
    """Of a wrong tag, no tag, a tag with a region, rows that repeat, a language that one row declares, and texts without letters."""
    words = {"en": "the of and to in is that with for this have from", "de": "der die und das nicht mit für ist auch werden über eine"}
    rows = [(100 * k + i, " ".join(words[x].split()[(i * j + j) % 12] for j in range(40)), x, f"https://{x}.example.{x}/", 9)
            for k, x in enumerate(words) for i in range(1, 40)]
    rows += [(900, rows[2][1], "de", "https://en.example.en/", 9)] * 2 + [
        (901, rows[45][1], None, None, 9), (902, rows[3][1], "en-GB", "https://en.example.en/", 9), (903, "12 34", "en", None, 9),
        (904, "это просто русский текст о погоде и о том как мы живём", "ru", "https://ru.example.ru/", 9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in corpus_pipeline.language_id(spark, docs, "unused").collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {i: [r.lang for r in got.pop(i)] for i in (900, 901, 902, 904)} == {900: ["en"] * 2, 901: ["de"], 902: ["en-GB"], 904: ["ru"]}
    assert sorted(tuple(r) for own in got.values() for r in own) == sorted(r for r in rows if r[0] < 900)


def test_one_of_each_group_stays(stages):
    rows = _pairs(stages[0])
    kept = {c for _, _, c in components(rows, corpus_pipeline.SHINGLE)}
    assert _pairs(stages[1]) == sorted({r for r in rows if r[0] in kept}, key=str)


def test_passages_go(stages):
    rows, n = _pairs(stages[1]), corpus_pipeline.PASSAGE
    texts = [WORD.findall(t) for _, t in rows]
    seen = Counter(tuple(w[i:i + n]) for w in texts for i in range(len(w) - n + 1))
    want = []
    for (d, t), w in zip(rows, texts, strict=True):
        gone = {j for i in range(len(w) - n + 1) if seen[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
        want.append((d, " ".join(x for j, x in enumerate(w) if j not in gone) if gone else t))
    assert want != rows and _pairs(stages[2]) == sorted(want, key=str)


def test_secrets_go(stages):
    before, after = dict(_pairs(stages[2])), dict(_pairs(stages[3]))
    assert "hunter" not in after[60] and "[secret]" in after[60]
    assert all(after[i] == t for i, t in before.items() if not spans(t)) and before.keys() == after.keys()


def test_all_that_is_left_is_packed(stages, library):  # noqa: F811
    n, total = _check(_pairs(stages[3]), stages[4].collect(), library, corpus_pipeline.SEQUENCE)
    assert n <= -(-total // corpus_pipeline.SEQUENCE) + 1




def test_sequences_can_be_put_together(stages):
    pieces = stages[-1].collect()
    sequences = {}
    for r in pieces:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.ids))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(len(x) for _, x in own[:k]) for k in range(len(own))]
        assert sum(len(x) for _, x in own) <= corpus_pipeline.SEQUENCE
    assert all(len(r.ids) == r.length for r in pieces) and Counter(r.doc_id for r in pieces).keys() == {
        r.doc_id for r in stages[3].collect()}


def test_empty_table_odd_rows_and_extra_columns(spark):
    schema = SCHEMA + ", node long, key string, text_key string, component string"
    none = spark.createDataFrame([], schema)
    odd = [(i, t, None, None, None, 1, "k", None, "c") for i, t in [(1, None), (2, ""), (None, "no id here at all"), (3, prose(5, 40)),
                                                                   (3, prose(5, 40)), (4, "!!!")]]
    for docs, left in ((none, 0), (spark.createDataFrame(odd, schema), 2)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = Workspace(spark).keep("stage", stage(spark, docs, "unused"))
            assert docs.columns == none.columns
        assert docs.count() == left
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "unused").count() == left
