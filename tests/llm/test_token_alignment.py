from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from runstar.llm import token_alignment as ta
from runstar.llm.bpe import _byte_letters
from tests.llm.conftest import ODD, prose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Library:
    """Whole texts by the two libraries, and groups from their tokens' bytes alone."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        self.letters = {chr(c): b for b, c in _byte_letters().items()}

    def groups(self, text):
        if not text:
            return []
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
             for i in self.b.encode(text) for p in [self.b.id_to_piece(i)]]
        whole = (" " + text).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return []
        out, i, j, m, n = [], 0, 0, 0, 0
        left, right = [], []
        while i < len(a) or j < len(b):
            if m <= n and i < len(a):
                left.append(a[i][0])
                m += len(a[i][1])
                i += 1
            else:
                right.append(b[j][0])
                n += len(b[j][1])
                j += 1
            if m == n:
                out.append((left, right))
                left, right = [], []
        return out


@pytest.fixture(scope="module")
def library():
    return Library()


@pytest.fixture(scope="module")
def aligner():
    name, files = ta._files(A, B)
    return ta._aligner(name, *files)


def _expected(library, rows):
    groups = [library.groups(t) for _, t in rows]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for g in groups]
    count = Counter(p for x in links for p in x)
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (i, _), g, x in zip(rows, groups, links, strict=True):
        listed = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(x.values()),
                    sum(n for p, n in x.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in x.items()),
                    sha256(listed.encode()).hexdigest() if g else ""))
    return out


POOL = "abcS'T 1 29\n\t.,  !?éÉİ文字한ㅎ<|>½▁\u0085᠎​\x1c\x1f\xa0　𝄞\r\x00"


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(POOL, max_size=40), st.text(max_size=20), st.lists(st.sampled_from(
    ["word", " ", "  ", "\n", "\n ", " \n", "<s>", "<0x41>", "<|endoftext|>", "don't", "日本", "\xa0 ", " 　", "𝄞𝄞", "é "]),
    max_size=12).map("".join)))
def test_groups_are_those_of_whole_texts(aligner, library, text):
    assert [(g["a"], g["b"]) for g in ta.aligned_groups(aligner, text)] == library.groups(text)


def test_places_of_groups(aligner):
    text = "naïve 𝄞 日本 unbelievable"
    found = ta.aligned_groups(aligner, text)
    assert found[0]["begin"] == 0 and found[-1]["end"] == len((" " + text).encode())
    assert all(x["end"] == y["begin"] for x, y in zip(found, found[1:], strict=False))


def _rows():
    rng = random.Random(2)
    rows = [*ODD, (20, "a▁b c"), (21, "▁"), (22, " "), (23, "x  "), (24, "tab\t \there \n\n  end \n"), (25, "<|endoftext|> <s> <0x41>"),
            (26, "日本語のテキスト" * 40), (27, "=" * 3000), (28, "".join(rng.choice("abcdef0123456789+/") for _ in range(5000)))]
    rows += [(100 + i, prose(i, rng.choice([5, 60]))) for i in range(60)]
    rows += [(200 + i, "the same copy of a text, 𝄞 and all") for i in range(40)]
    return rows


def test_report_by_brute_force(table, library):
    got = ta.alignment_report(table(_rows()).repartition(5), A, B).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _expected(library, _rows())))


def test_small_caches_and_many_units(spark, table, library, monkeypatch):
    """An emptied cache and other batches change nothing."""
    monkeypatch.setattr(ta, "CACHED", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = ta.alignment_report(table(_rows()).repartition(2), A, B).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _expected(library, _rows())))


def test_groups_as_a_table_and_none(table, none, library):
    got = {r.key: [(g.a, g.b) for g in r.groups] for r in ta.align(table(_rows()), A, B).collect()}
    assert got[26] == library.groups(dict(_rows())[26]) and got[20] == [] and got[1] == []
    assert ta.alignment_report(none, A, B).count() == 0 and ta.align(none, A, B).count() == 0


def test_other_files_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        ta.Aligner(f.read(), b"")
