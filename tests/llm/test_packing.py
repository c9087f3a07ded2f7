from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from runstar.llm import bpe, packing
from runstar.llm.bpe import Encoder
from tests.llm.conftest import ODD, prose

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'", "s", "t", "re", "ll", "d", "a", " ", "  ", "\n", "\t", "é", "ß", "1", "٣", "½", "!", "…", " ", "　", "𝄞", "中",
         "<|endoftext|>", "'ve", "’s", "_", "\x1c", "\x85", "​", "é", "\r\n", "'S"]


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(VOCABULARY)
    out.encode_special_tokens = True
    return lambda t: out.encode(t or "", add_special_tokens=False).ids


def test_ids_are_the_librarys(library):
    rng = random.Random(3)
    texts = [None, "", *(t for _, t in ODD), *("".join(rng.choice(PARTS) for _ in range(rng.randint(1, 40))) for _ in range(1500))]
    own = Encoder(open(VOCABULARY, encoding="utf-8").read())
    assert [x.tolist() for x in own.encode(pa.array(texts))] == [library(t) for t in texts]


def _check(rows, got, library, capacity):
    want = []
    for i, t in rows:
        ids = np.array([*library(t), 0], "<u4")
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]  # noqa: B905
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(w[3] for w in want)


@pytest.mark.parametrize("block", [4096, 40])
def test_packed_documents(table, library, monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK", block)
    rows = [*ODD, *((100 + i, prose(i, 7 * (i % 90))) for i in range(300)), (900, prose(5, 20_000))]
    n, total = _check(rows, packing.pack_documents(table(rows), VOCABULARY, 256).collect(), library, 256)
    assert n <= -(-total // 256) * (1.01 if block > 300 else 1.05) + 1


def test_empty_table_and_ids(table, none, library):
    assert packing.pack_documents(none, VOCABULARY).count() == 0
    r = packing.pack_documents(table([(1, "two words")]), VOCABULARY, keep_ids=True).first()
    assert list(r.ids) == [*library("two words"), 0] and (r.piece, r.start, r.offset) == (0, 0, 0)


def test_added_tokens_are_one_id(table):
    plain = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(4)
    texts = [None, "", "<|endoftext|>", "<|endoftext|><|endoftext|>", "a  <|endoftext|>  b", "<|endoftext", "<|<|endoftext|>|>",
             *("".join(rng.choice(PARTS) for _ in range(rng.randint(1, 40))) for _ in range(1500))]

    def unchanged(t):
        return plain.encode(t or "", add_special_tokens=False).ids

    assert unchanged("x<|endoftext|>y")[1] == 50256
    own = Encoder(open(VOCABULARY, encoding="utf-8").read(), special=True)
    assert [x.tolist() for x in own.encode(pa.array(texts))] == [unchanged(t) for t in texts]
    assert [x.tolist() for x in own.encode(pa.array(texts[:2]))] == [[], []]
    rows = [*enumerate(texts[:300]), (900, " <|endoftext|>word" * 300)]
    _check(rows, packing.pack_documents(table(rows), VOCABULARY, 256).collect(), unchanged, 256)


def _optimal(lengths, capacity):
    """Fewest bins, by trying where each item goes."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1:]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_evolution_finds_few_bins():
    rng = random.Random(2)
    for seed in range(25):
        lengths = [rng.randint(15, 60) for _ in range(11)]
        bins = packing.evolve(lengths, 100, str(seed), crossovers=60)
        assert sorted(i for b in bins for i in b) == list(range(11)) and all(sum(lengths[i] for i in b) <= 100 for b in bins)
        assert len(bins) == _optimal(lengths, 100)


def test_crossover_keeps_every_item():
    rng = random.Random(1)
    lengths = [rng.randint(1, 70) for _ in range(200)]
    a, b = (packing.best_fit([], rng.sample(range(200), 200), lengths, 100) for _ in range(2))
    for _ in range(20):
        child = packing.crossover(a, b, lengths, 100, rng)
        assert sorted(i for x in child for i in x) == list(range(200)) and all(sum(lengths[i] for i in x) <= 100 for x in child)


def test_a_full_cache_keeps_the_words_that_came_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 40)
    with open(VOCABULARY, encoding="utf-8") as f:
        own = Encoder(f.read())
    for i in range(30):
        texts = [f"often again number{i}x{i * 7919} once{i}é", " often again", None, ""]
        for text, ids in zip(texts, own.encode(pa.array(texts)), strict=True):
            assert ids.tolist() == library(text)
        assert len(own.known) <= 50 and (own.known[1:] > own.known[:-1]).all()
    before = len(own.known)
    list(own.encode(pa.array([" often again"])))
    assert len(own.known) == before
