from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from runstar.llm import forced_bpe as fb
from tests.llm.conftest import ODD, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    with open(PATH, encoding="utf-8") as f:
        return fb.Encoder(f.read())


def _check(coder, library, texts):
    want = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    got = list(coder.encode(pa.array(texts, pa.large_string())))
    assert [g.tolist() for g in got] == [w.ids for w in want]
    assert [coder.decode(g) for g in got] == [library.decode(w.ids, skip_special_tokens=False) for w in want]


POOL = "abcS'TrREvmlLd 1 29\n\t.,!?éÉİΣςñ́̈文字한ㅎ<|>ß½²\u0085᠎​\x1c\x1f\xa0　𝄞"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(POOL, max_size=40), st.text(max_size=20)), max_size=8))
def test_ids_and_decoded_text_are_the_librarys(coder, library, texts):
    _check(coder, library, texts)


def test_every_code_point(coder, library):
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    _check(coder, library, ["a" + "".join(map(chr, every[i:i + 60])) for i in range(0, len(every), 60)])


def test_special_tokens_contractions_and_long_words(coder, library):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh'1é") for _ in range(60_000))
    _check(coder, library, ["x<|endoftext|>y <|STARTOFTEXT|><|startoftext|><|endoftext|>", "<|endoftext|>", "'s's 's'rest'll don't",
                            "''s '", "12 345", "a" * 5000, "!" * 3000, long, long.upper(), " \t\n", "", None, *(t for _, t in ODD)])
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    with open(PATH, encoding="utf-8") as f:
        ordinary = fb.Encoder(f.read(), special=False)
    _check(ordinary, plain, ["x<|endoftext|>y <|startoftext|>"])


def test_forced_cuts_are_certain_and_occur(coder, library):
    """No token holds a cut pair; words do fall apart; and an emptied cache changes nothing."""
    for token in library.get_vocab():
        body = token.removesuffix("</w>").encode()
        if token.isascii() and len(body) > 1 and "<|" not in token:
            for i in range(len(body) - 1):
                table = coder.last if token.endswith("</w>") and i == len(body) - 2 else coder.inside
                assert table[body[i], body[i + 1]]
    data = np.frombuffer(b"qzxjvq word", np.uint8)
    low, high, ends = coder.fragments(data, np.array([0, len(data)]))
    assert b"".join(data.tobytes()[a:b] for a, b in zip(low, high, strict=True)) == b"qzxjvqword"
    assert len(low) > 2 and ends.sum() == 2
    before = [x.tolist() for x in coder.encode(pa.array([prose(1, 300)]))]
    coder._empty()
    assert [x.tolist() for x in coder.encode(pa.array([prose(1, 300)]))] == before


def test_tables(table, none, library):
    rows = [*ODD, *((100 + i, prose(i, 40) + "<|endoftext|>" * (i % 3)) for i in range(50))]
    ids = {t: library.encode(t or "", add_special_tokens=False).ids for _, t in rows}
    got = fb.round_trip_report(table(rows), PATH).collect()
    want = [(i, len(ids[t]), sha256(" ".join(map(str, ids[t])).encode()).hexdigest(),
             sha256(library.decode(ids[t], skip_special_tokens=False).encode()).hexdigest()) for i, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    encoded = fb.encode(table(rows), PATH)
    assert sorted(map(str, ((r.key, r.ids) for r in encoded.collect()))) == sorted(str((i, ids[t])) for i, t in rows)
    texts = fb.decode(encoded, PATH).collect()
    assert sorted(str(r.text) for r in texts) == sorted(library.decode(ids[t], skip_special_tokens=False) for _, t in rows)
    assert fb.round_trip_report(none, PATH).count() == 0 and fb.encode(none, PATH).count() == 0
    odd = encoded.sparkSession.createDataFrame([(1, None), (2, []), (3, [320, None, 10**9, -1])], "key int, ids array<int>")
    assert [r.text for r in fb.decode(odd, PATH).orderBy("key").collect()] == ["", "", library.id_to_token(320)]


def test_other_vocabularies_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        fb.Encoder(f.read())
