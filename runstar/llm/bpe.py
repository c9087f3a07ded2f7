"""Byte-level BPE ids of whole texts.

The merges are the tokenizers library's. The split into words before them is computed on whole blocks of code points, and
each different word of a block goes to the library once; a bounded cache keeps words between blocks. Texts are cut at the
vocabulary's added tokens first, as by the library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from runstar.llm.hashing import _BYTE, blocks, code_points, running, spans

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
#: The endings that the split keeps with their apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Words that a worker's cache holds before it drops those that did not come again.
CACHED = 300_000


@cache
def _kinds() -> np.ndarray:
    """The kind of each code point."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[[ord(c) for c in m[0]]] = kind
    out[0x1C:0x20] = OTHER  # white space to Python, not to the tokenizer
    return out


@cache
def _byte_letters() -> dict[int, int]:
    """The printable code point that stands for each byte in a byte-level vocabulary."""
    # The bytes that stand for themselves.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


def word_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where words begin: runs of letters, numbers or others, each with one blank before it; runs of white space."""
    n = len(points)
    kind = _kinds()[points]
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    begin = first[:-1][first[:-1] < first[1:]]
    start[begin] = True
    # the last of a run of white space that something follows stands alone, or goes with what follows if it is a blank
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE))
    last = last[~np.isin(last + 1, begin)]
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    quote = np.flatnonzero((points[:-1] == 0x27) & (kind[1:] == LETTER) & start[:-1])
    quote = quote[~np.isin(quote + 1, begin)]
    if len(quote):
        end = first[np.searchsorted(first, quote, "right")]
        for i, stop in zip(quote.tolist(), end.tolist(), strict=True):
            following = "".join(map(chr, points[i + 1:min(i + 3, stop)]))
            ending = next((e for e in ENDINGS if following.startswith(e)), None)
            if ending:
                start[i + 1] = False
                if i + 1 + len(ending) < stop:
                    start[i + 1 + len(ending)] = True
    return np.flatnonzero(start)


class Encoder:
    """Ids of texts by a byte-level vocabulary file's contents; strings of special tokens are ordinary text unless ``special``."""

    def __init__(self, vocabulary: str, special: bool = False):
        from tokenizers import Tokenizer

        steps = json.loads(vocabulary)
        before = steps["pre_tokenizer"] or {}
        if (before.get("type"), before.get("use_regex", True), before.get("add_prefix_space"), steps["normalizer"]) != (
                "ByteLevel", True, False, None):
            raise ValueError("the vocabulary must be byte-level, split by the usual pattern, without normalisation")
        added = [t for t in steps.get("added_tokens") or [] if special or not t["special"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens must stand for their own string alone, wherever it is")
        self.added = {t["content"]: np.array([t["id"]], np.uint32) for t in added}
        # the longest of those that begin at one place
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.merges = Tokenizer.from_str(vocabulary).model
        self._empty()

    def forget(self) -> None:
        """Empty the cache: a worker that waits for other work should not hold it."""
        self._empty()

    def _empty(self) -> None:
        self.known, self.slot, self.hit = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.begin, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _thin(self) -> None:
        """Keep the words that came again; if these are many too, none."""
        kept = np.flatnonzero(self.hit)
        if len(kept) > CACHED // 2:
            self._empty()
            return
        self.ids, size = self._ids(self.slot[kept])
        self.begin = np.concatenate(([0], np.cumsum(size)))
        self.known, self.slot, self.hit = self.known[kept], np.arange(len(kept)), np.zeros(len(kept), bool)

    def _ids(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after the other, and how many each has."""
        size = np.diff(self.begin)[slots]
        upto = np.concatenate(([0], np.cumsum(size)))
        return self.ids[np.repeat(self.begin[slots] - upto[:-1], size) + np.arange(upto[-1])], size

    def _slots(self, hashes: np.ndarray, raw: bytes, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where the cache has the words of these hashes, which ascend; those it has not are merged first."""
        if len(self.known) > CACHED:
            self._thin()
        at = np.searchsorted(self.known, hashes)
        there = at < len(self.known)
        there[there] = self.known[at[there]] == hashes[there]
        self.hit[at[there]] = True
        new = np.flatnonzero(~there)
        if len(new):
            letters, merged = _byte_letters(), self.merges.tokenize
            found = [[x.id for x in merged(raw[i:j].decode("latin-1").translate(letters))]
                     for i, j in zip(low[new].tolist(), high[new].tolist(), strict=True)]
            size = np.fromiter(map(len, found), np.int64, len(found))
            slots = np.arange(len(new)) + len(self.begin) - 1
            self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(size)))
            self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))))
            self.known, self.slot = np.insert(self.known, at[new], hashes[new]), np.insert(self.slot, at[new], slots)
            self.hit = np.insert(self.hit, at[new], False)
            at = np.searchsorted(self.known, hashes)
        return self.slot[at]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; none of a null or empty one."""
        if not any(pc.any(pc.match_substring(texts, t)).as_py() for t in self.added):
            yield from self._plain(texts)
            return
        parts = [self.cut.split(t or "") for t in texts.to_pylist()]
        plain = self._plain(pa.array([x for p in parts for x in p[::2]], pa.large_string()))
        for p in parts:
            yield np.concatenate([next(plain) if i % 2 == 0 else self.added[x] for i, x in enumerate(p)])

    def _plain(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """``encode`` for texts without added tokens."""
        for _, data, offsets in blocks(texts):
            points, first = code_points(data, offsets)
            if not len(points):
                yield from (np.zeros(0, np.uint32) for _ in range(len(offsets) - 1))
                continue
            starts = word_starts(points, first)
            byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            low, high = byte[starts], byte[np.append(starts[1:], len(points))]
            hashes, at, back = np.unique(spans(running(_BYTE[data]), low, high), return_index=True, return_inverse=True)
            slots = self._slots(hashes, data.tobytes(), low[at], high[at])
            ids, size = self._ids(slots[back])
            upto = np.concatenate(([0], np.cumsum(size)))
            cut = upto[np.searchsorted(starts, first)]
            for a, b in zip(cut, cut[1:], strict=False):
                yield ids[a:b]


_encoders: dict[str, Encoder] = {}


def encoder(name: str, vocabulary: str) -> Encoder:
    """A worker's encoder for a vocabulary, with its special tokens, kept from task to task."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(vocabulary, special=True)
    return _encoders[name]
