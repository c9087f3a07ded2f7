"""Alignment of the tokens of two tokenizers, a byte-level one (A) and a piece model (B), and counts of the pairs they link.

Both read a space and the text. The tokenizers library states where a token ends in characters, the sentencepiece spans state
it in bytes of the text; these are coarse cuts. Where several tokens share a character (byte-level tokens inside a character, pieces that
stand for single bytes) both state the whole character or none, and ends between two sure cuts are refined with the lengths of the
tokens' decoded bytes. Places where a token of A and a token of B end cut the text into groups; a group links each of its A tokens
with each of its B tokens.

A space after a character that isn't white space is a cut to both: a word of A may only begin with it, and no piece holds it
behind another character (checked when a model is loaded). So are two ASCII characters of different kinds (letter, number, other, but no
apostrophe) that no piece holds side by side. Each different segment between such cuts goes to both libraries once, and a
bounded cache keeps its tokens, groups and links. A text is the sequence of its segments.

A pair's count is the number of documents that hold it linked. Texts stay where they are read: an Arrow batch, a *unit*, makes one row with
its documents' figures, its different pairs and how many of its documents hold each. Pairs of units are summed to counts, each unit
asks for the counts of its own pairs through a join, and a co-grouping by unit adds them up for its documents. A pair has at
most one row a unit, whatever the copies of a text, and a unit's pairs are bounded by the bytes of a batch (a text longer than that is a
unit of its own).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runstar.llm.bpe import SPACE, _byte_letters
from runstar.llm.forced_bpe import KINDS
from runstar.llm.hashing import _BYTE, blocks, code_points, running, spans
from runstar.llm.workers import map_arrow, ship
from runstar.sources.workspace import Workspace

BLANK = "▁"
#: Segments and pairs that a worker's cache holds before it is emptied.
CACHED, CACHED_PAIRS = 300_000, 2_000_000
#: A group with more links than this is reduced to different ids before they are paired.
WIDE = 64
_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
NOTHING, COMMA, SEMICOLON, BAR = range(4)
_CODEC = pa.Codec("zstd", 1)


@dataclass
class Side:
    """Tokens of consecutive segments: ids, where each ends in bytes of all segments, and which segments its bytes spell."""

    ids: np.ndarray
    ends: np.ndarray
    spelt: np.ndarray


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``begin[i]`` to ``begin[i] + size[i]`` of all i."""
    upto = np.concatenate(([0], np.cumsum(size)))
    return np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])


class Spelling:
    """The decoded bytes of each id."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.concatenate(([0], np.cumsum(self.size)))[:-1]
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def side(self, ids: np.ndarray, cut: np.ndarray, sure: np.ndarray, data: np.ndarray, limits: np.ndarray) -> Side:
        """Tokens of segments whose bytes ``data`` are cut at ``limits``; ``cut`` is each token's stated end, of use to it where
        it is ``sure``."""
        count = np.bincount(np.searchsorted(limits, cut - 1, "right") - 1, minlength=len(limits) - 1)
        size = self.size[ids]
        upto = np.cumsum(size)
        first = np.concatenate(([0], np.cumsum(count)))
        # from the last sure cut, or the segment's begin, on by the bytes of the tokens since
        known = np.where(sure, np.arange(len(ids)), -1)
        begin = first[:-1][count > 0]
        known = np.maximum.accumulate(known) if len(ids) else known
        segment = np.repeat(np.arange(len(count)), count)
        before = np.concatenate(([0], upto))
        start = first[segment]
        since = np.where(known >= start, cut[known] - upto[known], limits[segment] - before[start])
        ends = since + upto
        lengths = np.add.reduceat(size, begin) if len(begin) else size
        spelt = np.zeros(len(count), bool)
        spelt[count > 0] = (lengths == np.diff(limits)[count > 0])
        # the stated cuts must be where the bytes are
        wrong = sure & (cut - limits[segment] != upto - before[start])
        spelt[segment[wrong]] = False
        # bytes of the segments whose lengths agree
        chosen = spelt[segment]
        mine = self.data[_ranges(self.begin[ids[chosen]], size[chosen])]
        theirs = data[_ranges(limits[:-1][spelt], np.diff(limits)[spelt])]
        off = np.searchsorted(np.cumsum(np.diff(limits)[spelt]), np.flatnonzero(mine != theirs), "right")
        spelt[np.flatnonzero(spelt)[off]] = False
        return Side(ids, ends, spelt)


@dataclass
class Aligned:
    """What an aligner found for consecutive segments; unspelt segments have no groups. A segment's links come in its order, a
    pair perhaps more than once."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    whole: np.ndarray
    texts: list[str]
    segment: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


class Aligner:
    """Aligns texts by the contents of a byte-level vocabulary file and of a piece model file."""

    def __init__(self, vocabulary: str, model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        steps = json.loads(vocabulary)
        before = steps["pre_tokenizer"] or {}
        if (before.get("type"), before.get("use_regex", True), before.get("add_prefix_space"), steps["normalizer"]) != (
                "ByteLevel", True, False, None):
            raise ValueError("the vocabulary must be byte-level, split by the usual pattern, without normalisation")
        self.a = Tokenizer.from_str(vocabulary)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        byte = {chr(c): b for b, c in _byte_letters().items()}
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_spelling = Spelling([bytes(byte.get(c, 0) for c in names.get(i, "")) for i in range(max(names) + 1)])
        self.b = SentencePieceProcessor(model_proto=model)
        if self.b.normalize(" A  ﬁ é\n") != f"{BLANK}{BLANK}A{BLANK}{BLANK}ﬁ{BLANK}é\n":
            raise ValueError("the model must put a blank first and keep the text otherwise")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        special = [self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i) for i in range(len(pieces))]
        if any(BLANK in p.lstrip(BLANK) for p, s in zip(pieces, special, strict=True) if not s):
            raise ValueError("no piece may hold a blank behind another character")
        self.b_spelling = Spelling([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
                                    for i, p in enumerate(pieces)])
        #: ASCII characters that a cut may stand between
        kind = np.append(KINDS[np.arange(128)], SPACE)
        kind[[ord("'")]] = SPACE
        self.apart = (kind[:, None] != kind) & (kind[:, None] != SPACE) & (kind != SPACE)
        for p, hidden in zip(pieces, special, strict=True):
            if not hidden:
                points = [min(ord(c), 128) for c in p]
                self.apart[points[:-1], points[1:]] = False
        white = np.flatnonzero(KINDS[np.arange(0x3100)] == SPACE)
        digits = [str(i) for i in range(max(len(self.a_spelling.size), len(pieces)))]
        self.written = np.array([[mark + d for d in digits] for mark in ("", ",", ";", "|")], object)
        self.open = tuple(chr(c).encode() for c in [*white.tolist(), ord(BLANK)])
        self.forget()

    def forget(self) -> None:
        """Empty the cache."""
        self.slot: dict[int, int] = {}
        self.dense: dict[int, int] = {}
        self.figures = np.zeros((0, 5), np.int64)
        self.texts: list[str] = []
        self.begin = np.zeros(1, np.int64)
        self.codes, self.links = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A block's bytes with a space before each text, begin and end of each segment in them, and each text's first segment."""
        some = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][some], 0x20)
        points, first = code_points(data, offsets + np.concatenate(([0], np.cumsum(some))))
        if not len(points):
            return data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(first), np.int64)
        white = KINDS[points] == SPACE
        start = np.zeros(len(points), bool)
        # white space that a text ends with stays with the segment before it
        solid = np.maximum.accumulate(np.where(white, -1, np.arange(len(points))))
        final = np.repeat(solid[first[1:][some] - 1], np.diff(first)[some])
        start[1:] = (points[1:] == 0x20) & ~white[:-1] & (np.arange(1, len(points)) < final[1:])
        ascii_ = np.minimum(points, 128)
        start[1:] |= self.apart[ascii_[:-1], ascii_[1:]]
        start[first[:-1][some]] = True
        at = np.flatnonzero(start)
        lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        return data, lead[at], lead[np.append(at[1:], len(points))], np.searchsorted(at, first)

    def _sides(self, segments: list[bytes]) -> tuple[np.ndarray, Side, Side]:
        """Limits in bytes of segments and both sides' tokens."""
        spaced = np.array([x[0] == 0x20 for x in segments], bool)
        limits = np.concatenate(([0], np.cumsum([len(x) for x in segments])))
        rows = np.flatnonzero(spaced), np.flatnonzero(~spaced)
        found = [self._spaced([segments[i] for i in rows[0].tolist()]), self._bare([segments[i] for i in rows[1].tolist()])]
        # from both lists back to the order of the segments
        shift = np.zeros(len(segments), np.int64)
        for r, (own, *_) in zip(rows, found, strict=True):
            shift[r] = limits[r] - own[:-1]
        sides = []
        for part, spelling in ((1, self.a_spelling), (2, self.b_spelling)):
            of, ids, cut, sure = [], [], [], []
            for r, f in zip(rows, found, strict=True):
                mine = f[part]
                of.append(r[np.searchsorted(f[0], mine[1] - 1, "right") - 1] if len(r) else r)
                ids.append(mine[0])
                cut.append(mine[1] + shift[of[-1]])
                sure.append(mine[2])
            order = np.argsort(np.concatenate(of), kind="stable")
            columns = (np.concatenate(x)[order] for x in (ids, cut, sure))
            sides.append(spelling.side(*columns, np.frombuffer(b"".join(segments), np.uint8), limits))
        return limits, *sides

    def _spaced(self, segments: list[bytes]) -> tuple[np.ndarray, tuple, tuple]:
        """Limits, and (ids, stated ends, whether to rely on them) of both sides, for segments that begin with a space.

        Consecutive ones go to the libraries as one text, up to one that ends with white space: the space of the next would be no
        cut.
        """
        limits = np.concatenate(([0], np.cumsum([len(x) for x in segments]))).astype(np.int64)
        stops = [i + 1 for i, x in enumerate(segments) if x.endswith(self.open)]
        parts, begin = [], 0
        for stop in [*stops, len(segments)]:
            if begin < stop:
                text = b"".join(segments[begin:stop]).decode()
                parts.append((self._by_a(text, limits[begin]), self._by_b(text[1:], limits[begin] + 1)))
            begin = stop
        return limits, *(tuple(np.concatenate(x) for x in zip(*side, strict=True)) if side else _NONE
                         for side in (zip(*parts, strict=True) if parts else ((), ())))

    def _bare(self, segments: list[bytes]) -> tuple[np.ndarray, tuple, tuple]:
        """The same for segments that begin with a letter, number or other mark: a line feed before each keeps them apart."""
        limits = np.concatenate(([0], np.cumsum([1 + len(x) for x in segments]))).astype(np.int64)
        if not segments:
            return limits, _NONE, _NONE
        text = "".join("\n" + x.decode() for x in segments)
        out = []
        for ids, cut, sure in (self._by_a(text, 0), self._by_b(text, 0)):
            own = ~np.isin(cut, np.append(limits[:-1] + 1, 0))  # no line feeds, nor the space that B puts first
            of = np.searchsorted(limits, cut[own] - 1, "right")
            out.append((ids[own], cut[own] - of, sure[own]))
        return limits - np.arange(len(limits)), *out

    def _by_a(self, text: str, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = self.a.encode(text, add_special_tokens=False)
        stated = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(found.ids)).reshape(-1, 2)
        data = np.frombuffer(text.encode(), np.uint8)
        lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # each character's first byte
        sure = np.ones(len(stated), bool)
        sure[:-1] = stated[1:, 0] >= stated[:-1, 1]  # the next token begins behind this one's last character
        return np.array(found.ids, np.int64), at + lead[stated[:, 1]], sure

    def _by_b(self, text: str, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = self.b.encode(text, return_type="offset_mapping", return_bytes=True)  # the immutable proto's spans
        stated = np.fromiter(chain.from_iterable(found["offsets"]), np.int64, 2 * len(found["ids"])).reshape(-1, 2)
        return np.array(found["ids"], np.int64), at + stated[:, 1], stated[:, 1] > stated[:, 0]

    def align(self, segments: list[bytes]) -> Aligned:
        """Groups and links of segments."""
        limits, a, b = self._sides(segments)
        whole = a.spelt & b.spelt
        n = len(segments)
        inside = np.searchsorted(limits, a.ends - 1, "right") - 1, np.searchsorted(limits, b.ends - 1, "right") - 1
        keep = whole[np.clip(inside[0], 0, n - 1)], whole[np.clip(inside[1], 0, n - 1)]
        a_ids, a_ends, b_ids, b_ends = a.ids[keep[0]], a.ends[keep[0]], b.ids[keep[1]], b.ends[keep[1]]
        common = np.intersect1d(a_ends, b_ends)
        segment = np.searchsorted(limits, common - 1, "right") - 1
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        a_count, b_count = np.bincount(a_group, minlength=len(common)), np.bincount(b_group, minlength=len(common))

        def summed(of_group: np.ndarray) -> np.ndarray:
            out = np.zeros(n, np.int64)
            np.add.at(out, segment, of_group)
            return out

        texts = self._listed(a_ids, a_count, b_ids, b_count, np.bincount(segment, minlength=n))
        first = np.concatenate(([0], np.cumsum(b_count)))[:-1]
        wide = a_count * b_count > WIDE
        narrow = np.flatnonzero(~wide[a_group])
        many = b_count[a_group[narrow]]
        left, right = np.repeat(narrow, many), _ranges(first[a_group[narrow]], many)
        of, pair, links = segment[a_group[left]], a_ids[left] << 32 | b_ids[right], np.ones(len(left), np.int64)
        if wide.any():
            parts = self._wide(a_group[wide[a_group]], a_ids[wide[a_group]], b_group[wide[b_group]], b_ids[wide[b_group]])
            of, pair, links = (np.concatenate(x) for x in zip((of, pair, links), (segment[parts[0]], *parts[1:]), strict=True))
            order = np.argsort(of, kind="stable")
            of, pair, links = of[order], pair[order], links[order]
        return Aligned(summed(a_count), summed(b_count), summed(np.ones(len(common), np.int64)), summed(a_count * b_count), whole,
                       texts, of, pair, links)

    @staticmethod
    def _wide(a_group, a_ids, b_group, b_ids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group, pair and links of the different ids of groups on both sides."""
        x, x_count = np.unique(a_group << 20 | a_ids, return_counts=True)
        y, y_count = np.unique(b_group << 20 | b_ids, return_counts=True)
        begin, stop = np.searchsorted(y >> 20, x >> 20), np.searchsorted(y >> 20, x >> 20, "right")
        left, right = np.repeat(np.arange(len(x)), stop - begin), _ranges(begin, stop - begin)
        return x[left] >> 20, (x[left] & 0xFFFFF) << 32 | (y[right] & 0xFFFFF), x_count[left] * y_count[right]

    def _listed(self, a_ids, a_count, b_ids, b_count, groups) -> list[str]:
        """``a1,a2|b1;a3|b2`` for each segment: every token written with the mark before it, a segment's first without."""
        m, n, k = len(a_ids), len(b_ids), len(a_count)
        marks = np.concatenate((np.full(m, COMMA), np.full(n, COMMA)))
        a_first = np.concatenate(([0], np.cumsum(a_count)))[:-1]
        b_first = np.concatenate(([0], np.cumsum(b_count)))[:-1]
        segment = np.concatenate(([0], np.cumsum(groups)))[:-1]
        marks[a_first] = SEMICOLON
        marks[a_first[segment[groups > 0]]] = NOTHING
        marks[m + b_first] = BAR
        # where each token stands: its group's tokens of A come before those of B
        place = np.concatenate((np.arange(m) + np.repeat(b_first, a_count), np.arange(n) + np.repeat(a_first + a_count, b_count)))
        line = np.empty(m + n, object)
        line[place] = self.written[marks, np.concatenate((a_ids, b_ids))]
        upto = np.concatenate(([0], np.cumsum(a_count + b_count)))
        cut = upto[np.concatenate((segment, [k]))].tolist()
        line = line.tolist()
        return ["".join(line[i:j]) for i, j in zip(cut, cut[1:], strict=False)]

    def _slots(self, hashes: np.ndarray, segments: list[bytes]) -> np.ndarray:
        """The cache's places of segments."""
        if len(self.slot) > CACHED or len(self.dense) > CACHED_PAIRS:
            self.forget()
        keys = hashes.tolist()
        missing = [i for i, h in enumerate(keys) if h not in self.slot]
        if missing:
            found = self.align([segments[i] for i in missing])
            for i in missing:
                self.slot[keys[i]] = len(self.slot)
            different, back = np.unique(found.pairs, return_inverse=True)
            codes = np.array([self.dense.setdefault(p, len(self.dense)) for p in different.tolist()], np.int32)
            self.codes = np.concatenate((self.codes, codes[back]))
            self.links = np.concatenate((self.links, found.links))
            size = np.bincount(found.segment, minlength=len(missing))
            self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(size)))
            self.figures = np.concatenate((self.figures, np.stack(
                [found.n_a, found.n_b, found.n_groups, found.n_links, found.whole], 1)))
            self.texts += found.texts
        return np.array([self.slot[h] for h in keys], np.int64)

    def documents(self, texts: pa.Array) -> Iterator[Documents]:
        """The texts of a column, block by block."""
        for _, data, offsets in blocks(texts):
            n = len(offsets) - 1
            data, low, high, first = self.segments(data, offsets)
            hashes, at, back = np.unique(spans(running(_BYTE[data]), low, high), return_index=True, return_inverse=True)
            raw = data.tobytes()
            slots = self._slots(hashes, [raw[i:j] for i, j in zip(low[at].tolist(), high[at].tolist(), strict=True)])[back]
            line = np.repeat(np.arange(n), np.diff(first))
            figures = np.zeros((n, 4), np.int64)
            np.add.at(figures, line, self.figures[slots, :4])
            whole = np.diff(first) > 0
            whole[line[self.figures[slots, 4] == 0]] = False
            figures[~whole] = 0
            listed = [sha256(";".join([self.texts[s] for s in slots[a:b].tolist()]).encode()).hexdigest() if w else ""
                      for a, b, w in zip(first, first[1:], whole.tolist(), strict=False)]
            slots, line = slots[whole[line]], line[whole[line]]
            size = np.diff(self.begin)[slots]
            place = _ranges(self.begin[slots], size)
            key = np.repeat(line, size) * np.int64(len(self.dense) + 1) + self.codes[place]
            key, inverse = np.unique(key, return_inverse=True)
            links = np.bincount(inverse, self.links[place], len(key)).astype(np.int64)
            code = np.array(list(self.dense), np.int64)  # in order of their dense numbers
            yield Documents(figures, listed, key // (len(self.dense) + 1), code[key % (len(self.dense) + 1)], links)


@dataclass
class Documents:
    """Figures (n_a, n_b, n_groups, n_links) and digests of texts; the different pairs of each, by text, and how often linked."""

    figures: np.ndarray
    listed: list[str]
    line: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


_aligners: dict[str, Aligner] = {}


def _aligner(name: str, vocabulary: str, model: bytes) -> Aligner:
    """A worker's aligner, kept from task to task."""
    if name not in _aligners:
        _aligners.clear()
        _aligners[name] = Aligner(vocabulary, model)
    return _aligners[name]


def _pack(values: np.ndarray) -> bytes:
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + (_CODEC.compress(raw, asbytes=True) if raw else b"")


def _unpack(data: bytes, of: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(_CODEC.decompress(data[8:], size, asbytes=True) if size else b"", of)


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def _units(name: str, shared, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(name, *shared.value)
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            found, row = [], 0
            for d in aligner.documents(batch["text"]):
                found.append(Documents(d.figures, d.listed, d.line + row, d.pairs, d.links))
                row += len(d.figures)
            if not found:
                continue
            pairs, code = np.unique(np.concatenate([d.pairs for d in found]), return_inverse=True)
            line = np.concatenate([d.line for d in found])
            figures = np.concatenate([d.figures for d in found])
            yield pa.RecordBatch.from_pydict({
                "unit": pa.array([part << 32 | number], pa.int64()),
                "ids": pa.array([batch["doc_id"].to_pylist()], pa.list_(kind)),
                **{n: pa.array([figures[:, i]], pa.list_(pa.int64())) for i, n in enumerate(FIGURES)},
                "listed": pa.array([[x for d in found for x in d.listed]], pa.list_(pa.string())),
                "held": pa.array([_pack(np.bincount(line, minlength=row).astype(np.int32))], pa.binary()),
                "codes": pa.array([_pack(code.astype(np.int32))], pa.binary()),
                "links": pa.array([_pack(np.concatenate([d.links for d in found]))], pa.binary()),
                "pairs": pa.array([pairs], pa.list_(pa.int64())),
                "docs": pa.array([np.bincount(code, minlength=len(pairs))], pa.list_(pa.int64()))})
        if len(aligner.slot) > CACHED // 4:
            aligner.forget()
    return run


def _answered(unit: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a unit, with the counts of its pairs."""
    n = len(unit["pairs"][0])
    slot = answers["slot"].to_numpy()
    count, best = np.zeros(n, np.int64), np.zeros(n, bool)
    count[slot] = answers["count"].to_numpy()
    best[slot] = answers["best"].to_numpy(zero_copy_only=False)
    held = _unpack(unit["held"][0].as_py(), np.int32)
    code, links = _unpack(unit["codes"][0].as_py(), np.int32), _unpack(unit["links"][0].as_py(), np.int64)
    upto = np.concatenate(([0], np.cumsum(held)))

    def summed(values: np.ndarray) -> pa.Array:
        total = np.concatenate(([0], np.cumsum(values)))
        return pa.array(total[upto[1:]] - total[upto[:-1]], pa.int64())

    columns = {"doc_id": unit["ids"].combine_chunks().flatten(),
               **{f: unit[f].combine_chunks().flatten() for f in FIGURES},
               "n_best": summed(links * best[code]), "count_sum": summed(links * count[code]),
               "groups_sha256": unit["listed"].combine_chunks().flatten()}
    return pa.table(columns)


def _files(vocabulary: str, model: str) -> tuple[str, tuple[str, bytes]]:
    text, data = Path(vocabulary).read_text(encoding="utf-8"), Path(model).read_bytes()
    return sha256(text.encode() + data).hexdigest(), (text, data)


def units(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """A row for each batch of documents: their figures, their links and the batch's different pairs."""
    name, files = _files(vocabulary, model)
    shared = docs.sparkSession.sparkContext.broadcast(files)  # two files, whatever the input
    field = docs.schema["doc_id"]
    kind = field.dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    schema = (f"unit long, ids array<{kind}>, {', '.join(f'{n} array<long>' for n in FIGURES)}, listed array<string>, "
              "held binary, codes binary, links binary, pairs array<long>, docs array<long>")
    return map_arrow(docs.select("doc_id", "text"), _units(name, shared, to_arrow_type(field.dataType)), schema)


def pair_counts(units: DataFrame) -> DataFrame:
    """(pair, a, count, best): in how many documents each pair is linked, and whether no pair of its A id is in more."""
    asked = units.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = asked.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("count"))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "a", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment_report(docs: DataFrame, vocabulary: str, model: str, work: Workspace | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each document.

    A text that is null or empty, or whose tokens don't spell a space and the text (one that holds U+2581, say), has no
    tokens: zeros and an empty digest. Repeated rows are documents of their own, in counts too; a null id is kept. An empty table gives no
    row; other columns are not looked at. A group's different ids are paired in memory: 50,000 by 32,000 at the very worst.
    """
    work = work or Workspace(docs.sparkSession)
    kept = work.keep("units", units(docs, vocabulary, model))
    counts = work.keep("counts", pair_counts(kept.select("pairs", "docs")))
    asked = kept.select(F.col("unit").alias("asker"), F.posexplode("pairs").alias("slot", "pair"))
    answers = asked.join(counts.select("pair", "count", "best"), "pair").select("asker", "slot", "count", "best")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    ship(docs.sparkSession)
    return kept.drop("docs").groupBy("unit").cogroup(answers.groupBy("asker")).applyInArrow(_answered, schema)


def align(docs: DataFrame, vocabulary: str, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, groups): for each text its groups as structs of begin and end (bytes of a space and the text), A ids and B ids.

    Texts without tokens (see ``alignment_report``) have no groups.
    """
    name, files = _files(vocabulary, model)
    shared = docs.sparkSession.sparkContext.broadcast(files)
    group = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(name, *shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 100):
                rows = batch.slice(low, 100)
                found = [aligned_groups(aligner, t) for t in rows["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([rows["key"], pa.array(found, pa.list_(group))], ["key", "groups"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return map_arrow(rows, each, f"key {kind}, groups array<struct<begin:long,end:long,a:array<int>,b:array<int>>>")


def aligned_groups(aligner: Aligner, text: str | None) -> list[dict]:
    """The groups of one text."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    data, low, high, _ = aligner.segments(data, np.array([0, len(data)]))
    raw = data.tobytes()
    if not len(low):
        return []
    _, a, b = aligner._sides([raw[i:j] for i, j in zip(low, high, strict=True)])
    if not (a.spelt.all() and b.spelt.all()):
        return []
    common = np.intersect1d(a.ends, b.ends)
    at, bt = (np.concatenate(([0], np.searchsorted(s.ends, common, "right"))) for s in (a, b))
    begin = np.concatenate(([0], common))
    return [{"begin": int(begin[i]), "end": int(common[i]), "a": a.ids[at[i]:at[i + 1]].tolist(), "b": b.ids[bt[i]:bt[i + 1]].tolist()}
            for i in range(len(common))]
