"""BPE encoding and decoding with word ends, split at forced boundaries.

Two neighbouring bytes that no vocabulary token holds side by side can never be merged into one token, so a cut between them is
certain: merges on one side don't see the other, and the ids of a word are those of its fragments, one after the other. Each
different fragment of a block goes to the library's merges once; a bounded cache keeps fragments between blocks. A
fragment that ends a word carries the word-end mark, one inside a word doesn't, and its last byte is a symbol of its own: pairs
before a word end are a second table.

Steps before the merges are the file's: strings of added tokens are cut out of the raw text, texts are composed (NFC) and put in
lower case code point by code point, and the rest falls into contractions, runs of letters, single numbers and runs of others. White
space belongs to no token. Decoding is the library's for a file that names no decoder: the tokens' own strings, joined by one space.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from runstar.llm.bpe import ENDINGS, LETTER, NUMBER, OTHER, SPACE, _byte_letters
from runstar.llm.hashing import _BYTE, LOWER, blocks, code_points, mix, running, spans
from runstar.llm.workers import map_arrow

#: Fragments that a worker's cache holds before it is emptied.
CACHED = 300_000
#: The split of the vocabularies that this encoder reads, and the steps of their normaliser.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STEPS = ["NFC", "Replace", "Lowercase"]
#: Below this code point a text is composed as it stands.
FIRST_MARK = 0x300
#: Marks a code point whose lower case is several.
SEVERAL = 0xFFFFFFFF


class Paged:
    """A value for each code point, filled in by pages of 256 as texts need them."""

    def __init__(self, page: Callable[[str], np.ndarray], of: type):
        self.page, self.values, self.known = page, np.zeros(0x110000, of), np.zeros(0x1100, bool)
        self.known[0xD8:0xE0] = True  # surrogates stand in no text

    def __getitem__(self, points: np.ndarray) -> np.ndarray:
        needed = np.bincount(points >> 8, minlength=0x1100) > 0
        for i in np.flatnonzero(needed & ~self.known).tolist():
            self.values[256 * i:256 * (i + 1)] = self.page("".join(map(chr, range(256 * i, 256 * (i + 1)))))
            self.known[i] = True
        return self.values[points]


def _kinds_of(page: str) -> np.ndarray:
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    out = np.full(256, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for _, (low, high) in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(page):
            out[low:high] = kind
    return out


def _lower_of(page: str) -> np.ndarray:
    from tokenizers.normalizers import Lowercase

    low = [Lowercase().normalize_str(c) for c in page]
    return np.array([ord(c) if len(c) == 1 else SEVERAL for c in low], np.uint32)


#: The kind of each code point as the library's own patterns have it, its lower case by itself, and whether Python's tables
#: don't know it; the library's may.
KINDS, LOWERED = Paged(_kinds_of, np.uint8), Paged(_lower_of, np.uint32)
UNASSIGNED = Paged(lambda page: np.array([unicodedata.category(c) == "Cn" for c in page]), bool)


def _surely_composed(text: str, points: np.ndarray) -> bool:
    return points.max() < FIRST_MARK or (unicodedata.is_normalized("NFC", text) and not UNASSIGNED[points].any())


def fragment_tables(tokens: Iterable[bytes], mark: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of bytes stand side by side inside a token: before its last byte, or before a last byte with the word-end mark."""
    inside, last = np.zeros((256, 256), bool), np.zeros((256, 256), bool)
    for t in tokens:
        body = t.removesuffix(mark)
        ends = len(body) < len(t)
        for i, (a, b) in enumerate(zip(body, body[1:], strict=False)):
            (last if ends and i == len(body) - 2 else inside)[a, b] = True
    return inside, last


def piece_starts(points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin, and which code points belong to one: contractions, letters, single numbers, others."""
    kind = KINDS[points]
    start = np.ones(len(points), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    begin = first[:-1][first[:-1] < first[1:]]
    start[begin] = True
    quote = np.flatnonzero((points[:-1] == 0x27) & (kind[1:] == LETTER) & start[:-1])
    quote = quote[~np.isin(quote + 1, begin)]
    stop = first[np.searchsorted(first, quote, "right")]
    for i, end in zip(quote.tolist(), stop.tolist(), strict=True):
        following = "".join(map(chr, points[i + 1:min(i + 3, end)]))
        ending = next((e for e in ENDINGS if following.startswith(e)), None)
        if ending:
            start[i + 1] = False
            if i + 1 + len(ending) < end:
                start[i + 1 + len(ending)] = True
    return start, kind != SPACE


class Encoder:
    """Ids of texts by the contents of a vocabulary file, as the tokenizers library gives them without special tokens around.

    ``special``: strings of special tokens in a text are their one id, as by the library's default.
    """

    def __init__(self, vocabulary: str, special: bool = True):
        from tokenizers import Tokenizer
        from tokenizers.normalizers import NFC, Lowercase

        steps = json.loads(vocabulary)
        model, before = steps["model"], steps["pre_tokenizer"]
        split, letters = before.get("pretokenizers", [{}, {}])
        kinds = [n["type"] for n in (steps["normalizer"] or {}).get("normalizers", [])]
        if (kinds, split.get("pattern", {}).get("Regex"), split.get("invert"), letters.get("use_regex"),
                letters.get("add_prefix_space")) != (STEPS, PATTERN, True, False, False):
            raise ValueError("the vocabulary must be composed, in lower case and split by the pattern for words with ends")
        if model["unk_token"] or model["dropout"] or model["byte_fallback"] or model["ignore_merges"] or steps["decoder"]:
            raise ValueError("the vocabulary must be plain BPE over bytes, without a decoder")
        self.added = {t["content"]: t["id"] for t in steps["added_tokens"] or [] if special or not t["special"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in steps["added_tokens"] or []):
            raise ValueError("added tokens must stand for their own string alone, wherever it is")
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.compose, self.lower = NFC().normalize_str, Lowercase().normalize_str
        byte = {chr(c): b for b, c in _byte_letters().items()}
        mark = model["end_of_word_suffix"]
        self.last_merges = Tokenizer.from_str(vocabulary).model
        steps["model"]["end_of_word_suffix"] = None
        steps["added_tokens"] = []
        self.inner_merges = Tokenizer.from_str(json.dumps(steps)).model
        tokens = (t.removesuffix(mark) for t in model["vocab"])
        marked = (bytes(byte[c] for c in t) + (b"\0mark" if whole.endswith(mark) else b"")
                  for t, whole in zip(tokens, model["vocab"], strict=True))
        self.inside, self.last = fragment_tables(marked, b"\0mark")
        self.names = np.full(1 + max([*model["vocab"].values(), *(t["id"] for t in json.loads(vocabulary)["added_tokens"] or [])]),
                             None, object)
        for t, i in [*model["vocab"].items(), *((t["content"], t["id"]) for t in json.loads(vocabulary)["added_tokens"] or [])]:
            self.names[i] = t
        self.digits = np.array([str(i) for i in range(len(self.names))], object)
        self._empty()

    def _empty(self) -> None:
        self.slot: dict[int, int] = {}
        self.begin, self.ids = [0], np.zeros(1 << 16, np.uint32)

    def _slots(self, hashes: list[int], texts: list[bytes], ends: list[bool]) -> np.ndarray:
        if len(self.slot) > CACHED:
            self._empty()
        out, letters = [], _byte_letters()
        for h, t, end in zip(hashes, texts, ends, strict=True):
            k = self.slot.get(h)
            if k is None:
                merges = self.last_merges if end else self.inner_merges
                found = [x.id for x in merges.tokenize(t.decode("latin-1").translate(letters))]
                k = self.slot[h] = len(self.begin) - 1
                at = self.begin[-1]
                self.begin.append(at + len(found))
                if self.begin[-1] > len(self.ids):
                    self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), len(found)), np.uint32)))
                self.ids[at:at + len(found)] = found
            out.append(k)
        return np.array(out, np.int64)

    def fragments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of each fragment of a block in bytes, and whether it ends a word; ``data`` is in lower case."""
        points, first = code_points(data, offsets)
        start, solid = piece_starts(points, first)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        word = np.zeros(len(data) + 1, bool)
        word[lead[start]] = True
        word[-1] = True
        inside = np.repeat(solid, np.diff(np.append(lead, len(data))))
        ends = word[1:]  # the byte ends a word
        # a cut between two bytes of a word that no token holds together
        a, b = data[:-1], data[1:]
        forced = ~np.where(ends[1:], self.last[a, b], self.inside[a, b])
        begin = word[:-1].copy()
        begin[1:] |= forced
        stop = np.append(begin[1:], True)
        low, high = np.flatnonzero(begin & inside), np.flatnonzero(stop & inside) + 1
        return low, high, ends[high - 1]

    def _ready(self, texts: pa.Array) -> pa.Array:
        """Texts composed and in lower case; A to Z are left to the block."""
        return pa.array([t if t.isascii() else self._lowered(t) for t in (t or "" for t in texts.to_pylist())], pa.large_string())

    def _lowered(self, text: str) -> str:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if not _surely_composed(text, points):
            text = self.compose(text)
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        low = LOWERED[points]
        if (low == SEVERAL).any():
            return self.lower(text)
        return low.tobytes().decode("utf-32-le")

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; none of a null or empty one."""
        for rows in (texts.slice(i, 2000) for i in range(0, len(texts), 2000)):
            line = rows.to_pylist()
            if not self.added or not any(c in t for t in line if t for c in self.added):
                yield from self._plain(self._ready(rows))
                continue
            parts = [self.cut.split(t or "") for t in line]
            plain = self._plain(self._ready(pa.array([x for p in parts for x in p[::2]], pa.large_string())))
            for p in parts:
                yield np.concatenate([next(plain) if i % 2 == 0 else np.array([self.added[x]], np.uint32) for i, x in enumerate(p)])

    def _plain(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for _, data, offsets in blocks(texts):
            if not len(data):
                yield from (np.zeros(0, np.uint32) for _ in range(len(offsets) - 1))
                continue
            data = LOWER[data]
            low, high, ends = self.fragments(data, offsets)
            keys = mix(spans(running(_BYTE[data]), low, high) + ends.astype(np.uint64))
            hashes, at, back = np.unique(keys, return_index=True, return_inverse=True)
            raw = data.tobytes()
            slots = self._slots(hashes.tolist(), [raw[i:j] for i, j in zip(low[at].tolist(), high[at].tolist(), strict=True)],
                                ends[at].tolist())
            begin = np.array(self.begin, np.int64)
            size = np.diff(begin)[slots][back]
            upto = np.concatenate(([0], np.cumsum(size)))
            ids = self.ids[np.repeat(begin[slots][back] - upto[:-1], size) + np.arange(upto[-1])]
            cut = upto[np.searchsorted(low, offsets)]
            for a, b in zip(cut, cut[1:], strict=False):
                yield ids[a:b]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' strings joined by one space; special tokens are kept, ids outside the vocabulary left out."""
        ids = np.asarray(ids, np.int64)
        found = self.names[ids[(ids >= 0) & (ids < len(self.names))]]
        return " ".join([t for t in found.tolist() if t is not None])


_encoders: dict[str, Encoder] = {}


def encoder(name: str, vocabulary: str) -> Encoder:
    """A worker's encoder for a vocabulary, kept from task to task."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(vocabulary)
    return _encoders[name]


def _named(path: str) -> tuple[str, str]:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return sha256(text.encode()).hexdigest(), text


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids of each text by the vocabulary file at this path of the driver.

    A null or empty text, or one of white space, has no ids. Repeated rows each get a row, an empty table none; other columns
    are not looked at.
    """
    name, contents = _named(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(contents)  # one file, whatever the input

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(name, shared.value)
        for batch in batches:
            for rows in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                found = list(coder.encode(rows["text"]))
                cuts = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.uint32), *found]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([rows["key"], pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))],
                                                 ["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return map_arrow(rows, each, f"key {kind}, ids array<int>")


def decode(rows: DataFrame, vocabulary: str, key: str = "key", ids: str = "ids") -> DataFrame:
    """(key, text): the text of each array of ids, special tokens kept; a null array or one without ids gives an empty text."""
    name, contents = _named(vocabulary)
    shared = rows.sparkSession.sparkContext.broadcast(contents)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(name, shared.value)
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                texts = [coder.decode([x for x in line or [] if x is not None]) for line in part["ids"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["key"], pa.array(texts, pa.string())], ["key", "text"])

    kind = rows.schema[key].dataType.simpleString()
    return map_arrow(rows.select(rows[key].alias("key"), rows[ids].alias("ids")), each, f"key {kind}, text string")


def round_trip_report(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of every document's ids and of the text they decode to."""
    name, contents = _named(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(contents)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(name, shared.value)
        for batch in batches:
            for rows in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                sizes, listed, decoded = [], [], []
                for ids in coder.encode(rows["text"]):
                    sizes.append(len(ids))
                    listed.append(sha256(" ".join(coder.digits[ids].tolist()).encode()).hexdigest())
                    decoded.append(sha256(coder.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(sizes, pa.int64()), pa.array(listed, pa.string()),
                                                  pa.array(decoded, pa.string())],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), each,
                     f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
