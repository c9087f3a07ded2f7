"""Periodic runs of words: stretches that repeat a block of words, found by a sparse dynamic programme over diagonals.

The cell (i, d) of lag d holds how many words up to word i equal the words d before them; a stretch of cells that ends long
enough is a run. Letting every earlier occurrence of a word advance its lag costs the square of a common word's count, so
lags come from occurrences of grams of doubling length: a gram of g words advances the lag to its latest earlier occurrence,
if that is over g/2 and at most g. It loses no run. In a run of smallest period q a gram of q to 2q words recurs at multiples of q
alone (else the run had a smaller period), so its latest earlier occurrence lies q before it from the second period to the
last gram; four periods hold q grams at least that do. Lags that are no smallest period of their stretch
never become active inside it. A word takes part in a level only as long as its gram occurs twice in its text, so natural prose leaves
after two or three levels and the work is n log n at worst.

Cells of one lag that follow each other without a gap are one diagonal; its end emits the run at once, as (start, length, period).
Texts are read in blocks of a megabyte, longer ones alone; a task holds one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from runstar.llm.hashing import Words, blocks, words
from runstar.llm.workers import map_arrow

#: A run has at least so many words, and so many periods.
WORDS, PERIODS = 6, 4


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For keys in order of place: a number for each different key, the place of its latest earlier occurrence (or -1), and
    whether it occurs twice."""
    order = np.argsort(keys, kind="stable")
    line = keys[order]
    same = np.zeros(len(keys), bool)
    same[1:] = line[1:] == line[:-1]
    name = np.empty(len(keys), np.int64)
    name[order] = np.cumsum(~same) - 1
    before = np.full(len(keys), -1, np.int64)
    before[order[1:][same[1:]]] = order[:-1][same[1:]]
    twice = same.copy()
    twice[:-1] |= same[1:]
    again = np.empty(len(keys), bool)
    again[order] = twice
    return name, before, again


def find_runs(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) by text, start, period; ``symbols`` of text i are ``first[i]`` to ``first[i + 1]``."""
    n = len(symbols)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.arange(n)
    # one number for a symbol of a text: grams of two texts never have the same name
    _, symbol = np.unique(symbols, return_inverse=True)
    keys = text * np.int64(n + 1) + symbol
    at = np.full(n, -1, np.int64)
    found, gram = [], 1
    while len(place):
        name, before, again = _named(keys)
        lag = np.where(before >= 0, place - place[before], 0)
        cell = (lag > gram // 2) & (lag <= gram)
        i, d = place[cell], lag[cell]
        if len(i):
            ends = np.append((np.diff(i) != 1) | (np.diff(d) != 0), True)
            last = np.flatnonzero(ends)
            begin = np.concatenate(([0], last[:-1] + 1))
            start, period = i[begin] - d[begin], d[begin]
            length = i[last] + gram - start
            long = length >= np.maximum(WORDS, PERIODS * period)
            found.append(np.stack([text[start[long]], start[long], length[long], period[long]], 1))
        place, name = place[again], name[again]
        at[place] = name
        behind = place + gram
        inside = behind < n
        place, name, behind = place[inside], name[inside], behind[inside]
        both = (at[behind] >= 0) & (text[behind] == text[place])
        keys = name[both] * np.int64(n + 1) + at[behind[both]]
        at[:] = -1
        place = place[both]
        gram *= 2
    runs = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    runs[:, 1] -= first[runs[:, 0]]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def dropped(runs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words a run holds after its first period."""
    depth = np.zeros(first[-1] + 1, np.int64)
    start = first[runs[:, 0]] + runs[:, 1]
    np.add.at(depth, start + runs[:, 3], 1)
    np.add.at(depth, start + runs[:, 2], -1)
    return np.cumsum(depth[:-1]) > 0


def strongest(runs: np.ndarray) -> np.ndarray | None:
    """The run of a text with the greatest exact length / period; of equal ones the first, then that of the smallest period."""
    if not len(runs):
        return None
    ratio = runs[:, 2] / runs[:, 3]
    near = runs[ratio >= ratio.max() * (1 - 1e-9)]
    return max(near, key=lambda r: (Fraction(int(r[2]), int(r[3])), -r[1], -r[3]))


def planted_source(doc_id: int | None, n: int) -> np.ndarray:
    """Which word stands at each of a document's n places: its own, or for a tenth of all ids a block of its last words
    over and over. Nothing is planted where the id is null."""
    out = np.arange(n)
    if doc_id is None or not n:
        return out
    h = crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0:
        a = g % n
        out[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return out


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, Words, list[bytes]]]:
    """First and last row of a block, its words and their bytes."""
    for row, data, offsets in blocks(texts):
        found = words(data, offsets)
        raw = data.tobytes()
        yield row, row + len(offsets) - 1, found, [raw[a:b] for a, b in zip(found.start.tolist(), found.end.tolist(), strict=True)]


REPORT = ("doc_id {}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, found, pieces in _blocks(batch["text"]):
            ids = batch["doc_id"].slice(low, high - low)
            first = found.first
            source = np.concatenate([np.zeros(0, np.int64), *(a + planted_source(i, b - a) for i, a, b in zip(
                ids.to_pylist(), first, first[1:], strict=False))])
            runs = find_runs(found.hashes()[source], first)
            kept = ~dropped(runs, first)
            cut = np.searchsorted(runs[:, 0], np.arange(len(ids) + 1))
            best, listed, collapsed = [], [], []
            for t, (a, b) in enumerate(zip(first, first[1:], strict=False)):
                mine = runs[cut[t]:cut[t + 1]]
                best.append(strongest(mine))
                listed.append(sha256("".join(f"{s},{k},{p}\n" for _, s, k, p in mine.tolist()).encode()).hexdigest())
                collapsed.append(sha256(b" ".join([pieces[i] for i in source[a:b][kept[a:b]].tolist()])).hexdigest())

            def column(value, best=best):
                return pa.array([None if r is None else value(r) for r in best], pa.int64())

            yield pa.RecordBatch.from_pydict({
                "doc_id": ids, "n_runs": pa.array(np.diff(cut), pa.int64()), "start": column(lambda r: int(r[1])),
                "length": column(lambda r: int(r[2])), "period": column(lambda r: int(r[3])),
                "exponent_milli": column(lambda r: 1000 * int(r[2]) // int(r[3])),
                "runs_sha256": pa.array(listed, pa.string()), "collapsed_sha256": pa.array(collapsed, pa.string())})


def run_report(docs: DataFrame) -> DataFrame:
    """Digest of the runs of every document, a tenth of which get a planted run first (``planted_source``).

    A null text is empty and has no words; without runs the four columns of the strongest run are null, the digests are
    those of what is left. Repeated rows each get a row, an empty table none. Other columns are not looked at.
    """
    return map_arrow(docs.select("doc_id", "text"), _reported, REPORT.format(docs.schema["doc_id"].dataType.simpleString()))


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, length, period): a row for each run of each text, in words; equal keys are not told apart."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in blocks(batch["text"]):
                found = words(data, offsets)
                runs = find_runs(found.hashes(), found.first)
                yield pa.RecordBatch.from_arrays([batch["key"].take(pa.array(row + runs[:, 0])), *map(pa.array, runs.T[1:])],
                                                 ["key", "start", "length", "period"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return map_arrow(rows, each, f"key {kind}, start long, length long, period long")


def collapse_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, n_dropped): texts with the first period of each run alone, words joined by one space."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, found, pieces in _blocks(batch["text"]):
                kept = ~dropped(find_runs(found.hashes(), found.first), found.first)
                parts = list(zip(found.first, found.first[1:], strict=False))
                texts = [b" ".join([pieces[i] for i in (a + np.flatnonzero(kept[a:b])).tolist()]).decode() for a, b in parts]
                yield pa.RecordBatch.from_arrays(
                    [batch["key"].slice(low, high - low), pa.array(texts, pa.string()),
                     pa.array([int((~kept[a:b]).sum()) for a, b in parts], pa.int64())], ["key", "text", "n_dropped"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return map_arrow(rows, each, f"key {kind}, text string, n_dropped long")
