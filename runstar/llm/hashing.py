"""Whitespace words, code points and 64-bit hashes of whole Arrow text columns, computed on their buffers.

Hashes are sums of mixed symbols times powers of an odd number, modulo 2**64, so that the hash of any span comes from
two running totals. Words are the maximal runs of bytes other than 0x20 and 0x09 to 0x0D; a null text has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of text that are handled at once; a longer text is handled alone.
BLOCK = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit moves every output bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """At least ``n`` powers of ``base``, kept between calls up to a block's length."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        np.cumprod(known, out=known)
        if n <= 2 * BLOCK:
            _powers[base] = known
    return known[:n]


def running(symbols: np.ndarray) -> np.ndarray:
    """Totals of ``symbols[i] * BASE**i``, one more than symbols."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers(BASE, len(symbols)), out=out[1:])
    return out


def spans(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the symbols from ``start`` to ``end``, independent of where they stand."""
    value = (total[end] - total[start]) * powers(INVERSE, len(total))[start]
    return mix(value + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of a block of texts: ``first[i]`` to ``first[i + 1]`` are those of text ``i``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return spans(running(_BYTE[self.data]), self.start, self.end)


def blocks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows with at most ``BLOCK`` bytes, or one longer row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        yield row, data[offsets[row]:offsets[last]], offsets[row:last + 1] - offsets[row]
        row = last


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """The words of a block; with ``lower``, A to Z in lower case."""
    if lower:
        data = LOWER[data]
    solid = ~IS_SPACE[data]
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    starts[edge] = solid[edge]
    ends[edge - 1] = solid[edge - 1]
    start = np.flatnonzero(starts)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block's code points and where each text's begin (one more offset than texts)."""
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), lead[offsets]


def grams(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` of these 64-bit symbols, by its first."""
    n = max(0, len(symbols) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(BASE) + symbols[j:j + n]
    return mix(out)


def window_minima(values: np.ndarray, window: int, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``window`` values, and for each the place of its smallest value, the rightmost of equal ones.

    Only windows of whole texts count: those whose ``length`` symbols from the window's first on lie in one text, the
    texts beginning at ``first`` (one more than texts).
    """
    if len(values) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    value, at, width = values, np.arange(len(values), dtype=np.int32), 1
    while width < window:
        shift = min(width, window - width)
        right = value[shift:] <= value[:-shift]
        at = np.where(right, at[shift:], at[:-shift])
        value = np.minimum(value[shift:], value[:-shift])
        width += shift
    whole = np.zeros(len(at) + 1, np.int64)
    long = np.diff(first) >= length
    np.add.at(whole, first[:-1][long], 1)
    np.add.at(whole, first[1:][long] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(whole[:-1]) > 0)
    return start, at[start]
