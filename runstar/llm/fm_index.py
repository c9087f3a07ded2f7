"""A compressed full-text index over word sequences: Burrows-Wheeler transform in a wavelet matrix of packed bits.

The transform sorts suffixes by their first ``depth`` words, which is all that patterns of up to that length need.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class Bits:
    """Packed bits that count the ones before a place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        inside = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)


class WaveletMatrix:
    """Counts of any symbol before any place, one row of bits for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels: list[tuple[int, Bits, int]] = []
        begin = np.arange(top + 1)  # where each symbol's own run begins after all levels
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            one = (symbols >> bit) & 1
            zeros = len(one) - int(one.sum())
            row = Bits(one)
            self.levels.append((bit, row, zeros))
            symbols = np.concatenate((symbols[one == 0], symbols[one == 1]))
        begin = self._follow(np.arange(top + 1), np.zeros(top + 1, np.int64))
        self.begin = begin

    def _follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, row, zeros in self.levels:
            ones = row.ones(at)
            at = np.where((symbol >> bit) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._follow(symbol, at) - self.begin[symbol]


def _ranks(first: np.ndarray, shift: int) -> np.ndarray:
    """Ranks of pairs (own rank, rank ``shift`` places on), where the latter is lowest beyond the end."""
    second = np.zeros(len(first), np.int64)
    second[:len(first) - shift] = first[shift:] + 1
    return np.unique(first * (int(first.max()) + 2) + second, return_inverse=True)[1].astype(np.int64)


class Index:
    """Index of weighted word sequences; words are numbers from 1 on, sequences are non-empty."""

    def __init__(self, sequences: Sequence[np.ndarray], weights: Sequence[int], depth: int):
        self.depth = depth
        ends = np.cumsum([len(s) + 1 for s in sequences])
        text = np.zeros(int(ends[-1]), np.int64)  # 0 ends a sequence
        at = 0
        for s in sequences:
            text[at:at + len(s)] = s
            at += len(s) + 1
        ranks, width = text, 1
        while width * 2 <= depth - 1:
            ranks, width = _ranks(ranks, width) if width < len(text) else ranks, width * 2
        near = _ranks(ranks, min(depth - 1 - width, len(text) - 1))  # by depth - 1 words
        order = _ranks(ranks, min(depth - width, len(text) - 1))
        suffixes = np.argsort(order, kind="stable")
        top = int(text.max())
        self.tree = WaveletMatrix(text[suffixes - 1], top)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        weight = np.repeat(np.asarray(weights, np.int64), np.diff(ends, prepend=0))
        self.weight = np.concatenate(([0], np.cumsum(weight[suffixes])))
        # of each suffix, the run of those that agree with it in depth - 1 words
        edge = np.flatnonzero(np.diff(near[suffixes], prepend=-1))
        run = np.cumsum(np.diff(near[suffixes], prepend=-1) != 0) - 1
        self.run_from, self.run_to = edge[run], np.append(edge[1:], len(text))[run]

    def extend(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: intervals of patterns that begin one word earlier."""
        both = self.less[word] + self.tree.rank(np.concatenate((word, word)),
                                                np.concatenate((low, high))).reshape(2, -1)
        return both[0], both[1]

    def window_weights(self, sequences: Sequence[np.ndarray]) -> list[np.ndarray]:
        """For each window of ``depth`` words of each sequence, the weight of its occurrences in the index.

        The sequences are read backwards together, one word a step. Their matching statistics are cut at ``depth``: a match of
        ``depth`` words drops its last word before it takes the next, by the run of suffixes that agree so far. The sequences
        must be indexed themselves, so that no interval empties.
        """
        order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        lengths = np.array([len(sequences[i]) for i in order])
        last = np.cumsum(lengths) - 1
        text = np.concatenate([sequences[i] for i in order])
        low = np.zeros(len(order), np.int64)
        high = np.full(len(order), len(self.run_from), np.int64)
        steps: list[np.ndarray] = []
        for step in range(int(lengths[0])):
            n = int(np.searchsorted(-lengths, -step, "left"))  # those with a word left
            low, high = self.extend(text[last[:n] - step], low[:n], high[:n])
            if step >= self.depth - 1:
                steps.append(self.weight[high] - self.weight[low])
                low, high = self.run_from[low], self.run_to[low]
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(order)
        for k, i in enumerate(order):
            windows = max(0, int(lengths[k]) - self.depth + 1)
            out[i] = np.array([steps[windows - 1 - w][k] for w in range(windows)], np.int64)
        return out
