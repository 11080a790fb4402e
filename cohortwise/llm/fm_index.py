"""A compressed FM-index in NumPy: suffix array, wavelet matrix, batched backward search."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence of non-negative numbers, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[:max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.zeros(n, dtype=np.int64)
        new[1:] = np.cumsum(ordered[1:] != ordered[:-1])
        rank[order] = new
        if not n or new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class BitVector:
    """Bits in 64-bit words with a count before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)
        self.before = np.concatenate(([0], ones[:-1]))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FMIndex:
    """Index of a sequence of non-negative numbers."""

    def __init__(self, text: np.ndarray) -> None:
        self.places = suffix_array(text)
        counts = np.bincount(text)
        self.starts = np.cumsum(counts) - counts
        self.levels: list[tuple[BitVector, int]] = []
        current = text[self.places - 1]  # the Burrows-Wheeler transform
        self.bits = max(1, int(len(counts) - 1).bit_length())
        for level in reversed(range(self.bits)):
            bit = (current >> level & 1).astype(bool)
            self.levels.append((BitVector(bit), int((~bit).sum())))
            current = np.concatenate((current[~bit], current[bit]))
        symbols = np.arange(len(counts))
        self.base = self.down(symbols, np.zeros(len(counts), dtype=np.int64))

    def down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Follow places through the levels along the bits of their symbols."""
        for (vector, zeros), level in zip(self.levels, reversed(range(self.bits))):
            ones = vector.rank(at)
            at = np.where(symbols >> level & 1, zeros + ones, at - ones)
        return at

    def extend(
        self, symbols: np.ndarray, first: np.ndarray, last: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: intervals of the patterns with a symbol put in front."""
        shift = self.starts[symbols] - self.base[symbols]
        return shift + self.down(symbols, first), shift + self.down(symbols, last)


def repeated(
    index: FMIndex, text: np.ndarray, ends: np.ndarray, length: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Backward search for the ``length`` symbols before each of ``ends``.

    A pattern is given up as soon as its interval holds one place, its own: its matching
    statistic against all other places is below the length. Returns the numbers of the
    patterns that reach it and their intervals.
    """
    alive = np.arange(len(ends))
    first = np.zeros(len(ends), dtype=np.int64)
    last = np.full(len(ends), len(text), dtype=np.int64)
    for step in range(1, length + 1):
        symbols = text[ends[alive] - step]
        first, last = index.extend(symbols, first, last)
        several = last - first > 1
        alive, first, last = alive[several], first[several], last[several]
    return alive, first, last
