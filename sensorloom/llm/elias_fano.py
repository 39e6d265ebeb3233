"""Elias-Fano coding of ascending numbers in flat arrays, with vectorised access and search.

The low bits of all numbers are packed side by side; the high bits are a unary bit vector
with a count per 64-bit word. All parts are plain buffers, so that a level can be kept in a
file or a table's binary column and be looked at in place.
"""

from __future__ import annotations

import numpy as np

_WIDTHS = (32, 16, 8, 4, 2, 1)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` low bits of each value side by side, with eight spare bytes behind."""
    if width == 0:
        return np.zeros(8, np.uint8)
    parts = []
    for i in range(0, len(values), 1 << 18):
        rows = values[i : i + (1 << 18)].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(rows, axis=1, bitorder="little")[:, :width]
        parts.append(np.packbits(bits.ravel(), bitorder="little"))
    return np.concatenate([*parts, np.zeros(8, np.uint8)])


def unpack(packed: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """The values at the places ``at``. Widths up to 57 bits."""
    if width == 0:
        return np.zeros(len(at), np.uint64)
    bit = at * width
    words = np.ndarray((len(packed) - 7,), "<u8", packed, strides=(1,))[bit >> 3]
    return (words >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


def select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th set bit (from 0) of each word."""
    words, k, place = words.copy(), k.copy(), np.zeros(len(k), np.int64)
    for width in _WIDTHS:
        below = np.bitwise_count(words & np.uint64((1 << width) - 1)).astype(np.int64)
        on = k >= below
        k -= np.where(on, below, 0)
        words = np.where(on, words >> np.uint64(width), words)
        place += np.where(on, width, 0)
    return place


class EliasFano:
    """Ascending numbers below ``2**64``; repeats are allowed."""

    def __init__(self, values: np.ndarray):
        values = values.astype(np.uint64)
        self.n = len(values)
        top = int(values[-1]) if self.n else 0
        self.width = min(max((top // max(self.n, 1)).bit_length() - 1, 0), 57)
        self.low = pack(values, self.width)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        self.buckets = top >> self.width
        length = self.n + self.buckets + 1
        bits = np.zeros(-(-length // 64) * 64 + 64, np.uint8)
        bits[high + np.arange(self.n)] = 1
        self.high = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)[:-1]])
        self.zeros = np.arange(len(self.high)) * 64 - self.ones

    def nbytes(self) -> int:
        return self.low.nbytes + self.high.nbytes + self.ones.nbytes + self.zeros.nbytes

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers at the places ``at``."""
        word = np.searchsorted(self.ones, at, side="right") - 1
        place = word * 64 + select_in_word(self.high[word], at - self.ones[word])
        return ((place - at).astype(np.uint64) << np.uint64(self.width)) | unpack(self.low, self.width, at)

    def _begin(self, bucket: np.ndarray) -> np.ndarray:
        """Number of numbers in the buckets before each one; a bucket shares its high bits."""
        k = np.maximum(bucket - 1, 0)
        word = np.searchsorted(self.zeros, k, side="right") - 1
        place = word * 64 + select_in_word(~self.high[word], k - self.zeros[word])
        return np.where(bucket > 0, place - k, 0)

    def find(
        self, values: np.ndarray, first: np.ndarray | None = None, end: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Whether each value is there, and its (first) place or the place of its successor.

        With ``first`` and ``end`` each value is looked for from place first to before end alone.
        """
        if not self.n:
            return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
        values = values.astype(np.uint64)
        wide = values >> np.uint64(self.width)
        bucket = np.minimum(wide, np.uint64(self.buckets)).astype(np.int64)
        low, high = self._begin(bucket), np.minimum(self._begin(bucket + 1), self.n)
        if first is not None:
            low, high = np.maximum(low, first), np.minimum(high, end)
        end = high.copy()
        target = values & np.uint64((1 << self.width) - 1)
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            less = unpack(self.low, self.width, middle) < target[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < high[open_]]
        there = (low < end) & (wide <= np.uint64(self.buckets))
        rest = np.flatnonzero(there)
        there[rest] = unpack(self.low, self.width, low[rest]) == target[rest]
        return there, np.where(wide <= np.uint64(self.buckets), low, self.n)
