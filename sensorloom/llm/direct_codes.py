"""Directly addressable codes: numbers cut into byte-wide chunks, one level for each chunk.

The first level holds the lowest byte of every number and a bitmap that tells which of them
go on; the next level holds the next byte of just those, and so on. A directory of counts
over each bitmap gives the place of a number on the next level, so that any number, or any
run of numbers, is read without decoding the ones before it.
"""

from __future__ import annotations

import numpy as np

#: Bits that share an absolute count in the directory; words of 64 bits have one relative to it.
SUPER = 512


class Bitmap:
    """Bits with a rank directory, as views of a buffer."""

    def __init__(self, words: np.ndarray, supers: np.ndarray, inner: np.ndarray):
        self.words, self.supers, self.inner = words, supers, inner

    @classmethod
    def of(cls, bits: np.ndarray) -> Bitmap:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, "<u8")
        words.view(np.uint8)[: len(packed)] = packed
        before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]
        supers = before[:: SUPER // 64]
        inner = before - np.repeat(supers, SUPER // 64)[: len(words)]
        return cls(words, supers.astype("<u8"), inner.astype("<u2"))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = at >> 6
        below = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.supers[at // SUPER].astype(np.int64) + self.inner[word] + np.bitwise_count(below)

    def test(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def run(self, begin: int, end: int) -> np.ndarray:
        """The bits from ``begin`` up to ``end``."""
        first = begin >> 3
        some = np.unpackbits(self.words.view(np.uint8)[first : (end >> 3) + 1], bitorder="little")
        return some[begin - 8 * first : end - 8 * first].astype(bool)


class DirectCodes:
    """Numbers of up to 32 bits; levels are pairs of chunks and a bitmap (none on the last)."""

    def __init__(self, levels: list[tuple[np.ndarray, Bitmap | None]]):
        self.levels = levels

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @classmethod
    def of(cls, parts: list[np.ndarray]) -> DirectCodes:
        """The codes of the numbers of all parts, one after the other. The list is used up."""
        levels = []
        while True:
            chunks = [part.astype(np.uint8) for part in parts]
            more = np.concatenate([part > 255 for part in parts])
            going_on = bool(more.any())
            levels.append((np.concatenate(chunks), Bitmap.of(more) if going_on else None))
            if not going_on:
                return cls(levels)
            for i, part in enumerate(parts):
                parts[i] = part[part > 255] >> 8

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers at any places."""
        at = np.asarray(at, np.int64)
        found, live = np.zeros(len(at), np.uint32), np.arange(len(at))
        for i, (chunks, more) in enumerate(self.levels):
            found[live] |= chunks[at].astype(np.uint32) << np.uint32(8 * i)
            if more is None:
                break
            on = more.test(at)
            live, at = live[on], more.rank(at[on])
        return found

    def run(self, begin: int, end: int) -> np.ndarray:
        """The numbers from ``begin`` up to ``end``; on every level they lie side by side."""
        found, live = np.zeros(end - begin, np.uint32), None
        for i, (chunks, more) in enumerate(self.levels):
            part = chunks[begin:end].astype(np.uint32) << np.uint32(8 * i)
            if live is None:
                found[:] = part
            else:
                found[live] |= part
            if more is None or begin == end:
                break
            on = np.flatnonzero(more.run(begin, end))
            live = on if live is None else live[on]
            begin, end = more.rank(np.array([begin, end])).tolist()
        return found
