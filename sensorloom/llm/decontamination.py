"""Benchmark decontamination by CGK embeddings, bit-sampling LSH and exact edit distance.

Texts are sequences of words. For an item of L words every window of L words in a document
may be a copy with up to ``(1 - similarity) * L`` word edits. Windows are embedded by random
walks (each step emits the current word and stays or goes on, as a random bit of the word
and the step tells), so that few edits become few differing places; windows and items that
agree in all places of one of many small samples are candidates, and the edit distance of
each candidate is then computed exactly.

Windows that hold too few word pairs of the items of that length to be within the distance
are left out before the walk, and so are those with too few of their words: an edit changes
at most two pairs and one word, so no window within the distance is lost.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.arrow import batch_of, schema_of, text_groups, text_slices

SIMILARITY = 0.8

#: Random walks, samples of places of each walk (both at least), and places of a sample.
WALKS, SAMPLES, PLACES = 6, 16, 2

#: Share of copies with all allowed edits that the walks and samples of a length have to find.
RECALL = 0.99

#: Samples of each walk to choose from.
SAMPLE_CHOICES = (16, 32, 64, 128)

#: Windows that are embedded together, and numbers held for them at most.
WINDOWS, HELD = 20_000, 14_400_000

#: Benchmark text that is compared with all documents in one pass; more of it takes more passes.
BLOCK_BYTES = 16 * 1024 * 1024

#: Characters of documents that are searched together, unless one text is longer.
SEARCHED_CHARS = 6_000_000

WORD = re.compile(r"\w+")
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def allowed(n: int, similarity: float) -> int:
    """Edits allowed in an item of ``n`` words."""
    return math.floor((1 - similarity) * n + 1e-9)


def emitted(windows: np.ndarray, walks: int, bits_of: Callable[[int], np.ndarray]) -> np.ndarray:
    """The symbols that the first 2 L of 3 L steps emit: steps x rows x walks. ``bits_of`` gives
    the bits (walks x symbols) of each 64 steps; a walk that is through emits the empty place."""
    n, length = windows.shape
    steps = 2 * length
    padded = np.concatenate([windows, np.full((n, 1), -1)], axis=1).astype(np.int32)  # -1: through
    rows = np.repeat(np.arange(n) * (length + 1), walks)
    walk = np.tile(np.arange(walks), n)
    flat, at = padded.ravel(), np.zeros(n * walks, np.int64)
    found = np.empty((steps, n * walks), np.int32)
    for step in range(steps):
        symbol = found[step] = flat[rows + at]
        if step % 64 == 0:
            bits = bits_of(step >> 6)
        bit = (bits[walk, symbol] >> np.uint64(step & 63)) & np.uint64(1)
        at += bit.astype(np.int64)
        np.minimum(at, length, out=at)
    return found.reshape(steps, n, walks)


@lru_cache(maxsize=None)
def _agreement(length: int, similarity: float, pairs: int = 48, walks: int = 8) -> np.ndarray:
    """Share of steps in which an item of distinct words and its copy with all allowed edits
    (of mixed kinds, anywhere) emit the same word, for drawn pairs and walks."""
    draw = np.random.default_rng(11)
    edits = allowed(length, similarity)
    rows = np.tile(np.arange(1, length + 1), (2 * pairs, 1))
    symbols = length + 2 * edits + 1
    for copy in rows[1::2]:
        words = list(range(1, length + 1))
        for edit in range(edits):
            at, kind = draw.integers(max(len(words), 1)), draw.integers(3)
            words[at : at + (kind != 1)] = [] if kind == 0 else [length + 1 + edit]
        copy[:] = (words + list(range(length + edits + 1, symbols)))[:length]
    found = emitted(rows, walks, lambda block: draw.integers(0, 2**64, (walks, symbols), np.uint64))
    return (found[:, ::2] == found[:, 1::2]).mean(axis=0)


def effort(length: int, similarity: float, recall: float = RECALL) -> tuple[int, int]:
    """Walks, and samples of each, with which copies of an item of ``length`` words are found
    with the given recall, at the least cost; reckoned for the next length on a grid. There is
    no most of walks; a recall that none can reach raises."""
    if not allowed(length, similarity):
        return WALKS, SAMPLES
    grid = math.ceil(2 ** (math.ceil(4 * math.log2(length) - 1e-9) / 4) - 1e-9)
    agreed, choices = _agreement(grid, similarity) ** PLACES, []
    for samples in SAMPLE_CHOICES:
        missed = ((1 - agreed) ** samples).mean(axis=1)
        if (missed == 1).mean() > 1 - recall:
            continue  # more walks would not do
        for walks in count(WALKS):
            if 1 - (missed**walks).mean() >= recall:
                # A key costs as much as about 20 steps.
                choices.append((walks * (2 * length + 20 * samples), walks, samples))
                break
    if not choices:
        raise ValueError(f"no number of walks finds items of {length} words with a recall of {recall}")
    return min(choices)[1:]


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64 bits of each number."""
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    x = (x ^ (x >> np.uint64(27))) * _MIX
    return x ^ (x >> np.uint64(31))


class Walks:
    """The random bits of all walks, and the places that samples take.

    The bit of a walk, word and step is a hash of the three, made for the words at hand and 64
    steps at a time: what is held grows neither with the words nor with the longest item.
    """

    def __init__(self, walks: int = WALKS, samples: int = SAMPLES, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.seeds = draw.integers(0, 2**64, walks, np.uint64)
        self.places = draw.random((walks, samples, PLACES))

    def keys(self, windows: np.ndarray, walks: int, samples: int) -> np.ndarray:
        """For each window (a row of symbols) its key in every sample: rows x (walks * samples)."""
        n, length = windows.shape
        steps = 2 * length
        present = np.unique(windows)
        own = mixed(present.astype(np.uint64) * _MIX)

        def bits(block: int) -> np.ndarray:
            of_walk = mixed(self.seeds[:walks] + np.uint64(block * int(_MIX) % 2**64))
            # An empty place comes last and has no bits, since a walk that is through stays so.
            return np.pad(mixed(of_walk[:, None] ^ own), ((0, 0), (0, 1)))

        found = emitted(np.searchsorted(present, windows), walks, bits)
        symbols = np.append(present, -1)
        # places: walks x samples; found[place, window, walk]
        places = (self.places[:walks, :samples] * steps).astype(np.int64)
        key = np.arange(walks * samples, dtype=np.uint64) + np.zeros((n, 1), np.uint64)
        of_walk = np.repeat(np.arange(walks), samples)
        for place in range(PLACES):
            taken = symbols[found[places[:, :, place].ravel(), :, of_walk].T]  # windows x (walks * samples)
            key = (key ^ (taken + 1).astype(np.uint64)) * _MIX
            key ^= key >> np.uint64(29)
        return key


def distances(windows: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Word edit distance of each item (row) and the best beginning of its window (row)."""
    n, width = windows.shape
    windows, items = windows.astype(np.int32), items.astype(np.int32)
    kind = np.int16 if width + items.shape[1] < 30_000 else np.int32
    columns = np.arange(width + 1, dtype=kind)
    row = np.broadcast_to(columns, (n, width + 1)).copy()
    for i in range(items.shape[1]):
        changed = np.minimum(row[:, :-1] + (windows != items[:, i : i + 1]), row[:, 1:] + 1)
        best = np.concatenate([np.full((n, 1), i + 1, kind), changed], axis=1)
        row = np.minimum.accumulate(best - columns, axis=1) + columns
    return row.min(axis=1)


def ragged(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All of ``begin, begin + 1, ...`` (``size`` numbers of each), one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def dense(places: np.ndarray, fewest: int, span: int) -> np.ndarray:
    """Every start whose next ``span`` places hold at least ``fewest`` of the ascending ``places``."""
    if len(places) < fewest:
        return places[:0]
    first, last = places[: len(places) - fewest + 1], places[fewest - 1 :]
    lowest = np.maximum(last - span + 1, 0)
    found = lowest <= first
    return np.unique(ragged(lowest[found], first[found] - lowest[found] + 1))


class Matcher:
    """Items of a bounded block, ready to be found in documents."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY):
        self.similarity = similarity
        self.number: dict[str, int] = {}
        texts = [
            (item, np.array([self.number.setdefault(w, len(self.number) + 1) for w in words], np.int64))
            for item, words in ((i, words_of(t or "")) for i, t in items)
            if words
        ]
        self.symbols = len(self.number) + 1
        self.longest = max((len(w) for _, w in texts), default=1)
        self.efforts = {length: effort(length, similarity) for length in {len(w) for _, w in texts}}
        most = [max(x, default=1) for x in zip(*self.efforts.values())] or [WALKS, SAMPLES]
        self.walks = Walks(*most)
        self.groups = []
        for length in sorted({len(w) for _, w in texts}):
            same = [(i, w) for i, w in texts if len(w) == length]
            rows = np.stack([w for _, w in same])
            keys = self.walks.keys(rows, *self.efforts[length])
            flat = keys.ravel()
            order = np.argsort(flat, kind="stable")
            self.groups.append((length, [i for i, _ in same], rows, flat[order], order // keys.shape[1]))
        # The pairs of all items, and for each the groups (lengths) that have it.
        owned = [np.unique(rows[:, :-1] * self.symbols + rows[:, 1:]) for _, _, rows, _, _ in self.groups]
        pairs = np.concatenate([*owned, np.zeros(0, np.int64)])
        group = np.repeat(np.arange(len(owned)), [len(x) for x in owned])
        self.pairs, at = np.unique(pairs, return_inverse=True)
        order = np.argsort(at, kind="stable")
        self.pair_groups = group[order]
        self.pair_begins = np.r_[0, np.cumsum(np.bincount(at, minlength=len(self.pairs)))]
        self.reach = self.longest + allowed(self.longest, similarity)

    def _pairs_left(self, length: int) -> int:
        return max(length - 1 - 2 * allowed(length, self.similarity), 0)

    def find(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """Text index, item, first word, distance and item length of the best place (least
        distance, then first) of every item in every text."""
        if not self.groups:
            return []
        get, parts, begins, ends, total = self.number.get, [], [], [], 0
        pad = np.zeros(self.reach + 1, np.int64)
        for text in texts:
            found = WORD.findall(text.lower())
            parts += [np.fromiter(map(get, found, repeat(0)), np.int64, len(found)), pad]
            begins.append(total)
            ends.append(total + len(found))
            total += len(found) + len(pad)
        symbols = np.concatenate(parts)
        begins, ends = np.array(begins), np.array(ends)
        known = np.flatnonzero((symbols[:-1] > 0) & (symbols[1:] > 0))
        keys = symbols[known] * self.symbols + symbols[known + 1]
        at = np.minimum(np.searchsorted(self.pairs, keys), max(len(self.pairs) - 1, 0))
        there = self.pairs[at] == keys if len(self.pairs) else np.zeros(len(known), bool)
        known, at = known[there], at[there]
        # One entry for each pair in the texts and group that has it, by group and place.
        sizes = self.pair_begins[at + 1] - self.pair_begins[at]
        group = self.pair_groups[ragged(self.pair_begins[at], sizes)]
        order = np.argsort(group, kind="stable")
        places = np.repeat(known, sizes)[order]
        bounds = np.searchsorted(group[order], np.arange(len(self.groups) + 1))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        padded = np.concatenate([symbols, pad])
        for k, (length, *group_rest) in enumerate(self.groups):
            edits, fewest = allowed(length, self.similarity), self._pairs_left(length)
            if fewest:
                starts = dense(places[bounds[k] : bounds[k + 1]], fewest, length + edits - 1)
            else:
                starts = np.flatnonzero(symbols) if edits == 0 else np.arange(total)
            walks, samples = self.efforts[length]
            some = max(min(WINDOWS, HELD // (walks * max(2 * length, samples))), 1)
            for i in range(0, len(starts), some):
                self._match(starts[i : i + some], padded, length, edits, *group_rest, begins, ends, best)
        return [(text, item, place, distance, length) for (text, item), (distance, place, length) in sorted(best.items())]

    def _match(self, at, padded, length, edits, items, rows, sorted_keys, owners, begins, ends, best) -> None:
        # A start in the padding behind a text belongs to no text.
        at = at[at < ends[np.searchsorted(begins, at, side="right") - 1]]
        windows = padded[at[:, None] + np.arange(length)]
        of_items = np.zeros(self.symbols, bool)
        of_items[rows] = True
        enough = np.count_nonzero(of_items[windows], axis=1) >= length - edits
        at, windows = at[enough], windows[enough]
        keys = self.walks.keys(windows, *self.efforts[length])
        low = np.searchsorted(sorted_keys, keys)
        high = np.searchsorted(sorted_keys, keys, side="right")
        counts = high - low
        window, _ = np.nonzero(counts)
        sizes = counts[counts > 0]
        if not len(sizes):
            return
        first = np.repeat(low[counts > 0], sizes)
        within = np.arange(len(first)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        pairs = np.unique(np.repeat(window, sizes) * len(items) + owners[first + within])
        window, item = pairs // len(items), pairs % len(items)
        text = np.searchsorted(begins, at[window], side="right") - 1
        # Where an item is found word for word, its other windows in that text can't be better.
        exact = (windows[window] == rows[item]).all(axis=1)
        whole = text * len(items) + item
        rest = np.flatnonzero(~exact & ~np.isin(whole, whole[exact]))
        distance = np.zeros(len(pairs), np.int64)
        size = max(min(WINDOWS, HELD // (6 * (length + edits))), 1)
        for i in range(0, len(rest), size):
            some = rest[i : i + size]
            distance[some] = distances(padded[at[window[some], None] + np.arange(length + edits)], rows[item[some]])
        near = np.flatnonzero(exact)
        near = np.concatenate([near, rest[distance[rest] <= edits]])
        places = at[window[near]]
        for t, n, place, d in zip(text[near].tolist(), item[near].tolist(), places.tolist(), distance[near].tolist()):
            found = (d, place - int(begins[t]), length)
            key = (t, items[n])
            if key not in best or found < best[key]:
                best[key] = found


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_bytes``; the driver holds one block at a time."""
    items = benchmark.select("item_id", "text").filter("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = math.ceil(size / block_bytes)
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else items
        yield sorted((r["item_id"], r["text"]) for r in part.collect())


def contaminated(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Documents that hold an item: doc_id, item_id, begin_word, distance and similarity of the
    best place, one row for each document row and item found in it.

    Documents without an item give no row. Missing and empty texts hold nothing; a missing
    or empty item, or one without an id, is found nowhere; repeated rows are found each.
    Items of less than five words must match exactly.
    """
    spark = docs.sparkSession
    schema = schema_of(
        docs, "doc_id", ("item_id", benchmark.schema["item_id"].dataType), ("begin_word", T.IntegerType()),
        ("distance", T.IntegerType()), ("similarity", T.DoubleType()),
    )
    found = None
    for items in _blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(cloudpickle.dumps((items, similarity)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(*cloudpickle.loads(shared.value))
            for keys, texts in text_groups(batches, SEARCHED_CHARS):
                rows = [(keys[t], i, p, d, 1 - d / n) for t, i, p, d, n in matcher.find(texts)]
                if rows:
                    yield batch_of(schema, *zip(*rows))

        part = docs.select("doc_id", "text").mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], schema)


def clean(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns, without a shuffle."""
    text = docs.columns.index("text")
    for items in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps((items, similarity)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(*cloudpickle.loads(shared.value))
            for batch in batches:
                for part, texts in text_slices(batch, text, SEARCHED_CHARS):
                    held = {found[0] for found in matcher.find(texts)}
                    yield part.filter(pa.array([i not in held for i in range(len(texts))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
