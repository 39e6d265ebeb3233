"""Byte-pair encoding and decoding with a pair occurrence index.

A task numbers the distinct pieces of its texts and encodes them together: every pair of
neighbouring symbols that the vocabulary can merge is indexed by rank with all its
positions, ranks are applied in ascending order, and a merge enters the pairs it makes
into the lists of their ranks. Positions that another merge has used up meanwhile are
dropped when their list is applied. Texts are then put together from their pieces.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A vocabulary file up to this size is handed to the executors.
VOCABULARY_BYTES = 64 * 1024 * 1024

#: Pieces and distinct pieces that a task holds before it encodes them.
PIECES = 4_000_000
DISTINCT = 400_000

# Fixed value: the pattern by which byte-level vocabularies cut texts into pieces.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand
    for themselves, all others for the letters from 256 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def check_kind(text: bytes) -> None:
    """Raise ValueError for a tokenizer file whose ids this module would not reproduce: only
    byte-level BPE without a normaliser, cut by PATTERN, with plain added tokens is known."""
    spec = json.loads(text)
    model, cutter, decoder = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
    options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    problems = {
        "model": model.get("type", "BPE") != "BPE" or any(model.get(x) for x in options),
        "normalizer": spec.get("normalizer") is not None,
        "pre_tokenizer": cutter.get("type") != "ByteLevel"
        or cutter.get("add_prefix_space", True)
        or not cutter.get("use_regex", True),
        "decoder": decoder.get("type") != "ByteLevel",
        "added_tokens": any(t.get(x) for t in spec.get("added_tokens", []) for x in ("single_word", "lstrip", "rstrip")),
    }
    unknown = [name for name, found in problems.items() if found]
    if unknown:
        raise ValueError(f"not a plain byte-level BPE tokenizer file: {', '.join(unknown)}")


class Vocabulary:
    """Merges and token bytes of a tokenizer file, as arrays."""

    def __init__(self, text: bytes):
        spec = json.loads(text)
        model, letters = spec["model"], byte_letters()
        vocab, byte_of = model["vocab"], {c: b for b, c in enumerate(letters)}
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.apart = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.cut = regex.compile(PATTERN)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1 where the vocabulary doesn't merge it."""
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], -1)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and where each begins (and the last ends)."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lengths)
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        filled = lengths > 0
        after[ends[filled] - 1] = -1
        before[(ends - lengths)[filled]] = -1
        alive = np.ones(n, bool)
        lists: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            ranks = self.rank_of(symbols[at], symbols[after[at]])
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            bounds = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(at)]
            for i, j in zip(bounds, bounds[1:]):
                rank = int(ranks[i])
                if rank not in lists:
                    lists[rank] = []
                    heapq.heappush(active, rank)
                lists[rank].append(at[i:j])

        if n:
            enter(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            parts = lists.pop(rank)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            left, right = self.left[rank], self.right[rank]
            at = at[alive[at] & (symbols[at] == left) & (after[at] >= 0)]
            at = at[symbols[after[at]] == right]
            if left == right and len(at) > 1:
                at = np.sort(at)
                begins = np.r_[True, after[at[:-1]] != at[1:]]
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0]
            if not len(at):
                continue
            used = after[at]
            alive[used] = False
            symbols[at] = self.made[rank]
            beyond = after[used]
            after[at] = beyond
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            left_of = before[at]
            enter(np.unique(np.concatenate([left_of[left_of >= 0], at[inner]])))

        kept = np.r_[0, np.cumsum(alive)]
        return symbols[alive], kept[np.r_[0, ends]]

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text in order. Special tokens are pieces of their own."""
        if self.apart is None:
            return self.cut.findall(text)
        parts = self.apart.split(text)
        if len(parts) == 1:
            return self.cut.findall(text)
        found = []
        for i, part in enumerate(parts):
            found += [(part,)] if i % 2 else self.cut.findall(part)
        return found

    def decode(self, ids: np.ndarray) -> str:
        """The bytes of the ids as text; bytes that aren't valid UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_loaded: dict[int, Vocabulary] = {}


def vocabulary(text: bytes) -> Vocabulary:
    """The vocabulary of a file's content, kept in this worker."""
    key = hash(text)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(text)
    return _loaded[key]


class _Numbering(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def encode_texts(vocab: Vocabulary, texts: Iterator[str | None]) -> Iterator[np.ndarray]:
    """Ids of each text, in order. Holds a bounded number of pieces, or else one text."""
    numbers, held, n = _Numbering(), [], 0

    def made() -> Iterator[np.ndarray]:
        special = {number: vocab.special[key[0]] for key, number in numbers.items() if isinstance(key, tuple)}
        flat, starts = vocab.encode([b"" if isinstance(key, tuple) else key.encode() for key in numbers])
        if special:  # a special token is one id, in place of no bytes
            sizes = np.diff(starts)
            at = np.fromiter(special, np.int64, len(special))
            flat = np.insert(flat, starts[at], np.fromiter(special.values(), np.int64, len(special)))
            sizes[at] = 1
            starts = np.r_[0, np.cumsum(sizes)]
        flat, sizes = flat.astype("<u4"), np.diff(starts)
        for pieces in held:
            size = sizes[pieces]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            yield flat[np.repeat(starts[pieces] - (ends - size), size) + np.arange(total)]

    for text in texts:
        cut = vocab.pieces(text or "")
        held.append(np.fromiter(map(numbers.__getitem__, cut), np.int64, len(cut)).astype(np.int32))
        n += len(cut)
        if n >= PIECES or len(numbers) >= DISTINCT:
            yield from made()
            numbers, held, n = _Numbering(), [], 0
    yield from made()


def encode_decode(docs: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns one row per row of ``docs``: the key, ``n_tokens``, ``ids`` (little-endian
    unsigned 32-bit integers, one after the other) and ``decoded``. A missing text counts as
    empty and has no ids; equal rows give equal results; an empty table gives none. Tokens
    that the file adds apart from its merges (special ones) are found in texts as well. A
    file of another kind than byte-level BPE raises ValueError.
    """
    with open(tokenizer_path, "rb") as file:
        content = file.read(VOCABULARY_BYTES + 1)
    if len(content) > VOCABULARY_BYTES:
        raise ValueError(f"vocabulary file of more than {VOCABULARY_BYTES} bytes")
    check_kind(content)
    shared = docs.sparkSession.sparkContext.broadcast(content)
    fields = [
        docs.schema[key],
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("decoded", T.StringType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(shared.value)
        keys: list[pa.Scalar | None] = []

        def texts() -> Iterator[str | None]:
            for batch in batches:
                for i in range(batch.num_rows):
                    keys.append(batch.column(0)[i])
                    yield batch.column(1)[i].as_py()

        rows, size, done = [], 0, 0
        for ids in encode_texts(vocab, texts()):
            rows.append((keys[done].as_py(), len(ids), ids.tobytes(), vocab.decode(ids)))
            keys[done] = None
            done += 1
            size += 8 * len(ids) + 64
            if size >= 4_000_000:
                yield _batch(rows, kinds)
                rows, size = [], 0
        if rows:
            yield _batch(rows, kinds)

    schema = T.StructType(fields)
    kinds = to_arrow_schema(schema)
    return docs.select(key, text).mapInArrow(run, schema)


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)
