"""Token files: the ids of many documents one after the other, in directly addressable codes.

Documents are dealt over tasks by range of their key, so that the files in order of (part,
piece) hold all documents in order. A file has a header, the keys and the ends of its
documents, and the levels of its ids as plain buffers; it can be mapped, and any token or
document of it read in place. A manifest, a small table beside the files, has the number of
ids before each file.
"""

from __future__ import annotations

import json
import os
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.arrow import text_arrays
from sensorloom.llm.common import shards, worker_cache
from sensorloom.llm.direct_codes import Bitmap, DirectCodes
from sensorloom.operators.running import running_totals

#: A tokenizer file up to this size is handed to the executors.
TOKENIZER_BYTES = 64 * 1024 * 1024

#: A file is closed behind the document that fills it.
TOKENS_PER_FILE = 8_000_000

#: Text that one task encodes, about.
PART_BYTES = 128 * 1024 * 1024

#: Distinct segments that a Python worker keeps the ids of, and their bytes. Beyond either it
#: keeps the half that was used most, without those used once.
SEGMENTS, SEGMENT_BYTES = 300_000, 5_000_000

#: Bytes of texts that are encoded together, about.
GROUP_BYTES = 1_000_000

#: Segments that the library gets as one text, and texts that it gets in one call.
AT_ONCE, CALLED = 1_000, 10

#: Segments that are Python objects at a time, besides those that are kept.
LOOKED_UP = 10_000

# The letters that stand for a space and a line end in a byte-level vocabulary.
OPENING_LETTERS = "\u0120\u010A"

# The bytes of white space beyond ASCII (and of U+180E, which some count as such), as
# one number each.
_WIDE_SPACES = [
    int.from_bytes(c.encode()) for c in map(chr, range(0x80, 0xD800)) if c.isspace() or c == "\u180e"
]

# The letters and marks of ASCII that texts are cut between; an apostrophe may begin
# a piece that ends in letters.
_LETTERS = np.isin(np.arange(256), list(string.ascii_letters.encode()))
_MARKS = string.punctuation.replace("'", "").encode()

# The header, in this order: mark, part, piece, ids, documents, levels, checksum of what follows.
HEADER = ">8s6Q"
HEADER_SIZE = struct.calcsize(HEADER)
MARK = b"TOKFILE1"


class _Numbers(dict):
    """Numbers of segments in order of their first use."""

    def __missing__(self, segment):
        self[segment] = n = len(self)
        return n


class _Growing:
    """An array that grows by doubling."""

    def __init__(self, kind):
        self.array, self.n = np.zeros(1 << 16, kind), 0

    def extend(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.array):
            more = max(len(self.array), len(values))
            self.array = np.concatenate([self.array, np.zeros(more, self.array.dtype)])
        self.array[self.n : self.n + len(values)] = values
        self.n += len(values)

    def replace(self, values: np.ndarray) -> None:
        self.n = 0
        self.extend(values)

    @property
    def values(self) -> np.ndarray:
        return self.array[: self.n]


class Encoder:
    """Ids of texts by the tokenizers library.

    A byte-level vocabulary cuts texts into pieces and never merges across them. White space
    behind anything else always begins a piece, and so does a mark (other than an apostrophe)
    behind a letter. So texts are cut there, at spaces, line ends and ASCII marks, and each
    distinct segment goes through the library once, many of them as one text: a segment that
    holds one space or line end, in front, has its ids begin at one that begins so. Whole texts
    go through the library where a file's settings don't allow that. Segments are slices of
    the texts' bytes; only the distinct ones of a call become Python objects.
    """

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(content.decode())
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(content)
        self.cuts = cuts_at_spaces(spec)
        self.marks = np.isin(np.arange(256), list(_MARKS))
        for token in spec.get("added_tokens") or []:
            self.marks[list(token["content"].encode())] = False
        self.opens = np.zeros(self.library.get_vocab_size(with_added_tokens=True) + 1, bool)
        for token, number in self.library.get_vocab(with_added_tokens=False).items():
            if number < len(self.opens):
                self.opens[number] = token[0] in OPENING_LETTERS
            else:
                self.cuts = False
        self.numbers, self.bytes = _Numbers(), 0
        self.ids, self.sizes, self.places, self.uses = _Growing(np.uint32), *(_Growing(np.int64) for _ in range(3))

    def _forget(self) -> None:
        """Keep the segments that were used most."""
        uses = self.uses.values
        kept = np.flatnonzero(uses > 1)
        if len(kept) > SEGMENTS // 2:
            kept = np.sort(kept[np.argpartition(uses[kept], -(SEGMENTS // 2))[-(SEGMENTS // 2) :]])
        known = list(self.numbers)
        known = [known[i] for i in kept.tolist()]
        lengths = np.cumsum(np.fromiter(map(len, known), np.int64, len(known)))
        kept = kept[: np.searchsorted(lengths, SEGMENT_BYTES // 2) + 1]
        self.numbers = _Numbers(zip(known, range(len(kept))))
        self.bytes = int(lengths[len(kept) - 1]) if len(kept) else 0
        sizes = self.sizes.values[kept]
        flat = self.ids.values[_runs(self.places.values[kept], sizes)]
        self.ids.replace(flat)
        self.places.replace(np.cumsum(sizes) - sizes)
        self.uses.replace(uses[kept] >> 1)
        self.sizes.replace(sizes)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for i in range(0, len(texts), CALLED):  # what the library makes is many times its ids
            made = self.library.encode_batch_fast(texts[i : i + CALLED], add_special_tokens=False)
            found += [np.array(e.ids, np.uint32) for e in made]
        return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))

    def _learn(self, new: pa.LargeBinaryArray) -> None:
        """Ids of new segments, which have the next numbers in their order."""
        data, bounds = _bytes_of(new)
        begins, ends = bounds[:-1], bounds[1:]
        # White space at the end of a segment could run on into the next one.
        joins = np.zeros(len(new), bool)
        if self.cuts:
            openings = np.r_[0, np.cumsum(_is_opening(data))]
            joins = (openings[ends] - openings[begins] == 1) & _is_opening(data[begins]) & _behind_solid(data, ends)
        sizes, places = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        for chosen in (joins, ~joins):
            if not chosen.any():
                continue
            some = new.filter(pa.array(chosen))
            if chosen is joins:
                flat, counts = self._joined(some)
            else:
                flat, counts = self._ids([str(s, "utf-8") for s in some.to_pylist()])
            sizes[chosen] = counts
            places[chosen] = self.ids.n + np.cumsum(counts) - counts
            self.ids.extend(flat)
        self.bytes += len(data)
        self.sizes.extend(sizes)
        self.places.extend(places)
        self.uses.extend(np.zeros(len(new), np.int64))

    def _joined(self, words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments that the library gets many of as one text."""
        data, bounds = _bytes_of(words)
        several = np.r_[bounds[:-1:AT_ONCE], bounds[-1]].tolist()
        flat, _ = self._ids([str(data[i:j], "utf-8") for i, j in zip(several, several[1:])])
        begins = np.flatnonzero(self.opens[flat])
        if len(begins) != len(words):
            raise ValueError("the tokenizer file joins words across spaces")
        return flat, np.diff(np.r_[begins, len(flat)])

    def segments(self, texts: pa.LargeBinaryArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """The segments of all texts in order, and where those of each text begin (and the last end)."""
        if not self.cuts:
            return texts, np.arange(len(texts) + 1)
        data, bounds = _bytes_of(texts)
        spaces, marks = np.flatnonzero(_is_opening(data)), np.flatnonzero(self.marks[data])
        cut = np.zeros(len(data) + 1, bool)
        cut[spaces[_behind_solid(data, spaces)]] = True
        cut[marks[_LETTERS[data[marks - 1]]]] = True
        cut[bounds] = True
        cut[len(data)] = False
        begins = np.flatnonzero(cut)
        ends = pa.py_buffer(np.append(begins, len(data)))
        segments = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, ends, pa.py_buffer(data)])
        return segments, np.searchsorted(begins, bounds)

    def encode(self, texts: list[str] | pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each."""
        if len(self.numbers) > SEGMENTS or self.bytes > SEGMENT_BYTES:
            self._forget()
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string()).cast(pa.large_binary())
        segments, bounds = self.segments(texts)
        coded = segments.dictionary_encode()
        known, distinct = len(self.numbers), coded.dictionary
        numbers = np.zeros(len(distinct), np.int64)
        for i in range(0, len(distinct), LOOKED_UP):
            some = distinct.slice(i, LOOKED_UP).to_numpy(zero_copy_only=False).tolist()
            numbers[i : i + len(some)] = np.fromiter(map(self.numbers.__getitem__, some), np.int64, len(some))
        if len(self.numbers) > known:
            self._learn(distinct.filter(pa.array(numbers >= known)))
        used = coded.indices.to_numpy()
        self.uses.values[numbers] += np.bincount(used, minlength=len(numbers))
        sizes = self.sizes.values[numbers][used]
        flat = self.ids.values[_runs(self.places.values[numbers][used], sizes)]
        return flat, np.diff(np.r_[0, np.cumsum(sizes)][bounds])


def _runs(places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all runs one after the other, from each place on."""
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    at = np.repeat(places - (ends - sizes), sizes)
    at += np.arange(n)
    return at


def _bytes_of(array: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array, and where each value begins in them (and the last ends)."""
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(array) + 1, 8 * array.offset) if len(array) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _is_opening(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | (data == 0x0A)


def _behind_solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends at each place is there, and neither white space nor a
    control character of one byte."""
    last = data[at - 1]
    solid = (at > 0) & (last > 0x20) & (last != 0x7F)
    wide = np.flatnonzero(solid & (last >= 0x80))
    codes = sum(data[at[wide] - n].astype(np.int32) << 8 * (n - 1) for n in (1, 2, 3))
    solid[wide] = ~(np.isin(codes & 0xFFFF, _WIDE_SPACES) | np.isin(codes, _WIDE_SPACES))
    return solid


def kept_encoder(content: bytes) -> Encoder:
    """The encoder of a tokenizer file's content, kept in this worker."""
    key, cache = zlib.crc32(content), worker_cache()
    if key not in cache.get("encoder", {}):
        cache["encoder"] = {key: Encoder(content)}
    return cache["encoder"][key]


def cuts_at_spaces(spec: dict) -> bool:
    """Whether a tokenizer file never joins what stands before a space and a word with it."""
    cutter = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    return (
        spec.get("normalizer") is None
        and spec.get("post_processor") is None
        and cutter.get("type") == "ByteLevel"
        and cutter.get("use_regex") is True
        and cutter.get("add_prefix_space") is False
        and spec["model"].get("type") == "BPE"
        and not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word", "normalized"))
        and not any(c.isspace() for t in added for c in t["content"])
    )


class TokenFile:
    """A token file in a buffer, for instance a mapped one; nothing is decoded on opening."""

    def __init__(self, buffer):
        mark, self.part, self.piece, _, n_docs, levels, self.checksum = struct.unpack_from(HEADER, buffer)
        if mark != MARK:
            raise ValueError("not a token file")
        self.buffer, self.at = buffer, HEADER_SIZE
        self.keys = self._section("<i8", n_docs)
        self.missing = self._section(np.uint8, n_docs).astype(bool)
        self.ends = self._section("<u8", n_docs).astype(np.int64)
        found = []
        for _ in range(levels):
            chunks = self._section(np.uint8)
            words = self._section("<u8")
            bitmap = Bitmap(words, self._section("<u8"), self._section("<u2")) if len(words) else None
            found.append((chunks, bitmap))
        self.codes = DirectCodes(found)

    def _section(self, kind, n: int | None = None) -> np.ndarray:
        size = int.from_bytes(self.buffer[self.at : self.at + 8], "big")
        values = np.frombuffer(self.buffer, kind, size // np.dtype(kind).itemsize, self.at + 8)
        if n is not None and len(values) != n:
            raise ValueError("damaged token file")
        self.at += 8 + -(-size // 8) * 8
        return values

    def verify(self) -> None:
        if zlib.crc32(memoryview(self.buffer)[HEADER_SIZE : self.at]) != self.checksum:
            raise ValueError("damaged token file")

    def tokens(self, at) -> np.ndarray:
        """The ids at any places of the file."""
        return self.codes.get(at)

    def document(self, k: int) -> np.ndarray:
        """All ids of the k-th document of the file."""
        return self.codes.run(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def file_bytes(part: int, piece: int, keys: list[int | None], ends: np.ndarray, codes: DirectCodes) -> bytearray:
    """The whole content of a file."""
    sections = [
        np.array([k or 0 for k in keys], "<i8"),
        np.array([k is None for k in keys], np.uint8),
        ends.astype("<u8"),
    ]
    for chunks, bitmap in codes.levels:
        sections.append(chunks)
        sections += [bitmap.words, bitmap.supers, bitmap.inner] if bitmap else [np.zeros(0, "<u8")]
    sizes = [8 + -(-section.nbytes // 8) * 8 for section in sections]
    content = bytearray(HEADER_SIZE + sum(sizes))
    at = HEADER_SIZE
    for section, size in zip(sections, sizes):
        content[at : at + 8] = section.nbytes.to_bytes(8, "big")
        content[at + 8 : at + 8 + section.nbytes] = section.data.cast("B") if section.nbytes else b""
        at += size
    checksum = zlib.crc32(memoryview(content)[HEADER_SIZE:])
    struct.pack_into(HEADER, content, 0, MARK, part, piece, len(codes), len(keys), len(codes.levels), checksum)
    return content


def write(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    text: str = "text",
    key: str = "doc_id",
    end: int | None = 0,
    tokens_per_file: int = TOKENS_PER_FILE,
) -> None:
    """Encode every whole text and write its ids, with the id ``end`` behind each, in files.

    ``key`` is a whole number; rows without one come first. Rows of one key come in the order
    of a hash of their text; rows that are equal in both are interchangeable. A missing text
    counts as empty; other columns are not looked at. An empty table gives no file with rows.
    Files are written by Spark's own committer, so that a task that is run again leaves one.
    """
    with open(tokenizer_path, "rb") as file:
        content = file.read(TOKENIZER_BYTES + 1)
    if len(content) > TOKENIZER_BYTES:
        raise ValueError(f"tokenizer file of more than {TOKENIZER_BYTES} bytes")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(content)
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    parts = shards(size, PART_BYTES, 4 * spark.sparkContext.defaultParallelism)
    words = F.coalesce(F.col(text), F.lit(""))
    # The serial number parts rows that are equal in all: they may be very many.
    order = [F.col("key"), F.col("tie"), F.col("serial")]
    dealt = docs.select(
        F.col(key).cast("bigint").alias("key"),
        words.alias("text"),
        F.xxhash64(words).alias("tie"),
        F.monotonically_increasing_id().alias("serial"),
    ).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, encoder = TaskContext.get().partitionId(), 0, None
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def made() -> pa.RecordBatch:
            content = file_bytes(part, piece, keys, np.cumsum(np.concatenate(sizes)), DirectCodes.of(ids))
            offsets = pa.py_buffer(np.array([0, len(content)], "<i4"))
            column = pa.Array.from_buffers(pa.binary(), 1, [None, offsets, pa.py_buffer(content)])
            return pa.RecordBatch.from_arrays([column], ["content"])

        for some, texts in text_arrays(batches, GROUP_BYTES):
            encoder = encoder or kept_encoder(shared.value)
            flat, counts = encoder.encode(texts)
            if end is not None:
                flat = np.insert(flat, np.cumsum(counts), end)
                counts = counts + 1
            begin = 0
            ends = np.cumsum(counts)
            while begin < len(some):  # documents up to the one that fills the file
                full = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + tokens_per_file - held)) + 1
                upto = min(full, len(some))
                first = int(ends[begin - 1]) if begin else 0
                keys += some[begin:upto]
                taken = flat[first : int(ends[upto - 1])]
                ids.append(taken.astype(np.uint16 if not len(taken) or taken.max() < 1 << 16 else np.uint32))
                sizes.append(counts[begin:upto])
                held += int(ends[upto - 1]) - first
                begin = upto
                if held >= tokens_per_file:
                    yield made()
                    keys, ids, sizes, held, piece = [], [], [], 0, piece + 1
        if keys:
            yield made()

    files = dealt.select("key", "text").mapInArrow(run, "content binary")
    # The text writer writes a string's bytes as they are, here one file for each row.
    rows = files.select(F.col("content").cast("string").alias("value"))
    rows.write.option("maxRecordsPerFile", 1).option("compression", "none").text(f"{path}/files")
    heads = _files(spark, path).select(*[_number(i).alias(n) for i, n in enumerate(_NUMBERS)], F.lit(0).alias("all"))
    ends_of = running_totals(heads, "all", ["part", "piece"], {"end": F.col("n_tokens")})
    starts = ends_of.withColumn("start", F.col("end") - F.col("n_tokens"))
    starts.select(*_NUMBERS, "start").write.parquet(f"{path}/manifest")


_NUMBERS = ("part", "piece", "n_tokens", "n_docs")
MANIFEST = T.StructType([T.StructField(n, T.LongType()) for n in (*_NUMBERS, "start")])


def _number(i: int) -> Column:
    """The i-th number of a file's header."""
    return F.conv(F.hex(F.substring("content", 9 + 8 * i, 8)), 16, 10).cast("bigint")


def _files(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.format("binaryFile").load(f"{path}/files")
    return found.filter(F.col("length") > HEADER_SIZE).select("content")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file: part, piece, n_tokens, n_docs, and start, the ids before it."""
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """All documents of the files: the key, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers, one after the other)."""
    schema = f"part long, piece long, `{key}` long, begin long, n_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                opened = TokenFile(content.as_buffer().to_pybytes())
                opened.verify()
                yield from _rows(opened, key)

    found = _files(spark, path).mapInArrow(run, schema)
    starts = manifest(spark, path).select("part", "piece", F.col("start").alias("first"))
    return found.join(starts, ["part", "piece"]).select(
        key, (F.col("first") + F.col("begin")).alias("start"), "n_tokens", "ids"
    )


def _rows(opened: TokenFile, key: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches of a file's documents, of about ``limit`` ids each."""
    begins, first, n = np.r_[0, opened.ends], 0, len(opened.ends)
    while first < n:
        upto = min(max(int(np.searchsorted(begins, begins[first] + limit, "right")) - 1, first + 1), n)
        ids = opened.codes.run(int(begins[first]), int(begins[upto])).astype("<u4")
        places = begins[first : upto + 1] - begins[first]
        offsets = pa.py_buffer((4 * places).astype("<i4"))
        binary = pa.Array.from_buffers(pa.binary(), upto - first, [None, offsets, pa.py_buffer(ids)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(upto - first, opened.part)),
                pa.array(np.full(upto - first, opened.piece)),
                pa.array(opened.keys[first:upto], mask=opened.missing[first:upto]),
                pa.array(begins[first:upto]),
                pa.array(np.diff(places)),
                binary,
            ],
            ["part", "piece", key, "begin", "n_tokens", "ids"],
        )
        first = upto


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, position: str = "position") -> DataFrame:
    """The id at each position of the whole sequence, read in place: only the files that hold
    an asked position are opened. Positions outside of it, or missing, give no row; a position
    that is asked twice gives two rows.
    """
    width = 1 << 24
    files = manifest(spark, path).filter("n_tokens > 0")
    slots = files.withColumn(
        "slot", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("start") + F.col("n_tokens") - 1) / width)))
    ).select("part", "piece", "start", "n_tokens", "slot")
    asked = positions.select(F.col(position).cast("bigint").alias("position"))
    asked = asked.withColumn("slot", F.floor(F.col("position") / width))
    inside = (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens"))
    found = asked.join(slots, "slot").filter(inside)
    # Places of a file in rows of bounded size, however many are asked.
    places = (
        found.withColumn("some", F.pmod(F.xxhash64("position", F.rand(1)), F.lit(64)))
        .groupBy("part", "piece", "start", "some")
        .agg(F.collect_list(F.col("position") - F.col("start")).alias("places"))
    )
    contents = _files(spark, path).select(*[_number(i).alias(n) for i, n in enumerate(_NUMBERS[:2])], "content")
    both = places.join(contents, ["part", "piece"]).select("start", "places", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = np.array(batch.column(1)[i].as_py(), np.int64)
                ids = TokenFile(batch.column(2)[i].as_buffer().to_pybytes()).tokens(at)
                columns = [pa.array(at + batch.column(0)[i].as_py()), pa.array(ids.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, [position, "token"])

    return both.mapInArrow(run, f"`{position}` long, token long")
