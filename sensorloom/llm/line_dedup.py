"""Fuzzy line deduplication by MinHash, exact Jaccard verification and union-find.

1. Each task signs its distinct lines: MinHash over shingles of 8 characters, cut into
   bands. Lines of a task that share a band are candidates at once, and only one of them
   goes on; bands are packed and dealt to buckets by their hash.
2. A bucket links lines of other tasks that share a band. Candidate links make clusters.
3. Within a cluster all pairs of lines are compared by exact Jaccard similarity. A large
   cluster is first compared with a few of its lines; what these leave apart is compared, in
   blocks, with all lines that share a band with it, so that no candidate is lost, no pair is
   emitted and clusters that grow by chance links cost no more than their bands.
4. Of each component over the verified links the first line stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.arrow import batch_of, text_groups
from sensorloom.llm.components import connected, roots
from sensorloom.session import spread, write_table

SHINGLE = 8
SIMILARITY = 0.8

#: 16 bands of 4 places: of pairs at the least similarity about 1 in 5,000 share no band.
BANDS, ROWS = 16, 4
BINS = BANDS * ROWS

#: Lines of more distinct shingles are signed by one permutation cut into bins, the others by
#: one permutation for each place.
SHORT = BINS

SEED = 42

#: Characters that a task signs together, and characters of lines hashed at once.
SIGNED_CHARS = 4_000_000
HASHED_CHARS = 100_000

#: Lines of a cluster that are compared all with all in one piece, and lines that a larger
#: cluster is first compared with.
BLOCK = 128
CENTRES = 64

#: A shingle that more pairs of a comparison share than this is counted by a matrix product.
PAIRWISE = 256

#: Bits of the filter of clustered lines, which is handed to all tasks: 8 MB whatever the input.
FILTER_BITS = 26

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def distinct_lines(texts: list[str]) -> list[str]:
    """The lines with a word, each once, in the order in which they first come."""
    seen: dict[str, None] = {}
    for text in texts:
        seen.update(dict.fromkeys(text.split("\n")))
    return [line for line in seen if line.strip(" \t\n\x0b\x0c\r")]


def keys_of(lines: list[str]) -> np.ndarray:
    """64-bit keys of lines; equal to Spark's xxhash64 of the line."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(x.encode("utf-8", "surrogatepass"), SEED) for x in lines], np.uint64)


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of 8 characters (UTF-16 units) and the index of their line. A
    shorter line is one shingle."""
    pad = "\0" * SHINGLE
    units = np.frombuffer("".join(x + pad for x in lines).encode("utf-16-le", "surrogatepass"), np.uint8)
    if not len(units):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(units) // 2 - SHINGLE + 1
    fours = np.ndarray((n + 4,), "<u8", units, strides=(2,)).astype(np.uint64)
    hashes = fours[:n] * _A
    hashes += fours[4 : n + 4]
    hashes *= _B
    hashes ^= hashes >> np.uint64(32)
    hashes *= _A
    sizes = np.array([len(x) if x.isascii() else len(x.encode("utf-16-le", "surrogatepass")) // 2 for x in lines])
    begins = np.cumsum(sizes + SHINGLE) - sizes - SHINGLE
    counts = np.maximum(sizes - SHINGLE + 1, 1)
    ends = np.cumsum(counts)
    at = np.repeat(begins - (ends - counts), counts) + np.arange(ends[-1])
    return hashes[at], np.repeat(np.arange(len(lines)), counts)


def _long_signature(found: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """One-permutation MinHash: the smallest hash in each of BINS bins; an empty bin takes the
    next filled one's value, going round."""
    empty = np.uint64(2**64 - 1)
    signature = np.full(n * BINS, empty)
    bin_of = (found >> np.uint64(58)).astype(np.int64)
    np.minimum.at(signature, owner * BINS + bin_of, found)
    signature = signature.reshape(-1, BINS)
    twice = np.concatenate([signature, signature], axis=1)
    place = np.where(twice == empty, 2 * BINS, np.arange(2 * BINS))
    following = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    return np.take_along_axis(twice, np.minimum(following, 2 * BINS - 1), axis=1)


def _short_signature(found: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """MinHash with a hash function for each place: few shingles would leave most bins empty,
    and lines that share but one of them would then share bands."""
    places = []
    for i in range(BINS):
        hashes = (found ^ np.uint64((i + 1) * int(_A) % 2**64)) * _B
        places.append(np.minimum.reduceat(hashes ^ (hashes >> np.uint64(32)), begins))
    return np.stack(places, axis=1)


def distinct_sizes(found: np.ndarray, owner: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Number of distinct shingles of each line, told apart by 44 bits of their hash; lines of at
    most SHORT places, which have no more than SHORT, keep their number of places."""
    sizes = places.copy()
    at = np.flatnonzero(places > SHORT)
    for i in range(0, len(at), 1 << 20):
        some = at[i : i + (1 << 20)]
        chosen = np.zeros(len(places), bool)
        chosen[some] = True
        number = np.repeat(np.arange(len(some), dtype=np.uint64), places[some])
        marked = (number << np.uint64(44)) | (found[chosen[owner]] >> np.uint64(20))
        marked.sort()
        first = np.r_[True, marked[1:] != marked[:-1]]
        sizes[some] = np.bincount((marked[first] >> np.uint64(44)).astype(np.int64), minlength=len(some))
    return sizes


def bands(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes of lines and the line of each: BANDS for every line, twice that for those
    between SHORT and 1.25 * SHORT distinct shingles, which are signed in both ways. Two lines
    of the least similarity differ by no more than that in size, so they share one way."""
    found, owner = shingles(lines)
    places = np.bincount(owner, minlength=len(lines))
    sizes = distinct_sizes(found, owner, places)
    values, of_line = [], []
    for kind, chosen in enumerate((sizes > SHORT, sizes <= SHORT / SIMILARITY + 1)):
        at = np.flatnonzero(chosen)
        if not len(at):
            continue
        kept = chosen[owner]
        part, size = found[kept], places[at]
        if kind == 0:
            signature = _long_signature(part, np.repeat(np.arange(len(at)), size), len(at))
        else:
            signature = _short_signature(part, np.cumsum(size) - size)
        result = np.arange(kind * BANDS, (kind + 1) * BANDS, dtype=np.uint64) * _A + np.zeros((len(at), 1), np.uint64)
        for row in range(ROWS):
            result = (result ^ signature[:, row * BANDS : (row + 1) * BANDS]) * _B
            result ^= result >> np.uint64(32)
        values.append(result.ravel())
        of_line.append(np.repeat(at, BANDS))
    return np.concatenate(values), np.concatenate(of_line)


def star(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by value; in it, for each entry the key of its value's first entry, and which
    entries are those first ones."""
    order = np.argsort(values)
    values, keys = values[order], keys[order]
    first = np.r_[True, values[1:] != values[:-1]] if len(values) else np.zeros(0, bool)
    centre = keys[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))] if len(keys) else keys
    return order, centre, first


_EDGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
_PACKED = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("linked", T.BooleanType()),
        T.StructField("left", T.BinaryType()),
        T.StructField("right", T.BinaryType()),
    ]
)


def _signed(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed rows: bands and keys for a bucket, or links between lines of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_groups(batches, SIGNED_CHARS):
            lines = distinct_lines(texts)
            if not lines:
                continue
            values, of_line, begin, size = [], [], 0, 0
            for i, line in enumerate(lines):
                size += len(line)
                if size >= HASHED_CHARS or i + 1 == len(lines):
                    found, owner = bands(lines[begin : i + 1])
                    values.append(found)
                    of_line.append(owner + begin)
                    begin, size = i + 1, 0
            values, keys = np.concatenate(values), keys_of(lines)[np.concatenate(of_line)]
            order, centre, first = star(values, keys)
            values, keys = values[order], keys[order]
            joined = (~first) & (keys != centre)
            if joined.any():
                pairs = np.unique(np.stack([centre[joined], keys[joined]], axis=1), axis=0)
                bucket = int(pairs[0, 1] % np.uint64(buckets))
                yield batch_of(_PACKED, [bucket], [True], [pairs[:, 0].tobytes()], [pairs[:, 1].tobytes()])
            values, keys = values[first], keys[first]  # in order of value, so buckets are runs
            bucket = ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            bounds = np.searchsorted(bucket, np.arange(buckets + 1))
            filled = np.flatnonzero(np.diff(bounds))
            left = [values[bounds[b] : bounds[b + 1]].tobytes() for b in filled]
            right = [keys[bounds[b] : bounds[b + 1]].tobytes() for b in filled]
            yield batch_of(_PACKED, filled.tolist(), [False] * len(filled), left, right)

    return docs.select("doc_id", "text").mapInArrow(run, _PACKED)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate links of a partition, whose rows come bucket by bucket."""

    def links(left: list[bytes], right: list[bytes]) -> Iterator[pa.RecordBatch]:
        values, keys = (np.frombuffer(b"".join(x), np.uint64) for x in (left, right))
        order, centre, first = star(values, keys)
        keys = keys[order]
        joined = keys != centre
        if joined.any():
            pairs = np.unique(np.stack([centre[joined], keys[joined]], axis=1), axis=0).view(np.int64)
            yield batch_of(_EDGE, pairs[:, 0], pairs[:, 1])

    bucket, left, right = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            if row["linked"]:
                yield batch_of(_EDGE, np.frombuffer(row["left"], np.int64), np.frombuffer(row["right"], np.int64))
                continue
            if row["bucket"] != bucket:
                yield from links(left, right)
                bucket, left, right = row["bucket"], [], []
            left.append(row["left"])
            right.append(row["right"])
    yield from links(left, right)


def candidates(docs: DataFrame) -> DataFrame:
    """Links (a, b) between keys of lines, whose components hold all lines that share a band."""
    buckets = max(64, docs.count() // 2_000)
    packed = _signed(docs, buckets)
    return packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_linked, _EDGE)


def _bitmap(keys: DataFrame) -> bytes:
    """A bit for the first FILTER_BITS bits of each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        for batch in batches:
            place = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            np.bitwise_or.at(bits, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        words = bits.view(np.uint64)
        at = np.flatnonzero(words)
        places, found = pa.array(at, pa.int64()), pa.array(words[at].view(np.int64))
        yield pa.RecordBatch.from_arrays([places, found], names=["at", "word"])

    set_words = keys.mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word"))
    words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in set_words.toLocalIterator():
        words[row["at"]] = row["word"]
    return words.tobytes()


def _texts(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Cluster, size, key and text of every clustered line, each line once."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(clusters.select("node")))
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("line", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for _, texts in text_groups(batches, SIGNED_CHARS):
            lines = distinct_lines(texts)
            keys = keys_of(lines)
            place = keys >> np.uint64(64 - FILTER_BITS)
            there = np.flatnonzero(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
            if len(there):
                yield batch_of(schema, keys[there].view(np.int64), [lines[i] for i in there])

    found = docs.select("doc_id", "text").mapInArrow(run, schema)
    return found.join(clusters, "node").groupBy("component", "size", "node").agg(F.first("line").alias("line"))


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of shingles that each left set and each right one have in common. Shingles of one
    side only count for nothing; of the others, those that few pairs share are counted pair by
    pair and the rest by a product of 0/1 matrices."""
    values = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    order = np.argsort(values)
    values, owner = values[order], owner[order]
    begins = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    of_left = np.add.reduceat((owner < len(left)).astype(np.int64), begins)
    of_right = np.diff(np.r_[begins, len(values)]) - of_left
    pairs = of_left * of_right
    at = np.repeat(np.arange(len(begins)), of_left + of_right)
    few = pairs <= PAIRWISE
    shared = np.zeros((len(left), len(right)), np.float32)

    mine, theirs = (np.flatnonzero((few & (pairs > 0))[at] & side) for side in (owner < len(left), owner >= len(left)))
    # Each left entry meets all right ones of its shingle, which lie one after the other.
    first = np.searchsorted(at[theirs], at[mine])
    times = of_right[at[mine]]
    offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    x = np.repeat(owner[mine], times)
    y = owner[theirs[np.repeat(first, times) + offset]] - len(left)
    shared += np.bincount(x * len(right) + y, minlength=shared.size).reshape(shared.shape)

    many = np.flatnonzero(~few)
    for begin in range(0, len(many), 8192):
        columns = many[begin : begin + 8192]
        place = np.full(len(begins), -1)
        place[columns] = np.arange(len(columns))
        chosen = np.flatnonzero(place[at] >= 0)
        held = np.zeros((len(left) + len(right), len(columns)), np.float32)
        held[owner[chosen], place[at[chosen]]] = 1
        shared += held[: len(left)] @ held[len(left) :].T
    return shared


def similar(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> np.ndarray:
    """Whether each left set of shingles and each right one have at least that Jaccard similarity."""
    shared = _shared(left, right)
    sizes = [np.array([len(x) for x in side], np.float64) for side in (left, right)]
    return shared >= similarity * (sizes[0][:, None] + sizes[1][None, :] - shared) - 1e-9


def _sets(lines: list[str]) -> list[np.ndarray]:
    found, owner = shingles(lines)
    bounds = np.searchsorted(owner, np.arange(len(lines) + 1))
    return [np.unique(found[i:j]) for i, j in zip(bounds, bounds[1:])]


def _verified(similarity: float):
    """Verified links within tasks, whose rows (task, side, node, line) come task by task. Side 0
    is compared with side 1 and side 2 with itself."""

    def compare(rows: list[tuple[int, int, str]]) -> tuple[np.ndarray, np.ndarray]:
        nodes, sets = np.array([r[1] for r in rows], np.int64), _sets([r[2] for r in rows])
        side = np.array([r[0] for r in rows])
        if len(rows) == 2:
            shared = len(np.intersect1d(*sets, assume_unique=True))
            near = shared >= similarity * (len(sets[0]) + len(sets[1]) - shared) - 1e-9
            return (nodes[:1], nodes[1:]) if near else (nodes[:0], nodes[:0])
        first, second = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        if not len(first) or not len(second):
            return nodes[:0], nodes[:0]
        x, y = np.nonzero(similar([sets[i] for i in first], [sets[i] for i in second], similarity))
        x, y = first[x], second[y]
        label = roots(x, y, len(nodes))  # as many links as lines, not as pairs
        linked = label != np.arange(len(nodes))
        return nodes[linked], nodes[label[linked]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows, left, right = None, [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            yield batch_of(_EDGE, np.concatenate(left), np.concatenate(right))

        for batch in batches:
            for name, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if name != task and rows:
                    for part, links in zip((left, right), compare(rows)):
                        part.append(links)
                    rows = []
                task = name
                rows.append(tuple(row))
            if left:
                yield from flush()
                left, right = [], []
        if rows:
            yield batch_of(_EDGE, *compare(rows))

    return run


def _compare(tasks: DataFrame, similarity: float) -> DataFrame:
    spark = tasks.sparkSession
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = tasks.select("task", "side", "node", "line").repartition(width, "task").sortWithinPartitions("task", "side")
    return dealt.mapInArrow(_verified(similarity), _EDGE)


def _blocks(size: Column, block: int) -> Column:
    return F.ceil(size / block).cast("int")


def _task(*parts: Column) -> Column:
    return F.concat_ws(":", *(p.cast("string") for p in parts)).alias("task")


def _with_centres(large: DataFrame, block: int) -> DataFrame:
    """Each block of a large cluster with the cluster's centres: of lines that fall in the same
    of CENTRES slots, the one with the smallest hash."""
    blocks, draw = _blocks(F.col("size"), block), F.xxhash64("node")
    mine = large.select(_task(F.col("component"), F.pmod(draw, blocks)), F.lit(0).alias("side"), "node", "line")
    slots = large.groupBy("component", "size", F.pmod(draw, F.lit(CENTRES)).alias("slot")).agg(
        F.min(F.struct(draw.alias("draw"), "node", "line")).alias("centre")
    )
    each = slots.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return mine.unionByName(
        each.select(_task(F.col("component"), F.col("block")), F.lit(1).alias("side"), "centre.node", "centre.line")
    )


def _banded(placed: DataFrame) -> DataFrame:
    """The bands of each line, with its key and part, a row for each."""
    schema = T.StructType([T.StructField(name, T.LongType()) for name in ("band", "node", "part")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, part = batch.column("node").to_numpy(), batch.column("part").to_numpy()
            begin, size, lines = 0, 0, batch.column("line").to_pylist()
            for i, line in enumerate(lines):
                size += len(line)
                if size >= HASHED_CHARS or i + 1 == len(lines):
                    values, of_line = bands(lines[begin : i + 1])
                    yield batch_of(schema, values.view(np.int64), node[of_line + begin], part[of_line + begin])
                    begin, size = i + 1, 0

    return placed.select("node", "part", "line").mapInArrow(run, schema)


def _left_apart(large: DataFrame, found: DataFrame, block: int) -> DataFrame:
    """Of lines that share a band, those that the links found so far don't join to most of the
    band's lines: with all of the band's lines, in blocks. Lines of a cluster that share no band
    don't meet, so what is compared grows with the bands and not with the cluster, which
    chance links may make large. Of bands with the same lines one is enough.
    """
    placed = large.join(connected(found).withColumnRenamed("component", "part"), "node", "left")
    n = large.count()
    placed = write_table(placed.withColumn("part", F.coalesce("part", "node")), "placed", n)
    banded = write_table(_banded(spread(placed)), "banded", 2 * BANDS * n)
    parts = banded.groupBy("band", "part").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("mark"))
    groups = parts.groupBy("band").agg(
        F.max(F.struct("n", "part")).alias("most"), F.sum("n").alias("size"), F.bit_xor("mark").alias("mark")
    )
    groups = groups.filter("size > most.n").groupBy("size", "mark").agg(F.min(F.struct("band", "most")).alias("one"))
    groups = groups.select("one.band", "one.most.part", "size", (F.col("size") - F.col("one.most.n")).alias("apart"))
    joined = banded.join(groups.withColumnRenamed("part", "most"), "band")
    joined = joined.join(placed.select("node", "line"), "node")
    draw, blocks, rest = F.xxhash64("node"), _blocks(F.col("size"), block), _blocks(F.col("apart"), block)
    whole = blocks == 1
    once = joined.filter(whole).select(
        _task(F.col("band")), F.when(F.expr("part <> most"), 2).otherwise(1).alias("side"), "node", "line"
    )
    ahead = joined.filter(~whole & F.expr("part <> most")).withColumn("j", F.explode(F.sequence(F.lit(0), blocks - 1)))
    ahead = ahead.select(_task(F.col("band"), F.pmod(draw, rest), F.col("j")), F.lit(0).alias("side"), "node", "line")
    against = joined.filter(~whole).withColumn("i", F.explode(F.sequence(F.lit(0), rest - 1)))
    against = against.select(_task(F.col("band"), F.col("i"), F.pmod(draw, blocks)), F.lit(1).alias("side"), "node", "line")
    return once.unionByName(ahead).unionByName(against)


def components(docs: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """Key (node) and component of every line that has a near-duplicate other than itself."""
    clusters = connected(candidates(docs))
    sizes = clusters.groupBy("component").agg(F.count("*").alias("size"))
    lines = write_table(_texts(docs, clusters.join(sizes, "component")), "clustered", clusters.count())
    small = lines.filter(F.col("size") <= block)
    tasks = small.select(_task(F.col("component")), F.lit(2).alias("side"), "node", "line")
    large = lines.filter(F.col("size") > block)
    if large.isEmpty():
        return connected(_compare(tasks, similarity))
    compared = _compare(tasks.unionByName(_with_centres(large, block)), similarity)
    # A comparison gives fewer links than it has lines, centres included.
    found = write_table(compared, "verified", (1 + -(-CENTRES // block)) * lines.count())
    rest = _compare(_left_apart(large, found, block), similarity)
    return connected(found.unionByName(rest))


def _version(text: Column | str) -> Column:
    """Tells rows of different texts under one doc_id apart."""
    return F.xxhash64(text).alias("version")


def removals(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, hash of the text (``version``) and the numbers (from 0) of its lines that are copies
    of an earlier line.

    The first line of a component, by doc_id, version and number, stays. Lines without a word
    are never copies. Rows without a doc_id take no part; rows that share one and their text
    are one document.
    """
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("number"), x.alias("line")))
    worded = F.filter(lines, lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"))
    keyed = docs.filter("doc_id is not null").select("doc_id", _version("text"), F.explode(worded).alias("x"))
    keyed = write_table(keyed.select("doc_id", "version", "x.number", F.xxhash64("x.line").alias("node")), "lines")
    named = keyed.join(components(docs, similarity), "node", "left").select(
        "doc_id", "version", "number", F.coalesce("component", "node").alias("component")
    )
    # Both are written, so that the join below deals rows anew and can split a frequent line's.
    n = keyed.count()
    named = write_table(named, "named", n)
    firsts = named.groupBy("component").agg(
        F.min(F.struct("doc_id", "version", "number")).alias("first"), F.count("*").alias("n")
    ).filter("n > 1").select("component", "first")
    firsts = write_table(firsts, "firsts", n)
    copies = named.join(firsts, "component").filter("struct(doc_id, version, number) <> first")
    return copies.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("number")).alias("removed"))


def _free(name: str, df: DataFrame) -> str:
    while name in df.columns:
        name += "_"
    return name


def marked(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_lines (with a word), n_removed and removed of each row of ``docs``. Missing and
    empty texts have no lines."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.select("doc_id", _version("text"), F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"))
    counted = counted.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    found = counted.join(removals(docs, similarity), ["doc_id", "version"], "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return found.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the copied lines taken out of ``text``, and ``n_chars`` (if there is such a
    column) counted anew. All rows stay, also those left without a line."""
    key, version, gone = _free("_key", docs), _free("_version", docs), _free("_gone", docs)
    taken = removals(docs, similarity).select(
        F.col("doc_id").alias(key), F.col("version").alias(version), F.col("removed").alias(gone)
    )
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(
        F.element_at(F.transform(F.array(lines), lambda x: F.array_join(F.transform(kept, lambda i: F.get(x, i)), "\n")), 1)
    )
    same = (docs["doc_id"] == F.col(key)) & (_version(docs["text"]) == F.col(version))
    changed = docs.join(taken, same, "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        recounted = F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
        changed = changed.withColumn("n_chars", recounted)
    return changed.select(*docs.columns)
