"""Scoring by a bigram language model held as sharded Elias-Fano tries.

Texts are cut into blocks of tokens (a written table). Every block sends its bigrams to the
shards of their contexts, those of the training texts with counts. A shard sums the counts
over all blocks, lays them out as a trie of two levels (contexts; successors of each context,
coded relative to it, with quantised smoothed probabilities), and answers the blocks from it.
Blocks then put scores together. No model is ever whole in one place: a shard is bounded by
its size, and the successors of a frequent word are dealt over as many shards as its own count
takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sensorloom.llm.arrow import batch_of
from sensorloom.llm.elias_fano import EliasFano
from sensorloom.session import bounded, write_table

#: Tokens of a block, unless one text has more.
BLOCK_TOKENS = 600_000

#: Tokens that a shard is made for.
SHARD_TOKENS = 1_000_000

#: Weight of the unigram model in a context, in tokens.
MU = 50.0

#: Words of at least this share of all tokens, at most 100,000, are broadcast with their counts.
#: Other words whose successors are dealt over shards reach the blocks that hold them by a join.
BROADCAST_SHARE = 1e-5

#: Levels that a log10 probability is rounded to; code 0 is "not there".
CODES, LOWEST = 255, -12.0

# Hashes of the two tokens that aren't words.
START, END = np.uint64(1), np.uint64(2)
_MIX = np.uint64(0x9E3779B97F4A7C15)

BLOCK = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("held", T.BinaryType()),
        T.StructField("sizes", T.BinaryType()),
        T.StructField("vocabulary", T.BinaryType()),
        T.StructField("trained", T.BinaryType()),
        T.StructField("tokens", T.BinaryType()),
    ]
)
SENT = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("block", T.LongType()),
        T.StructField("contexts", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
        T.StructField("dealt", T.BinaryType()),
        T.StructField("sizes", T.BinaryType()),
        T.StructField("successors", T.BinaryType()),
        T.StructField("pairs", T.BinaryType()),
    ]
)
ANSWER = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("counts", T.BinaryType()),
        T.StructField("codes", T.BinaryType()),
        T.StructField("words", T.LongType()),
        T.StructField("once", T.LongType()),
        T.StructField("twice", T.LongType()),
    ]
)


def planes(values: np.ndarray, size: int = 4) -> bytes:
    """Numbers of ``size`` bytes as planes of bytes, which compress well where numbers are small."""
    return np.ascontiguousarray(values.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T).tobytes()


def from_planes(data: bytes, size: int = 4) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(f"<u{size}").ravel()


def rows_of(table: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    """The rows, each made into values when it is its turn: a batch may hold many blocks."""
    for i in range(table.num_rows):
        yield table.slice(i, 1).to_pylist()[0]


class _Words(dict):
    """Numbers of words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _packed_block(block: int, keys: list, held: list[bool], docs: list[np.ndarray], words: _Words) -> list:
    """A block's row: its vocabulary (hashes) by falling frequency, each word's count in the
    training texts, and all tokens as numbers in that vocabulary."""
    digest = xxhash.xxh64_intdigest
    hashes = np.array([*(digest(w, 42) for w in words), int(END)], np.uint64)
    end = len(words)
    sizes = np.array([len(d) + 1 for d in docs], np.int64)
    tokens = np.concatenate([x for d in docs for x in (d, np.array([end], np.int32))])
    frequency = np.bincount(tokens, minlength=end + 1)
    order = np.argsort(-frequency, kind="stable")
    number = np.empty(end + 1, np.int64)
    number[order] = np.arange(end + 1)
    trained = np.bincount(tokens[~np.repeat(np.array(held, bool), sizes)], minlength=end + 1)
    return [
        block, keys, np.array(held, bool).tobytes(), sizes.astype("<u4").tobytes(),
        hashes[order].tobytes(), planes(trained[order]), planes(number[tokens]),
    ]


def blocks_of(docs: DataFrame) -> DataFrame:
    """Blocks of the rows of ``docs`` (doc_id, text, held_out), tokenized."""
    fields = [BLOCK[0], T.StructField("keys", T.ArrayType(docs.schema["doc_id"].dataType)), *BLOCK.fields[1:]]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        keys, held, tokens, words, n = [], [], [], _Words(), 0

        def flush() -> pa.RecordBatch:
            return batch_of(schema, *([x] for x in _packed_block(block, keys, held, tokens, words)))

        for batch in batches:
            key_list, held_list = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i in range(batch.num_rows):
                cut = (batch.column(1)[i].as_py() or b"").lower().split()
                tokens.append(np.fromiter(map(words.__getitem__, cut), np.int32, len(cut)))
                keys.append(key_list[i])
                held.append(bool(held_list[i]))
                n += len(cut) + 1
                if n >= BLOCK_TOKENS:
                    yield flush()
                    block += 1
                    keys, held, tokens, words, n = [], [], [], _Words(), 0
        if keys:
            yield flush()

    text = F.col("text").cast("binary").alias("text")
    return docs.select("doc_id", text, "held_out").mapInArrow(run, schema)


class Dealt:
    """Words whose successors are dealt over several shards: sorted hashes, counts in the
    training texts, numbers of shards."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, pieces: np.ndarray):
        order = np.argsort(words)
        self.words, self.counts, self.pieces = words[order], counts[order], pieces[order]

    def __add__(self, more: list | None) -> Dealt:
        """With ``more``, the (word, count, pieces) that a block got by the join."""
        if not more:
            return self
        words = np.array([m["word"] for m in more], np.int64).view(np.uint64)
        counts, pieces = (np.array([m[name] for m in more], np.int64) for name in ("count", "pieces"))
        mine = ((self.words, words), (self.counts, counts), (self.pieces, pieces))
        return Dealt(*(np.concatenate(both) for both in mine))

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word is one of them, its count and its number of shards (else 0 and 1)."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        there = self.words[at] == hashes
        return there, np.where(there, self.counts[at], 0), np.where(there, self.pieces[at], 1)


class Block:
    """A block's row unpacked, and its distinct bigrams in the order of their shards."""

    def __init__(self, row: dict, shards: int, broadcast: Dealt):
        self.held = np.frombuffer(row["held"], bool)
        self.sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        self.hashes = np.append(np.frombuffer(row["vocabulary"], np.uint64), START)
        self.is_dealt, known, pieces = (broadcast + row["split"]).of(self.hashes)
        # Of a dealt word the count over all blocks, of the others that in this block.
        self.trained = np.where(self.is_dealt, known, np.append(from_planes(row["trained"]).astype(np.int64), 0))
        self.tokens = tokens = from_planes(row["tokens"]).astype(np.int32)
        self.before = before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = len(self.hashes) - 1
        held = np.repeat(self.held, self.sizes)
        # Sorted by context and successor; the last bit tells held-out occurrences.
        pair = before.astype(np.int64) << 32 | tokens
        self.order = np.argsort(pair << 1 | held, kind="stable").astype(np.int32)
        pair = pair[self.order]
        self.begins = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]).astype(np.int32)
        pair = pair[self.begins]
        counts = np.add.reduceat((~held)[self.order], self.begins, dtype=np.int32)
        context, successor = (pair >> 32).astype(np.int32), pair.astype(np.int32)
        del pair, held
        short = (self.hashes >> np.uint64(32)).astype(np.uint32)[successor]
        shard = self._shard(context, successor, pieces, shards)
        del successor
        # By shard, context hash and successor: the order in which a shard answers.
        self.by_shard = np.lexsort((short, self.hashes[context], shard)).astype(np.int32)
        self.shard, self.context = shard[self.by_shard], context[self.by_shard]
        self.short, self.counts = short[self.by_shard], counts[self.by_shard]

    def _shard(self, context: np.ndarray, successor: np.ndarray, pieces: np.ndarray, shards: int) -> np.ndarray:
        """The shard of each bigram: its context's first one, and as many on as its piece."""
        home = (self.hashes * _MIX >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
        place = (self.hashes * _MIX)[successor]
        place ^= self.hashes[context]
        place *= _MIX
        place >>= np.uint64(32)
        place *= pieces.astype(np.uint64)[context]
        place >>= np.uint64(32)
        place += home[context]
        place %= np.uint64(shards)
        return place.astype(np.int32)

    def runs(self) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
        """Each shard with its range of bigrams, its contexts and their numbers of successors."""
        bounds = np.flatnonzero(np.r_[True, self.shard[1:] != self.shard[:-1], True])
        for i, j in zip(bounds, bounds[1:]):
            context = self.context[i:j]
            begin = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
            yield int(self.shard[i]), slice(int(i), int(j)), context[begin], np.diff(np.append(begin, j - i))

    def sent(self, block: int) -> Iterator[list]:
        for shard, span, contexts, sizes in self.runs():
            yield [
                shard, block, self.hashes[contexts].tobytes(), planes(self.trained[contexts], 8),
                self.is_dealt[contexts].tobytes(), planes(sizes), self.short[span].tobytes(),
                planes(self.counts[span]),
            ]


class Trie:
    """Contexts and their successors in two Elias-Fano levels.

    A context's successors lie between its pointer and the next one, each as its hash plus the
    last number of the context before, so that the level ascends with far smaller numbers than
    hashes behind ranks would be; what a number means follows from the range it lies in alone.
    ``find`` gives for each bigram the code of log10(c(v, w) / (c(v) + mu)): it takes the
    context's range from the pointers and looks for the successor's number within it.
    """

    def __init__(
        self,
        context: np.ndarray,
        successor: np.ndarray,
        counts: np.ndarray,
        totals: np.ndarray,
        own: np.ndarray,
        mu: float,
    ):
        """``context`` (index into ``own``, the sorted hashes with their ``totals``), ``successor``
        and ``counts`` by bigram, sorted by both, no bigram twice."""
        self.contexts = EliasFano(own)
        first = np.searchsorted(context, np.arange(len(own) + 1))
        self.pointers = EliasFano(first.astype(np.uint64))
        last = np.zeros(len(own) + 1, np.uint64)
        full = np.flatnonzero(np.diff(first))
        last[full + 1] = successor[first[full + 1] - 1]
        self.successors = EliasFano(np.cumsum(last, dtype=np.uint64)[context] + successor)
        share = np.log10(counts / (totals[context] + mu)) if len(counts) else np.zeros(0)
        self.codes = (1 + np.rint((np.clip(share, LOWEST, 0) / LOWEST) * (CODES - 1))).astype(np.uint8)

    def find(self, contexts: np.ndarray, sizes: np.ndarray, successors: np.ndarray) -> np.ndarray:
        known, rank = self.contexts.find(contexts)
        result = np.zeros(len(successors), np.uint8)
        asked = np.flatnonzero(np.repeat(known, sizes))
        if len(asked) and self.successors.n:
            rank, sizes = rank[known], sizes[known]
            first = self.pointers.get(rank).astype(np.int64)
            end = self.pointers.get(rank + 1).astype(np.int64)
            before = np.where(first > 0, self.successors.get(np.maximum(first - 1, 0)), np.uint64(0))
            first, end, before = (np.repeat(x, sizes) for x in (first, end, before))
            found, place = self.successors.find(before + successors[asked], first, end)
            result[asked[found]] = self.codes[place[found]]
        return result


def probability_of(codes: np.ndarray) -> np.ndarray:
    """What a code stands for; 0 for "not there"."""
    return np.where(codes > 0, 10.0 ** ((codes.astype(np.float64) - 1) / (CODES - 1) * LOWEST), 0.0)


def _answered(mu: float):
    """Builds the trie of one shard from the rows that blocks sent, and answers each of them."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        contexts = [np.frombuffer(x, np.uint64) for x in rows["contexts"]]
        sizes = [from_planes(x).astype(np.int64) for x in rows["sizes"]]
        successors = [np.frombuffer(x, np.uint32) for x in rows["successors"]]
        own, at = np.unique(np.concatenate(contexts), return_inverse=True)
        sent = np.concatenate([from_planes(x, 8) for x in rows["counts"]]).astype(np.int64)
        of_dealt = np.concatenate([np.frombuffer(x, bool) for x in rows["dealt"]])
        is_dealt = np.zeros(len(own), bool)
        is_dealt[at[of_dealt]] = True
        totals = np.bincount(at, sent, len(own)).astype(np.int64)
        totals[at[of_dealt]] = sent[of_dealt]
        rare = totals[~is_dealt]  # all words that are counted in this shard alone
        words, once, twice = (rare > 0).sum(), (rare == 1).sum(), (rare == 2).sum()
        key = np.repeat(at.astype(np.uint64), np.concatenate(sizes)) << np.uint64(32) | np.concatenate(successors)
        counts = np.concatenate([from_planes(x) for x in rows["pairs"]]).astype(np.int64)
        key, counts = key[counts > 0], counts[counts > 0]
        order = np.argsort(key, kind="stable")
        key, counts = key[order], counts[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        counts = np.add.reduceat(counts, first) if len(key) else counts
        key = key[first]
        context = (key >> np.uint64(32)).astype(np.int64)
        trie = Trie(context, key.astype(np.uint32).astype(np.uint64), counts, totals, own, mu)
        answers = []
        for block, c, s, w in zip(rows["block"], contexts, sizes, successors):
            _, rank = trie.contexts.find(c)
            codes = trie.find(c, s, w.astype(np.uint64))
            answers.append((block, shard, planes(totals[rank], 8), codes.tobytes(), None, None, None))
        answers.append((None, shard, b"", b"", int(words), int(once), int(twice)))
        return pd.DataFrame(answers, columns=ANSWER.names)

    return run


def score(docs: DataFrame, mu: float = MU, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text, held_out), learning from those not held out.

    Returns doc_id, n_tokens, n_known, train_tokens, base_score (unigrams with half a count
    added) and score (log10 probability under the interpolated bigram model). A missing text
    is empty and has one token, its end. Without training texts every word is unknown.
    P(w | v) = (c(v, w) + mu P(w)) / (c(v) + mu); P(w) takes a discount from every seen word
    and gives it to the unknown word. Successors are told apart by 32 bits of their hash.
    """
    spark = docs.sparkSession
    with bounded(spark):
        blocks = write_table(blocks_of(docs), "blocks", large_rows=True)
    lengths = blocks.select(F.octet_length("tokens").alias("n"), F.octet_length("held").alias("docs"))
    total = (lengths.agg(F.sum("n")).first()[0] or 0) // 4
    shards = max(24, total // SHARD_TOKENS)
    with bounded(spark):
        dealt, split, trained, documents = _dealt(blocks, total, shards)
    shared = spark.sparkContext.broadcast(dealt)
    if split is None:
        told_blocks = blocks.withColumn("split", F.lit(None).cast("array<struct<word:long,count:long,pieces:long>>"))
    else:
        by_block = split.groupBy("block").agg(F.collect_list(F.struct("word", "count", "pieces")).alias("split"))
        with bounded(spark):
            told_blocks = write_table(blocks.join(by_block, "block", "left"), "split_blocks", large_rows=True)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                for values in Block(row, shards, shared.value).sent(row["block"]):
                    yield batch_of(SENT, *([v] for v in values))

    sent = told_blocks.drop("keys").mapInArrow(send, SENT).repartition(shards, "shard").groupBy("shard")
    with bounded(spark):
        answers = write_table(sent.applyInPandas(_answered(mu), ANSWER), "answers", large_rows=True)
    told = answers.filter("block is null").agg(F.sum("words"), F.sum("once"), F.sum("twice")).first()
    # The start is no word; the end is one, and no context.
    special = np.append(dealt.counts[dealt.words != START], documents)
    more = [(special > 0).sum(), (special == 1).sum(), (special == 2).sum()]
    if split is not None:
        counts = split.select("word", "count").distinct()
        more = np.add(more, counts.agg(*(F.count_if(F.expr(x)) for x in ("count > 0", "count = 1", "count = 2"))).first())
    words, once, twice = (int(x or 0) + int(y) for x, y in zip(told, more))
    discount = once / (once + 2 * twice) if once and twice else 0.5
    key = blocks.schema["keys"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("doc_id", key),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        given = {r["shard"]: r for r in right.select(["shard", "counts", "codes"]).to_pylist()}
        parts = []
        for row in rows_of(left):
            block = Block(row, shards, shared.value)
            counts = np.zeros(len(block.hashes), np.int64)
            codes = np.zeros(len(block.context), np.uint8)
            for shard, span, contexts, _ in block.runs():
                counts[contexts] = from_planes(given[shard]["counts"], 8)
                codes[span] = np.frombuffer(given[shard]["codes"], np.uint8)
            counts = np.where(block.is_dealt, block.trained, counts)
            counts[block.hashes == END] = documents
            pair = np.empty(len(codes), np.float64)
            pair[block.by_shard] = probability_of(codes)
            # Of each word of the vocabulary: its unigram probability and its weight as a context.
            unigram = np.where(counts > 0, (counts - discount) / max(trained, 1), discount * words / max(trained, 1))
            if not trained:
                unigram = np.full(len(counts), 1.0)
            weight = mu / (counts + mu)
            base = np.log10((counts + 0.5) / (trained + 0.5 * (words + 1)))
            p = np.empty(len(block.tokens), np.float64)
            p[block.order] = np.repeat(pair, np.diff(np.append(block.begins, len(p))))
            p += weight[block.before] * unigram[block.tokens]
            np.log10(p, out=p)
            at = np.cumsum(block.sizes) - block.sizes
            known = (counts > 0)[block.tokens]
            values = [
                np.add.reduceat(known, at, dtype=np.int64), np.add.reduceat(base[block.tokens], at), np.add.reduceat(p, at)
            ]
            n = len(block.sizes)
            parts.append(batch_of(schema, row["keys"], block.sizes, values[0], np.full(n, trained), *values[1:]))
        return pa.Table.from_batches(parts, schema=to_arrow_schema(schema))

    answered = answers.filter("block is not null").groupBy("block")
    return told_blocks.groupBy("block").cogroup(answered).applyInArrow(finish, schema)


def _vocabularies(blocks: DataFrame, least: float = 0.0) -> DataFrame:
    """word, count (in training texts) and n (in all) of each block's words of at least half the
    share ``least`` of its tokens."""
    schema = T.StructType([T.StructField(name, T.LongType()) for name in ("block", "word", "count", "n")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                tokens = from_planes(row["tokens"])
                n = np.bincount(tokens)
                some = np.flatnonzero(2 * n >= least * len(tokens))
                words = np.frombuffer(row["vocabulary"], np.int64)[some]
                counts = from_planes(row["trained"]).astype(np.int64)[some]
                yield batch_of(schema, np.full(len(some), row["block"]), words, counts, n[some])

    return blocks.select("block", "vocabulary", "trained", "tokens").mapInArrow(run, schema)


def _dealt(blocks: DataFrame, total: int, shards: int) -> tuple[Dealt, DataFrame | None, int, int]:
    """The words whose successors are dealt over several shards, four for each share that a
    shard has of all tokens: those of at least BROADCAST_SHARE and the start here, the others as
    a written table of block, word, count and pieces, or None if there are none; the number of
    training tokens and of training texts.

    The counts in the training texts are exact. The word before the first one of a text is the
    start; the end is no context.
    """
    share = 1 / (4 * shards)
    often = _vocabularies(blocks, share).groupBy("word").agg(F.sum("n").alias("n"))
    pieces = F.least(F.lit(shards), F.ceil(F.col("n") / (share * max(total, 1)))).cast("long").alias("pieces")
    often = often.filter((F.col("n") >= share * total) & (F.col("word") != int(END))).select("word", "n", pieces)
    often = write_table(often, "often")
    most = BROADCAST_SHARE * total
    rows = often.filter(F.col("n") >= most).collect()
    words = np.array([r["word"] for r in rows] + [int(START)], np.int64).view(np.uint64)
    known = Dealt(words, np.zeros(len(words), np.int64), np.array([r["pieces"] for r in rows] + [shards], np.int64))
    schema = T.StructType([T.StructField("word", T.LongType()), T.StructField("n", T.LongType())])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(known.words) + 2, np.int64)
        for batch in batches:
            for row in rows_of(batch):
                counts = from_planes(row["trained"]).astype(np.int64)
                hashes = np.frombuffer(row["vocabulary"], np.uint64)
                at = np.minimum(np.searchsorted(known.words, hashes), len(known.words) - 1)
                same = known.words[at] == hashes
                np.add.at(sums, at[same], counts[same])
                sums[-2] += counts.sum()
                sums[-1] += int((~np.frombuffer(row["held"], bool)).sum())
        yield batch_of(schema, np.arange(len(sums)), sums)

    counted = blocks.select("vocabulary", "trained", "held").mapInArrow(exact, schema)
    sums = np.zeros(len(known.words) + 2, np.int64)
    for row in counted.groupBy("word").agg(F.sum("n").alias("n")).collect():
        sums[row["word"]] = row["n"]
    known.counts = sums[:-2]
    known.counts[known.words == START] = sums[-1]
    others, split = often.filter(F.col("n") < most), None
    if not others.isEmpty():
        held = _vocabularies(blocks).drop("n").join(others.select("word", "pieces"), "word")
        held = write_table(held, "held_words")
        counts = held.groupBy("word").agg(F.sum("count").alias("count"))
        split = write_table(held.drop("count").join(counts, "word"), "split_words")
    return known, split, int(sums[-2]), int(sums[-1])
