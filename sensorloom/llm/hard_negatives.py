"""Hard negatives by exact scores, computed the Four-Russians way.

Vectors are whole numbers. A candidate is packed as bit planes: for each group of eight
dimensions and each bit of the numbers, one byte. For each anchor and group a table holds the
sums of all 256 subsets of its eight components, so that a candidate's byte looks up what its
bits add, and the score is the lookups of all groups, shifted by their plane and added.

Anchors and candidates are packed into blocks and dealt over a grid of tiles, some anchors by
some candidates, each one task's work. A first pass scores candidates of the anchor's own
label for the positives; the second pass all others against the bounds that follow from them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sensorloom.session import write_table

#: Rows of a block of candidates or anchors. A block has less than 2 ** BLOCK_BITS rows.
BLOCK, BLOCK_BITS = 1024, 10

#: Anchors and candidates of a tile, about.
TILE_ANCHORS, TILE_CANDIDATES = 4096, 65_536

#: Anchors whose tables are held at once, and candidates that are scored with them at once.
TABLES, SCORED = 64, 512

CANDIDATES, ANCHORS = 0, 1

PACKED = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("block", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("labels", T.BinaryType()),
        T.StructField("vectors", T.BinaryType()),
    ]
)
FOUND = "anchor_row long, anchor_id long, slot int, other_id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(vector: Column, scale: int = 256) -> Column:
    """Each component times ``scale``, rounded down; NULL if any is missing or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(scale * x.cast("double")).cast("bigint")))


def mine(
    rows: DataFrame,
    anchors: Column,
    id: str = "vec_id",
    label: str = "label",
    vector: str = "vector",
    positives: int = 5,
    negatives: int = 10,
    lowest: int = 30,
    highest: int = 90,
) -> DataFrame:
    """For each anchor and each of its positives, the hardest negatives.

    ``vector`` holds whole numbers; shorter ones count as filled up with zeros. An anchor's
    positives are the first ``positives`` other rows of its label by inner product, higher
    first, ties by smaller id. For each of them the first ``negatives`` rows of another label
    whose score is from ``lowest`` to ``highest`` percent of the positive's are returned, with
    their ``rank``. Rows without id, label or vector, or with a missing component, take no part.
    A row with the anchor's own id is no partner of it; other rows that are repeated count as
    often as they are there. An anchor without positives, or without negatives, gives no row;
    neither does an empty table. Components so large that a score could pass 63 bits raise.
    """
    usable = rows.select(
        F.col(id).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<bigint>").alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    ).filter("id is not null and label is not null and vector is not null and forall(vector, x -> x is not null)")
    least, most = F.min(F.array_min("vector")), F.max(F.array_max("vector"))
    n, n_anchors, dims, low, high = usable.agg(
        F.count("*"), F.count_if("anchor"), F.max(F.size("vector")), least, most
    ).first()
    spark = rows.sparkSession
    if not n_anchors:
        return spark.createDataFrame([], RESULT)
    largest = max(abs(low or 0), abs(high or 0), 1)
    if 2 * max(dims, 1) * largest**2 >= 2**63:
        raise ValueError(f"components of up to {largest}: scores would not fit into 63 bits")
    work = _Work(max(-(-dims // 8), 1), largest.bit_length() + 1, 2 * max(dims, 1) * largest**2 < 2**31)
    packed = write_table(usable.mapInArrow(work.pack, PACKED), "vectors")

    supers = -(-n_anchors // TILE_ANCHORS)
    tasks = 3 * spark.sparkContext.defaultParallelism
    groups = max(-(-n // TILE_CANDIDATES), min(-(-n // BLOCK), -(-tasks // supers)))

    by_row = Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), "other_id")
    ranked = F.row_number().over(by_row)

    plain = packed.filter(F.col("kind") == ANCHORS).withColumn("bounds", F.array().cast(BOUNDS))
    found = _on_tiles(plain, packed, supers, groups, work.positives(positives))
    best = found.withColumn("rank", ranked).filter(F.col("rank") <= positives)
    best = write_table(best.select("anchor_row", F.col("rank").alias("slot"), "other_id", "score"), "positives")

    # At most ``positives`` bounds for each of a block's anchors.
    bound = F.struct("anchor_row", "slot", "score")
    bounds = best.groupBy(F.shiftright("anchor_row", BLOCK_BITS).alias("block")).agg(F.collect_list(bound).alias("bounds"))
    bounded = packed.filter(F.col("kind") == ANCHORS).join(bounds, "block")
    found = _on_tiles(bounded, packed, supers, groups, work.negatives(negatives, lowest, highest))
    found = found.withColumn("rank", ranked).filter(F.col("rank") <= negatives)
    named = best.select("anchor_row", "slot", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(named, ["anchor_row", "slot"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


BOUNDS = "array<struct<anchor_row:bigint,slot:int,score:bigint>>"


def _on_tiles(anchors: DataFrame, packed: DataFrame, supers: int, groups: int, score: Callable) -> DataFrame:
    """Meet every block of anchors with every block of candidates, tile by tile: a tile is one
    of ``supers`` parts of the anchors and one of ``groups`` parts of the candidates."""
    own_super, own_group = F.pmod(F.xxhash64("block"), F.lit(supers)), F.pmod(F.xxhash64("block"), F.lit(groups))
    all_groups, all_supers = F.sequence(F.lit(0), F.lit(groups - 1)), F.sequence(F.lit(0), F.lit(supers - 1))
    carried = ["kind", "block", "ids", "labels", "vectors"]
    mine = anchors.select(
        *carried,
        F.col("bounds").cast(BOUNDS).alias("bounds"),
        F.explode(F.transform(all_groups, lambda g: g * supers + own_super)).alias("tile"),
    )
    others = packed.filter(F.col("kind") == CANDIDATES).select(
        *carried,
        F.lit(None).cast(BOUNDS).alias("bounds"),
        F.explode(F.transform(all_supers, lambda s: own_group * supers + s)).alias("tile"),
    )
    tile = F.col("tile").cast("int")
    dealt = mine.unionByName(others).repartitionById(supers * groups, tile).sortWithinPartitions("tile", "kind", "block")
    return dealt.mapInArrow(score, FOUND)


class _Tile:
    """The blocks of one tile, put together."""

    def __init__(self, rows: list[dict], work: _Work):
        anchors = [r for r in rows if r["kind"] == ANCHORS]
        others = [r for r in rows if r["kind"] == CANDIDATES]
        self.complete = bool(anchors and others)
        if not self.complete:
            return
        self.ids = np.concatenate([np.frombuffer(r["ids"], "<i8") for r in others])
        self.labels = np.concatenate([np.frombuffer(r["labels"], "<i8") for r in others])
        shape = (work.planes, work.groups, -1)
        self.planes = np.concatenate([np.frombuffer(r["vectors"], np.uint8).reshape(shape) for r in others], axis=2)
        self.anchor_ids = np.concatenate([np.frombuffer(r["ids"], "<i8") for r in anchors])
        self.anchor_labels = np.concatenate([np.frombuffer(r["labels"], "<i8") for r in anchors])
        self.anchor_rows = np.concatenate(
            [(r["block"] << BLOCK_BITS) + np.arange(len(r["ids"]) // 8, dtype=np.int64) for r in anchors]
        )
        shape = (-1, work.groups, 8)
        self.vectors = np.concatenate([np.frombuffer(r["vectors"], "<i8").reshape(shape) for r in anchors])
        self.bounds: dict[int, list[tuple[int, int]]] = {}
        for row in anchors:
            for b in row["bounds"] or []:
                self.bounds.setdefault(b["anchor_row"], []).append((b["slot"], b["score"]))

    def order(self, by_label: bool) -> None:
        """Sort the candidates by id, or by label and id, and the anchors by label."""
        at = np.lexsort((self.ids, self.labels)) if by_label else np.argsort(self.ids, kind="stable")
        self.ids, self.labels, self.planes = self.ids[at], self.labels[at], np.ascontiguousarray(self.planes[:, :, at])
        at = np.argsort(self.anchor_labels, kind="stable")
        self.anchor_ids, self.anchor_labels = self.anchor_ids[at], self.anchor_labels[at]
        self.anchor_rows, self.vectors = self.anchor_rows[at], self.vectors[at]


def first_by_score(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, of equal ones those that come first; in no order."""
    if len(scores) <= k:
        return np.arange(len(scores))
    kth = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > kth)
    return np.concatenate([above, np.flatnonzero(scores == kth)[: k - len(above)]])


class _Work:
    """Packing and scoring, in tasks. ``groups`` of eight dimensions, ``planes`` bits a number."""

    def __init__(self, groups: int, planes: int, narrow: bool):
        self.groups, self.planes, self.kind = groups, planes, np.int32 if narrow else np.int64

    def pack(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 20, 0
        held: dict[int, list] = {CANDIDATES: [], ANCHORS: []}

        def block(kind: int) -> pa.RecordBatch:
            nonlocal made
            ids, labels, vectors = zip(*held[kind])
            numbers = np.zeros((len(ids), 8 * self.groups), np.int64)
            for row, vector in zip(numbers, vectors):
                row[: len(vector)] = vector
            content = self.bit_planes(numbers) if kind == CANDIDATES else numbers.astype("<i8")
            held[kind] = []
            made += 1
            values = [kind, base + made, np.array(ids, "<i8").tobytes(), np.array(labels, "<i8").tobytes(), content.tobytes()]
            kinds = to_arrow_schema(PACKED)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, kinds)], schema=kinds)

        for batch in batches:
            ids, labels, chosen = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for i, vector in enumerate(batch.column(2)):
                row = (ids[i], labels[i], vector.values.to_numpy(zero_copy_only=False))
                for kind in (CANDIDATES, ANCHORS) if chosen[i] else (CANDIDATES,):
                    held[kind].append(row)
                    if len(held[kind]) == BLOCK:
                        yield block(kind)
        for kind, rows in held.items():
            if rows:
                yield block(kind)

    def bit_planes(self, numbers: np.ndarray) -> np.ndarray:
        """Bytes [plane, group, row]: bit i of a byte is the plane's bit of dimension i."""
        planes = np.empty((self.planes, self.groups, len(numbers)), np.uint8)
        for p in range(self.planes):
            bits = ((numbers >> p) & 1).astype(np.uint8).reshape(len(numbers), self.groups, 8)
            planes[p] = np.packbits(bits, axis=2, bitorder="little")[:, :, 0].T
        return planes

    def tables(self, vectors: np.ndarray) -> np.ndarray:
        """Subset sums [group, subset, anchor] of vectors [anchor, group, dimension]."""
        found = np.zeros((self.groups, 256, len(vectors)), self.kind)
        for i in range(8):
            column = vectors[:, :, i].T.astype(self.kind)[:, None, :]
            found[:, 1 << i : 2 << i] = found[:, : 1 << i] + column
        return found

    def scores(self, tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
        """Inner products [anchor, candidate]. The highest plane holds the signs."""
        n = planes.shape[2]
        found = np.empty((tables.shape[2], n), self.kind)
        for begin in range(0, n, SCORED):
            bytes_ = planes[:, :, begin : begin + SCORED]
            total = np.zeros((bytes_.shape[2], tables.shape[2]), self.kind)
            looked_up = np.empty_like(total)
            for p in range(self.planes - 1, -1, -1):
                total += total
                for g in range(self.groups):
                    np.take(tables[g], bytes_[p, g], axis=0, out=looked_up, mode="clip")
                    if p == self.planes - 1:
                        total -= looked_up
                    else:
                        total += looked_up
            found[:, begin : begin + SCORED] = total.T
        return found

    def _over_tiles(self, of_tile: Callable) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tile, rows = None, []
            for batch in batches:
                for row in batch.to_pylist():
                    if row["tile"] != tile:
                        if rows:
                            yield from of_tile(_Tile(rows, self))
                        tile, rows = row["tile"], []
                    rows.append(row)
            if rows:
                yield from of_tile(_Tile(rows, self))

        return run

    def positives(self, k: int) -> Callable:
        def of_tile(tile: _Tile) -> Iterator[pa.RecordBatch]:
            if not tile.complete:
                return
            tile.order(by_label=True)
            for label in np.unique(tile.anchor_labels):
                begin, end = np.searchsorted(tile.labels, [label, label + 1])
                first, last = np.searchsorted(tile.anchor_labels, [label, label + 1])
                ids, planes = tile.ids[begin:end], tile.planes[:, :, begin:end]
                for some in range(first, last if end > begin else first, TABLES):
                    upto = min(some + TABLES, last)
                    scores = self.scores(self.tables(tile.vectors[some:upto]), planes)
                    found = []
                    for a in range(some, upto):
                        others = np.flatnonzero(ids != tile.anchor_ids[a])
                        mine = scores[a - some][others]
                        best = first_by_score(mine, k)
                        found.append((a, 0, ids[others[best]], mine[best]))
                    yield _batch(tile, found)

        return self._over_tiles(of_tile)

    def negatives(self, k: int, lowest: int, highest: int) -> Callable:
        def of_tile(tile: _Tile) -> Iterator[pa.RecordBatch]:
            if not tile.complete:
                return
            tile.order(by_label=False)
            for some in range(0, len(tile.anchor_ids), TABLES):
                upto = min(some + TABLES, len(tile.anchor_ids))
                scores = self.scores(self.tables(tile.vectors[some:upto]), tile.planes)
                found = []
                for a in range(some, upto):
                    ranges = {}
                    for slot, score in tile.bounds.get(int(tile.anchor_rows[a]), []):
                        low, high = -(-lowest * score // 100), highest * score // 100
                        if low <= high:
                            ranges.setdefault((low, high), []).append(slot)
                    if not ranges:
                        continue
                    mine = scores[a - some]
                    inside = (mine >= min(low for low, _ in ranges)) & (mine <= max(high for _, high in ranges))
                    at = np.flatnonzero(inside & (tile.labels != tile.anchor_labels[a]))
                    values = mine[at]
                    for (low, high), slots in ranges.items():
                        within = np.flatnonzero((values >= low) & (values <= high))
                        best = within[first_by_score(values[within], k)]
                        found += [(a, slot, tile.ids[at[best]], values[best]) for slot in slots]
                yield _batch(tile, found)

        return self._over_tiles(of_tile)


def _batch(tile: _Tile, found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    sizes = [len(ids) for _, _, ids, _ in found]
    anchors = np.repeat(np.array([a for a, *_ in found], np.int64), sizes)
    slots = np.repeat(np.array([slot for _, slot, *_ in found], np.int32), sizes)
    ids = np.concatenate([np.zeros(0, np.int64), *[ids for _, _, ids, _ in found]])
    scores = np.concatenate([np.zeros(0, np.int64), *[s for *_, s in found]]).astype(np.int64)
    columns = [tile.anchor_rows[anchors], tile.anchor_ids[anchors], slots, ids, scores]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_row", "anchor_id", "slot", "other_id", "score"])
