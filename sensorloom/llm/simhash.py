"""SimHash near-duplicates by exact comparison of tiles of fingerprints.

Equal fingerprints are one. The others are cut into cells by the bit counts of their parts:
two fingerprints of at most ``radius`` differing bits differ by at most that much in the
sum over the parts' bit counts, so that all other pairs of cells are skipped. Cells are cut
into panels, and each pair of panels is dealt to a task, as a grid. There a panel is ordered by
the bit counts of its eight bytes and cut into tiles; pairs of tiles whose counts differ by more
than the radius are skipped, others compared in whole by exclusive-or and bit counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.arrow import batch_of, schema_of
from sensorloom.llm.components import connected, roots
from sensorloom.session import write_table

SHINGLE = 4
SEED = 42
RADIUS = 4

#: Fingerprints of a tile.
TILE = 1_024

#: Tiles of a panel, about.
SIDE = 128

#: Pairs of fingerprints and bytes of panels that a task is made for.
TASK_PAIRS, TASK_BYTES = 20_000_000_000, 64 << 20

#: From this many distinct fingerprints on, cells are by four parts in place of two.
FINE = 4_000_000

#: Shingles whose bits are counted together.
COUNTED = 500_000


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """SimHash of a text's word shingles, repeats included, as an unsigned number; zero for
    a text without words. A-Z are lower-cased; words end at the six ASCII spaces."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, digest = memoryview(b" ".join(words)), xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(joined, SEED)
    begins = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
    hashes = [digest(joined[b : e - 1], SEED) for b, e in zip(begins, begins[size:])]
    bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), COUNTED):
        part = np.array(hashes[i : i + COUNTED], "<u8")
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, version: str | None = None) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of each row, and its ``version`` (a long)."""
    more = [version] if version else []
    schema = schema_of(docs, "doc_id", ("fp", T.LongType()), *((v, T.LongType()) for v in more))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (batch.column(1)[i].as_py() for i in range(batch.num_rows))
            found = np.array([fingerprint(t, size) for t in texts], np.uint64).astype(np.int64)
            yield batch_of(schema, batch.column(0).to_pylist(), found, *batch.columns[2:])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text"), *more).mapInArrow(run, schema)


def near(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs within the radius; for a tile with itself each pair once."""
    left, right = [], []
    for i in range(0, len(a), 256):
        distance = np.bitwise_count(a[i : i + 256, None] ^ b[None, :])
        x, y = np.nonzero(distance <= radius)
        x = x + i
        if same:
            x, y = x[x < y], y[x < y]
        left.append(x)
        right.append(y)
    return np.concatenate(left), np.concatenate(right)


def linked(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same fingerprints as a with b do, at most one for each fingerprint."""
    if len(a) <= 1:
        return a, b
    nodes = np.unique(np.concatenate([a, b]))
    label = roots(np.searchsorted(nodes, a), np.searchsorted(nodes, b), len(nodes))
    joined = label != np.arange(len(nodes))
    return nodes[joined], nodes[label[joined]]


def tiles_of(fps: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The fingerprints ordered by the bit counts of their bytes, and the lowest and highest
    count of each byte in each tile."""
    counts = np.bitwise_count(fps.view(np.uint8).reshape(-1, 8)).astype(np.int8)
    order = np.lexsort(counts.T)
    counts, begins = counts[order], np.arange(0, len(fps), tile)
    return fps[order], np.minimum.reduceat(counts, begins), np.maximum.reduceat(counts, begins)


def compared(a: np.ndarray, b: np.ndarray, radius: int, same: bool, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same fingerprints as all pairs of two panels within the radius do,
    at most one for each fingerprint. Two fingerprints differ by at least as many bits as their
    bytes' counts differ in sum, so that tiles further apart than the radius are skipped."""
    a, low, high = tiles_of(a, tile)
    b, other_low, other_high = (a, low, high) if same else tiles_of(b, tile)
    left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for i in range(len(low)):
        apart = np.maximum(np.maximum(other_low - high[i], low[i] - other_high), 0).sum(axis=1)
        for j in np.flatnonzero(apart <= radius).tolist():
            if same and j < i:
                continue
            one, other = a[i * tile : (i + 1) * tile], b[j * tile : (j + 1) * tile]
            x, y = near(one, other, radius, same and i == j)
            if len(x):
                x, y = linked(one[x], other[y])
                left.append(x)
                right.append(y)
    return linked(np.concatenate(left), np.concatenate(right))


def cell_of(fp: Column, parts: int) -> Column:
    """Bit counts of the fingerprint's equal parts, as one number in base 65."""
    width = 64 // parts
    cell = F.lit(0)
    for part in range(parts):
        mask = ((1 << width) - 1) << (part * width)
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        cell = cell * 65 + F.bit_count(fp.bitwiseAND(F.lit(mask)))
    return cell.cast("long")


def later_offsets(parts: int, radius: int) -> list[int]:
    """Differences between the cells of fingerprints within the radius; one of each two."""
    found = set()
    for steps in product(range(-radius, radius + 1), repeat=parts):
        if sum(map(abs, steps)) <= radius:
            number = 0
            for step in steps:
                number = number * 65 + step
            found.add(max(number, -number))
    return sorted(found)


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE, side: int = SIDE) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within the radius.

    ``distinct`` has each fingerprint once, in a written table. The directory of cells has
    at most 1,089 rows for two parts and 83,521 for four, whatever the input. A panel is shipped
    once for each panel that it is compared with, and each such pair has its own key.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    parts = 4 if n >= FINE else 2
    celled = distinct.select("fp", cell_of(F.col("fp"), parts).alias("cell"))
    sizes = celled.groupBy("cell").agg(F.count("*").alias("n"))
    directory = write_table(sizes.withColumn("panels", F.ceil(F.col("n") / (tile * side))), "cells", n)
    salted = celled.join(F.broadcast(directory), "cell").withColumn("panel", F.pmod(F.xxhash64("fp"), F.col("panels")))
    panels = write_table(salted.groupBy("cell", "panel").agg(F.collect_list("fp").alias("fps")), "panels")
    steps = F.explode(F.array(*(F.lit(o).cast("long") for o in later_offsets(parts, radius))))
    met = directory.select(F.col("cell").alias("met"), F.col("n").alias("met_n"), F.col("panels").alias("met_panels"))

    # Work and bytes of all pairs of panels, for the number of tasks.
    pairs = directory.withColumn("step", steps).withColumn("met", F.col("cell") + F.col("step"))
    work, shipped = (
        pairs.join(F.broadcast(met), "met")
        .agg(F.sum(F.col("n").cast("double") * F.col("met_n")), F.sum(F.expr("8D * (n * met_panels + met_n * panels)")))
        .first()
    )
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    width = max(least, int((work or 0) // TASK_PAIRS), int((shipped or 0) // TASK_BYTES))

    def dealt(sign: int, name: str, own: str, other: str) -> DataFrame:
        """Each panel for each one that it meets, ``sign`` steps ahead of or behind it."""
        far = panels.withColumn("step", steps).withColumn("met", F.col("cell") + sign * F.col("step"))
        each = F.explode(F.expr("sequence(0L, met_panels - 1)"))
        far = far.join(F.broadcast(met), "met").withColumn("met_panel", each)
        far = far.select(
            F.col("cell").alias(own), F.col("panel").alias(f"{own}_panel"), F.col("met").alias(other),
            F.col("met_panel").alias(f"{other}_panel"), F.col("fps").alias(name),
        )
        return far.filter("ahead <> behind or behind_panel <= ahead_panel").repartition(width, *keys)

    keys = ["behind", "behind_panel", "ahead", "ahead_panel"]
    joined = dealt(1, "left", "behind", "ahead").join(dealt(-1, "right", "ahead", "behind"), keys)
    same = F.expr("behind = ahead and behind_panel = ahead_panel").alias("same")
    joined = joined.select("left", "right", same)
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values.to_numpy().view(np.uint64) for c in (0, 1))
                x, y = compared(a, b, radius, batch.column(2)[i].as_py(), tile)
                if len(x):
                    yield batch_of(schema, x.view(np.int64), y.view(np.int64))

    return joined.mapInArrow(run, schema)


def _placed(hashed: DataFrame, least: Column, radius: int) -> DataFrame:
    """Each fingerprint with the least of its rows and the component over links."""
    distinct = write_table(hashed.groupBy("fp").agg(least.alias("least")), "distinct", hashed.count())
    component = connected(links(distinct, radius))
    return distinct.join(component, distinct["fp"] == component["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each row of ``docs``.

    component_id is the smallest doc_id that can be reached over links, the row's own
    included. Missing and empty texts have fingerprint zero and link like any other;
    repeated rows come out repeated. Rows without a doc_id get the component's smallest one.
    """
    hashed = write_table(fingerprints(docs, size), "fingerprints")
    placed = _placed(hashed, F.min("doc_id"), radius)
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(smallest, "component").select("fp", "component_id")
    return hashed.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` of each group: that of the smallest doc_id, and of rows that share it
    the one of the smallest hash of its text. Rows without a doc_id can't be told apart and all
    stay; of rows that share a doc_id and the text one stays."""
    version = "_version"
    while version in docs.columns:
        version += "_"
    named = docs.filter("doc_id is not null").withColumn(version, F.xxhash64("text"))
    hashed = write_table(fingerprints(named, size, version), "fingerprints")
    placed = _placed(hashed, F.min(F.struct("doc_id", version)), radius)
    first = placed.groupBy("component").agg(F.min("least").alias("first"))
    kept = first.select(F.col("first.doc_id").alias("doc_id"), F.col(f"first.{version}").alias(version))
    once = named.join(kept, ["doc_id", version], "left_semi").dropDuplicates(["doc_id", version])
    return once.select(*docs.columns).unionByName(docs.filter("doc_id is null")).select(*docs.columns)
