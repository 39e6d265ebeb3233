"""The trie of all conversations by their turns, built from slices of the sorted keys.

A turn has an id of 16 bytes, and a conversation's key is its turns' ids one after the other.
Conversations are cut by range of (key, conversation) into slices of bounded size, so that
neither a common first turn nor a common whole conversation is one task's. Each slice builds
an adaptive radix tree. All nodes of a prefix lie side by side in the order of keys, so a node
can reach into another slice only if it lies on the path to its slice's first or last key.
Nodes off these two paths are complete in their slice. Those on them, the border, are a few
rows for each slice: they are merged by their prefix, and what hangs below them is added up
along the paths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sensorloom.llm.common import SPACES, remainder
from sensorloom.llm.radix_tree import RadixTree, common
from sensorloom.session import write_table

#: Bytes of a turn's id.
ID = 16

#: What one slice holds, about: keys in bytes, and conversations.
SLICE_BYTES, SLICE_CONVERSATIONS = 32 * 1024 * 1024, 100_000

#: Conversations that end at a border node, for each row they are carried in.
ENDS_PER_ROW = 65_536

INNER, BORDER, ENDS = 0, 1, 2

PART = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("slice", T.LongType()),
        T.StructField("node", T.BinaryType()),
        T.StructField("parent", T.BinaryType()),
        T.StructField("branch", T.IntegerType()),
        T.StructField("words", T.LongType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("depth", T.LongType()),
        T.StructField("parent_conv_id", T.LongType()),
        T.StructField("n_convs", T.LongType()),
        T.StructField("n_children", T.LongType()),
        T.StructField("n_leaves", T.LongType()),
        T.StructField("saved_tokens", T.LongType()),
        T.StructField("ends_sha256", T.StringType()),
        T.StructField("ends", T.BinaryType()),
    ]
)
RESULT = [
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
]


def sequences(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row (conv_id, key, words) for each conversation: the ids of its turns one after the
    other, and the number of words of each. Turns are in order of ``turn``, a missing one
    first, and of their id where that is equal. A missing role or text counts as empty; rows
    without a conversation take no part. Texts don't travel, only 32 letters for each turn."""
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    both = F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said)
    turns = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.substring(F.sha2(both, 256), 1, 2 * ID).alias("id"),
            F.regexp_count(said[1], F.lit(f"[^{SPACES[1:]}+")).alias("n"),
        ).alias("t"),
    )
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t"), _in_order).alias("s"))
    return ordered.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("s", lambda t: t["id"]), "")).alias("key"),
        F.transform("s", lambda t: t["n"]).alias("words"),
    )


def _in_order(a: Column, b: Column) -> Column:
    """Order of two turns: a missing place first, then by place, then by id."""
    place = F.when(a["turn"].isNull() & b["turn"].isNull(), 0).when(a["turn"].isNull(), -1).when(b["turn"].isNull(), 1)
    place = place.when(a["turn"] < b["turn"], -1).when(a["turn"] > b["turn"], 1).otherwise(0)
    by_id = F.when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)
    return F.when(place != 0, place).otherwise(by_id)


def with_common_start(sequences: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Give every conversation c the first h turns of conversation c - c % ``group`` in place of
    its own first h, where h is crc32(c) % ``most``. A conversation that isn't there gives none."""
    table = write_table(sequences, "sequences")
    starts = table.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"),
        F.substring("key", 1, ID * (most - 1)).alias("start_key"),
        F.slice("words", 1, most - 1).alias("start_words"),
    )
    h = F.col("h")
    none = F.array().cast("array<int>")
    return (
        table.withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
        .withColumn("h", remainder("conv_id", most).cast("int"))
        .join(starts, "base", "left")
        .select(
            "conv_id",
            F.concat(
                F.coalesce(F.substring("start_key", F.lit(1), ID * h), F.lit(b"")),
                F.substring("key", ID * h + 1, F.greatest(F.octet_length("key") - ID * h, F.lit(0))),
            ).alias("key"),
            F.concat(
                F.coalesce(F.slice("start_words", F.lit(1), h), none),
                F.slice("words", h + 1, F.greatest(F.size("words") - h, F.lit(0))),
            ).alias("words"),
        )
    )


def nodes(sequences: DataFrame, slices: int | None = None) -> DataFrame:
    """One row for each distinct sequence of first turns, from the one without turns on.

    ``conv_id`` is the smallest conversation that starts with it, ``n_convs`` how many do,
    ``n_children`` and ``n_leaves`` count nodes below, ``saved_tokens`` sums, over the node and
    all nodes below, the words of the last turn times the conversations but one.
    ``ends_sha256`` is over the conversations that end here, ascending, joined by commas.
    Conversations are told apart by their id, of which ``sequences`` has one row each. An
    empty table gives no node. A whole key has to fit into a row (2 GB).
    """
    rows = write_table(sequences, "conversations")
    if slices is None:
        size = rows.agg(F.count("*"), F.sum(F.octet_length("key"))).first()
        needed = max(size[0] / SLICE_CONVERSATIONS, (size[1] or 0) / SLICE_BYTES)
        slices = max(rows.sparkSession.sparkContext.defaultParallelism, int(needed) + 1)
    dealt = rows.repartitionByRange(slices, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = write_table(dealt.mapInArrow(_build, PART), "trie-parts")
    border = parts.filter(F.col("kind") == BORDER)
    merged, at_slices = _merged(border)

    inner = parts.filter(F.col("kind") == INNER)
    apart = inner.filter(F.col("parent").isNull()).select(*RESULT)
    lows = at_slices.select("slice", F.col("node").alias("parent"), F.col("low").alias("low"))
    under_border = inner.filter(F.col("parent").isNotNull()).join(lows, ["slice", "parent"])
    under_border = under_border.withColumn("parent_conv_id", F.col("low")).select(*RESULT)

    nothing = hashlib.sha256(b"").hexdigest()
    found = merged.join(_ends(parts.filter(F.col("kind") == ENDS)), "node", "left")
    found = found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
    return apart.unionByName(under_border).unionByName(found.select(*RESULT))


def _merged(border: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The border's nodes as wholes, and for each slice the smallest conversation of its nodes.

    All this is a few rows for each slice, also where one node lies in every slice.
    """
    # A node belongs to the first slice it lies in: there it counts itself.
    whole = border.groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.first("words").alias("words"),
        F.min("slice").alias("owner"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner_children"),
    )
    whole = write_table(whole, "border")
    children = whole.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("border_children"))
    whole = whole.join(children, "node", "left").withColumn(
        "n_children", F.col("inner_children") + F.coalesce("border_children", F.lit(0))
    )
    whole = write_table(whole.drop("inner_children", "border_children"), "border")

    known = whole.select("node", "owner", "n_children", F.col("n_convs").alias("all"), F.col("conv_id").alias("low"))
    # What hangs below a node off the border, and the node itself if it belongs to the slice.
    own = F.col("owner") == F.col("slice")
    rows = border.drop("n_children").join(known, "node").select(
        "slice",
        "node",
        "branch",
        "depth",
        "low",
        (F.col("n_leaves") + F.when(own & (F.col("n_children") == 0), 1).otherwise(0)).alias("leaves"),
        (F.col("saved_tokens") + F.when(own, (F.col("all") - 1) * F.col("words")).otherwise(0)).alias("saved"),
    )
    rows = write_table(rows, "border-rows")
    # Along a path everything deeper lies below; the common part (branch 0) has both branches below.
    deeper = Window.partitionBy("slice", "branch").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    in_slice = Window.partitionBy("slice")

    def below(value: str) -> Column:
        branches = F.sum(F.when(F.col("branch") > 0, F.col(value)).otherwise(0)).over(in_slice)
        return F.sum(value).over(deeper) + F.when(F.col("branch") == 0, branches).otherwise(0)

    sums = rows.select("node", below("leaves").alias("l"), below("saved").alias("s"))
    sums = sums.groupBy("node").agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens"))
    above = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return whole.join(sums, "node").join(above, "parent", "left"), rows


def _ends(ends: DataFrame) -> DataFrame:
    """Digest of the conversations that end at each border node. The digest is sequential by
    nature: one task reads a node's ids, 8 bytes each, but holds one row of them at a time."""
    ordered = ends.select("node", "conv_id", "ends").repartition("node").sortWithinPartitions("node", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, n = None, None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                found = batch.column(0)[i].as_py()
                if found != node:
                    if node is not None:
                        yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [digest.hexdigest()]})
                    node, digest, n = found, hashlib.sha256(), 0
                ids = np.frombuffer(batch.column(2)[i].as_buffer(), "<i8").tolist()
                digest.update(("," if n else "").encode() + _joined(ids))
                n += len(ids)
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [digest.hexdigest()]})

    return ordered.mapInArrow(run, "node binary, ends_sha256 string")


def _joined(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def _digests(key: bytes, upto: int) -> list[bytes]:
    """Digest of the first d turns of a key, for d from 0."""
    running, found = hashlib.sha256(), [hashlib.sha256(b"").digest()[:ID]]
    for d in range(upto):
        running.update(key[ID * d : ID * (d + 1)])
        found.append(running.copy().digest()[:ID])
    return found


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A slice's rows (conversation, key, words), in order of key and conversation, as the rows
    of its part of the trie."""
    tree, convs, words = RadixTree(), [], []
    first = last = None
    for batch in batches:
        convs += batch.column(0).to_pylist()
        words += [np.array(w.values.to_numpy(zero_copy_only=False), np.int32) for w in batch.column(2)]
        for i in range(batch.num_rows):
            key = batch.column(1)[i].as_py()
            tree.insert(key, len(convs) - batch.num_rows + i)
            first = key if first is None else first
            last = key
    if first is None:
        return
    out = _Parts(TaskContext.get().partitionId())
    preorder = tree.preorder()
    shared = common(first, last) // ID
    digests = _digests(first, len(first) // ID), _digests(last, len(last) // ID)

    # How far the path to each tree node's end follows the first key, and the last one.
    follows = []
    for node, parent, above in preorder:
        reach = []
        for k, key in enumerate((first, last)):
            upto = follows[parent][k] if parent >= 0 else 0
            reach.append(upto + common(node.path, key[above : above + len(node.path)]) if upto == above else upto)
        follows.append(reach)

    # From the leaves up: conversations, smallest one, children, leaves and savings off the
    # border, and the records that still wait for their parent.
    sums: list[list] = [[0, None, 0, 0, 0, []] for _ in preorder]
    for at in range(len(preorder) - 1, -1, -1):
        node, parent, above = preorder[at]
        n, low, children, leaves, saved, waiting = sums[at]
        if node.ends:
            n += len(node.ends)
            mine = min(convs[r] for r in node.ends)
            low = mine if low is None else min(low, mine)
        end = above + len(node.path)
        top = above // ID if parent >= 0 else -1
        for depth in range(end // ID, top, -1):
            at_end = depth * ID == end
            ends = sorted(convs[r] for r in node.ends) if at_end else []
            count = int(words[node.row][depth - 1]) if depth else 0
            on_first, on_last = depth * ID <= follows[at][0], depth * ID <= follows[at][1]
            if on_first or on_last:
                branch = 0 if depth <= shared else 1 if on_first else 2
                path = digests[0 if on_first else 1]
                out.waiting(waiting, digest=path[depth])
                out.border(path[depth], path[depth - 1] if depth else None, branch, count, low, depth, n, children, leaves, saved)
                out.ends(path[depth], ends)
                children, leaves, saved, waiting = 0, 0, 0, []
            else:
                out.waiting(waiting, low=low)
                leaves, saved = leaves or 1, saved + (n - 1) * count
                waiting = [out.inner(low, depth, n, children, leaves, saved, ends)]
                children = 1
        if parent >= 0:
            above_it = sums[parent]
            above_it[0] += n
            above_it[1] = low if above_it[1] is None else min(above_it[1], low)
            above_it[2] += children
            above_it[3] += leaves
            above_it[4] += saved
            above_it[5] += waiting
        sums[at] = None
    yield from out.batches()


class _Parts:
    """Rows of a slice's part of the trie."""

    def __init__(self, number: int):
        self.number, self.rows, self.columns = number, 0, {name: [] for name in PART.fieldNames()}

    def _add(self, **values) -> int:
        for name, column in self.columns.items():
            column.append(values.get(name))
        self.columns["slice"][-1] = self.number
        self.rows += 1
        return self.rows - 1

    def inner(self, low, depth, n, children, leaves, saved, ends) -> int:
        return self._add(
            kind=INNER,
            conv_id=low,
            depth=depth,
            n_convs=n,
            n_children=children,
            n_leaves=leaves,
            saved_tokens=saved,
            ends_sha256=hashlib.sha256(_joined(ends)).hexdigest(),
        )

    def border(self, node, parent, branch, words, low, depth, n, children, leaves, saved) -> None:
        self._add(
            kind=BORDER,
            node=node,
            parent=parent,
            branch=branch,
            words=words,
            conv_id=low,
            depth=depth,
            n_convs=n,
            n_children=children,
            n_leaves=leaves,
            saved_tokens=saved,
        )

    def ends(self, node: bytes, ids: list[int]) -> None:
        for i in range(0, len(ids), ENDS_PER_ROW):
            some = ids[i : i + ENDS_PER_ROW]
            self._add(kind=ENDS, node=node, conv_id=some[0], ends=np.array(some, "<i8").tobytes())

    def waiting(self, rows: list[int], low: int | None = None, digest: bytes | None = None) -> None:
        """Give records their parent, once it is known."""
        for row in rows:
            self.columns["parent_conv_id"][row] = low
            self.columns["parent"][row] = digest

    def batches(self, limit: int = 10_000) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(PART)
        for i in range(0, self.rows, limit):
            arrays = [pa.array(self.columns[f.name][i : i + limit], f.type) for f in kinds]
            yield pa.RecordBatch.from_arrays(arrays, schema=kinds)
