"""Hard negatives and the conversation trie against SQL and brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from compare import connect, differences
from conftest import SMALL
from sensorloom.llm import conversation_trie, hard_negatives, oracles, queries
from sensorloom.llm.radix_tree import Direct, Indexed, RadixTree, Sorted
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", ("op12_hard_negatives", "op13_prefix_trie"))
def test_query_equals_sql(spark, name):
    assert differences(queries.queries()[name](spark, SMALL), connect(SMALL), oracles.oracle_sql()[name]) is None


def mined(rows, positives=5, negatives=10):
    """By definition; rows are (id, label, vector)."""
    found = []
    for a_id, a_label, a in rows:
        if a_id % 100:
            continue
        others = sorted((-sum(x * y for x, y in zip(a, b)), i, label) for i, label, b in rows if i != a_id)
        for p, p_id, _ in [o for o in others if o[2] == a_label][:positives]:
            fit = [(s, i) for s, i, label in others if label != a_label and -30 * p <= -100 * s <= -90 * p]
            found += [(a_id, p_id, rank, i, -p, -s) for rank, (s, i) in enumerate(fit[:negatives], 1)]
    return sorted(found)


@pytest.mark.parametrize("dims, top", ((8, 3), (13, 200), (64, 100_000), (1, 2_000_000_000)))
def test_negatives_by_definition(spark, monkeypatch, dims, top):
    for name, value in (("BLOCK", 32), ("TILE_ANCHORS", 2), ("TILE_CANDIDATES", 100), ("TABLES", 3), ("SCORED", 20)):
        monkeypatch.setattr(hard_negatives, name, value)
    draw = np.random.default_rng(dims)
    rows = [(i * 20, int(draw.integers(0, 3)), draw.integers(-top, top, dims, endpoint=True).tolist()) for i in range(60)]
    rows += [(i, 1, [top] * dims) for i in range(1, 40)]  # a very common vector: many ties
    rows += [rows[3], rows[-1], (2000, 1, [1])]  # repeated rows, and a shorter vector
    missing = [(None, 1, [1]), (7001, None, [1]), (7002, 1, None), (7003, 1, [None])]
    table = spark.createDataFrame(rows + missing, "vec_id long, label int, vector array<bigint>")
    table = table.selectExpr("*", "0 as id", "1 as rank", "2 as block").repartition(7)
    found = hard_negatives.mine(table, F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in found.collect()) == mined(rows)


def test_negatives_edges(spark):
    schema = "vec_id long, label int, vector array<bigint>"
    none = hard_negatives.mine(spark.createDataFrame([], schema), F.col("vec_id") % 100 == 0)
    assert none.count() == 0 and none.columns[:3] == ["anchor_id", "positive_id", "rank"]
    alone = spark.createDataFrame([(0, 1, [5]), (3, 2, [5]), (5, 2, [])], schema)
    assert hard_negatives.mine(alone, F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(ValueError):
        huge = spark.createDataFrame([(0, 1, [2**62])], schema)
        hard_negatives.mine(huge, F.col("vec_id") % 100 == 0)
    odd = spark.createDataFrame([([1.0, math.nan],), ([math.inf],), ([None],), (None,), ([-0.001, 0.5],)], "v array<float>")
    assert [r[0] for r in odd.select(hard_negatives.quantised(F.col("v"))).collect()] == [None] * 4 + [[-1, 128]]


def test_layouts_grow():
    tree, kinds = RadixTree(), []
    for i in range(256):
        tree.insert(bytes([i * 37 % 256]) * 2, i)
        kinds.append(type(tree.root.kids) if not isinstance(tree.root.kids, Sorted) else tree.root.kids.capacity)
    changes = [0, *(i for i in range(1, 256) if kinds[i] != kinds[i - 1])]
    assert [(i, kinds[i]) for i in changes] == [(0, 4), (4, 16), (16, Indexed), (48, Direct)]
    assert [node.path for node, parent, _ in tree.preorder() if parent == 0][::-1] == [bytes([i]) * 2 for i in range(256)]


def test_keys_are_kept():
    draw, tree = random.Random(2), RadixTree()
    keys = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 9))) for _ in range(500)]
    for row, key in enumerate(keys):
        tree.insert(key, row)
    whole, found = [], {}
    for node, parent, above in tree.preorder():
        whole.append((whole[parent] if parent >= 0 else b"") + node.path)
        assert len(whole[-1]) == above + len(node.path) and keys[node.row].startswith(whole[-1])
        assert node.ends or parent < 0 or len(list(node.kids)) > 1  # paths are compressed
        found |= dict.fromkeys(node.ends, whole[-1])
    assert found == dict(enumerate(keys))


def trie(sequences):
    """By definition: {conversation: list of (role, text)}."""
    members = defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    found = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        kids = {d: sum(p[:-1] == d and len(p) > 0 for p in members) for d in below}
        saved = sum((len(members[p]) - 1) * len(p[-1][1].split()) for p in below if p)
        ends = sorted(c for c in convs if len(sequences[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        leaves = sum(n == 0 for n in kids.values())
        found.append((min(convs), len(prefix), parent, len(convs), kids[prefix], leaves, saved, digest))
    return sorted(found, key=repr)


def rebuilt(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append((-(10**9) if turn is None else turn, role or "", text or ""))
    turns = {c: [t[1:] for t in sorted(s)] for c, s in said.items()}
    cut = {c: zlib.crc32(str(c).encode()) % 4 for c in turns}
    return {c: turns.get(c - c % 20, [])[: cut[c]] + turns[c][cut[c] :] for c in turns}


@pytest.mark.parametrize("slices", (1, 2, 7, 40))
def test_trie_by_definition(spark, monkeypatch, slices):
    monkeypatch.setattr(conversation_trie, "ENDS_PER_ROW", 3)
    draw = random.Random(slices)
    rows = [(c, t, draw.choice("ua"), draw.choice(["x y", "x", ""])) for c in range(90) for t in range(draw.randint(1, 5))]
    rows += [(c, t, "u", "the same") for c in range(100, 160) for t in range(4)]  # a very common conversation
    rows += [(200, t, "u", "the same" if t < 9 else f"w{t}") for t in range(60)]  # a long one
    rows += [(201, None, None, None), (202, 1, "u", None), (None, 1, "u", "x"), (400, 0, "a", "1:b"), (401, 0, "a1:", "b")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.selectExpr("*", "'z' as key", "0 as words", "1 as depth").repartition(5)
    sequences = conversation_trie.with_common_start(conversation_trie.sequences(table))
    found = conversation_trie.nodes(sequences, slices=slices)
    assert found.columns == conversation_trie.RESULT
    assert sorted((tuple(r) for r in found.collect()), key=repr) == trie(rebuilt(rows))


def test_empty_trie(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_trie.nodes(conversation_trie.sequences(empty)).count() == 0


def test_turns_that_tie_and_repeat(spark):
    rows = [(1, 5, "u", "b"), (1, 5, "u", "a"), (1, None, "u", "c"), (1, 5, "u", "a")]
    schema = "conv_id long, turn long, role string, text string"
    a = conversation_trie.sequences(spark.createDataFrame(rows, schema)).first()
    b = conversation_trie.sequences(spark.createDataFrame(rows[::-1], schema)).first()
    assert a == b and len(a.key) == 4 * conversation_trie.ID and a.words == [1, 1, 1, 1]
