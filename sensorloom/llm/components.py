"""Connected components: union-find within a task, contraction of the graph across tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.session import write_table


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 and links a-b: the smallest node of each node's component."""
    label = np.arange(n)
    while True:
        left, right = label[a], label[b]
        low, high = np.minimum(left, right), np.maximum(left, right)
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further


def connected(edges: DataFrame) -> DataFrame:
    """Node and component (smallest node reached) of all nodes in ``edges`` (a, b).

    Each round every node takes its smallest neighbour's smallest neighbour as its parent,
    and the links are carried over to the parents, until none is left between two parents.
    What is shuffled shrinks from round to round, and with it the number of files that a round
    writes; nothing is collected. Loops, repeated
    links and links in both directions are allowed; an empty table gives no rows.
    """
    left, right = F.least("a", "b"), F.greatest("a", "b")
    links = edges.filter(F.col("a") != F.col("b")).select(left.alias("a"), right.alias("b")).distinct()
    links = write_table(links, "links")
    steps = []
    while n := links.count():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("least"))
        first = write_table(nearest.select(F.col("a").alias("node"), F.least("a", "least").alias("parent")), "parents", 2 * n)
        above = first.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        jumped = first.join(above, "parent").select("node", F.col("top").alias("parent"))
        parents = write_table(jumped, "parents", 2 * n)
        steps.append(parents)
        pa = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        pb = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = links.join(pa, "a").join(pb, "b").filter("pa <> pb")
        moved = moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        links = write_table(moved, "links", n)
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    nodes = steps[0].count() if len(steps) > 1 else 0
    found = steps[0].select("node", F.col("parent").alias("component"))
    for parents in steps[1:]:
        above = parents.select(F.col("node").alias("component"), F.col("parent").alias("top"))
        found = found.join(above, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return write_table(found, "components", nodes) if len(steps) > 1 else found
