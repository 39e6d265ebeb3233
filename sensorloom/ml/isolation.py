"""The isolation forest (Liu, Ting and Zhou, 2008) as a Spark job.

Each tree sees a small random sample, so training needs few rows however large the
table: they are drawn in one pass over it, and each tree is built in a task of its own.
Scoring runs in Arrow batches with the trees as broadcast arrays.
"""

import math
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom import constants as C
from sensorloom.functions import expressions as E
from sensorloom.session import spread

# The functions below go to the workers by value, so the package need not be installed
# there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF = -1
NODES = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("path_length", T.DoubleType()),
    ]
)

SETTINGS = "sample_size int, cut_off double, features array<string>, trees int, slots int"


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of n values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


@dataclass(frozen=True)
class IsolationModel:
    """Trees as one row of arrays per tree, heap order: children of i are 2i+1, 2i+2."""

    feature: np.ndarray
    threshold: np.ndarray
    path_length: np.ndarray
    sample_size: int
    cut_off: float
    features: tuple[str, ...]

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The used nodes of all trees as a table."""
        tree, node = np.nonzero((self.feature != LEAF) | ~np.isnan(self.path_length))
        return spark.createDataFrame(
            pd.DataFrame(
                {
                    "tree": tree.astype("int32"),
                    "node": node.astype("int32"),
                    "feature": self.feature[tree, node].astype("int32"),
                    "threshold": self.threshold[tree, node],
                    "path_length": self.path_length[tree, node],
                }
            ),
            NODES,
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the nodes and the settings (one row beside at most 51,100 nodes)."""
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(
            [(self.sample_size, self.cut_off, list(self.features), *self.feature.shape)],
            SETTINGS,
        ).write.mode("overwrite").json(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "IsolationModel":
        s = spark.read.schema(SETTINGS).json(f"{path}/settings").first()
        return _pack(
            spark.read.schema(NODES).parquet(f"{path}/nodes"),
            s["trees"],
            s["slots"],
            s["sample_size"],
            s["cut_off"],
            tuple(s["features"]),
        )


def _pack(
    nodes: DataFrame, trees: int, slots: int, sample_size: int, cut_off: float, features: tuple[str, ...]
) -> IsolationModel:
    """Gather the node table, bounded by trees × slots rows, into arrays."""
    rows = nodes.toPandas()
    where = (rows["tree"].to_numpy(), rows["node"].to_numpy())
    feature = np.full((trees, slots), LEAF, dtype=np.int32)
    threshold = np.full((trees, slots), np.nan)
    path_length = np.full((trees, slots), np.nan)
    feature[where] = rows["feature"]
    threshold[where] = rows["threshold"]
    path_length[where] = rows["path_length"]
    return IsolationModel(feature, threshold, path_length, sample_size, cut_off, features)


def draw_samples(
    rows: DataFrame, total: int, trees: int, sample_size: int, seed: int, key: str, features: tuple[str, ...]
) -> tuple[DataFrame, int]:
    """A sample per tree, without repeats inside a tree: columns tree and the features.

    One hash of a row (of ``total``) decides how many trees take it, about a tenth more in all
    than are wanted, and for most rows of a large table that is none: nothing else is computed
    for them. A row that is taken goes to that many different trees, from one place on in steps
    that pass all trees. Of its rows a tree keeps the ``sample_size`` with the lowest hashes,
    which each task does for its own rows before any are shuffled. One pass, and the same rows
    for any partitioning and the same rule for tables of any size.
    """
    size = min(sample_size, total)
    expected = trees * min(1.0, (size + 6 * size**0.5) * 1.1 / max(total, 1))
    share = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11) / F.lit(float(2**53))
    every, more = int(expected), expected - int(expected)
    steps = [n for n in range(1, trees + 1) if math.gcd(n, trees) == 1]
    place = F.xxhash64(F.lit(seed + 1), key)
    step = F.get(F.array(*map(F.lit, steps)), F.pmod(F.shiftrightunsigned(place, 32), F.lit(len(steps))))
    taken = rows.select(key, *features, (F.lit(every) + (share < more).cast("int")).alias("_n")).filter("_n > 0")
    places = taken.withColumns({"_from": F.pmod(place, F.lit(trees)), "_step": step})
    picked = places.select(
        key,
        *features,
        F.explode(F.transform(F.sequence(F.lit(0), F.col("_n") - 1), _tree_at(trees))).alias("tree"),
    ).withColumn("_h", F.xxhash64(F.lit(seed), "tree", key))
    ranked = picked.withColumn("_rank", F.row_number().over(Window.partitionBy("tree").orderBy("_h", key)))
    return ranked.filter(F.col("_rank") <= size).select("tree", *features), size


def _tree_at(trees: int):
    return lambda i: F.pmod(F.col("_from") + i * F.col("_step"), F.lit(trees)).cast("int")


def _tree_builder(seed: int, features: tuple[str, ...], height: int):
    def build(sample: pd.DataFrame) -> pd.DataFrame:
        """Nodes of one tree, from at most ``sample_size`` rows."""
        tree = int(sample["tree"].iloc[0])
        values = sample[list(features)].sort_values(list(features)).to_numpy(dtype=float)
        random = np.random.default_rng([seed, tree])
        made = []
        todo = [(0, 0, values)]
        while todo:
            node, depth, part = todo.pop()
            low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(1), np.zeros(1))
            splittable = np.flatnonzero(high > low)
            if depth == height or len(part) <= 1 or not len(splittable):
                made.append((tree, node, LEAF, np.nan, depth + average_path(len(part))))
                continue
            feature = int(random.choice(splittable))
            threshold = float(random.uniform(low[feature], high[feature]))
            left = part[:, feature] <= threshold
            made.append((tree, node, feature, threshold, np.nan))
            todo.append((2 * node + 1, depth + 1, part[left]))
            todo.append((2 * node + 2, depth + 1, part[~left]))
        return pd.DataFrame(made, columns=NODES.fieldNames())

    return build


def train(
    readings: DataFrame,
    trees: int = 100,
    sample_size: int = 256,
    contamination: float = C.CONTAMINATION,
    seed: int = C.MODEL_SEED,
    key: str = "id",
    features: tuple[str, ...] = C.FEATURES,
) -> IsolationModel:
    """Build the trees and set the cut-off that flags the contamination share of the
    training rows: a quantile of the scores of all of them.
    """
    rows = spread(readings.select(key, *features))
    total = rows.count()
    samples, size = draw_samples(rows, total, trees, sample_size, seed, key, features)
    if size == 0:
        raise ValueError("no readings to train on")
    height = int(np.ceil(np.log2(max(size, 2))))
    nodes = samples.groupBy("tree").applyInPandas(_tree_builder(seed, features, height), NODES)
    model = _pack(nodes, trees, 2 ** (height + 1) - 1, size, np.nan, features)
    scores = rows.select(_score_column(model, readings.sparkSession).alias("score"))
    cut_off = scores.agg(F.percentile_approx("score", 1.0 - contamination, 10_000)).first()[0]
    return IsolationModel(
        model.feature, model.threshold, model.path_length, size, float(cut_off), features
    )


def anomaly_scores(
    values: np.ndarray, feature: np.ndarray, threshold: np.ndarray, path_length: np.ndarray, sample_size: int
) -> np.ndarray:
    """Score of each row in (0, 1) under the trees; the shorter its paths, the higher."""
    if np.isnan(values).any():
        raise ValueError("features must not be null")
    trees, slots = feature.shape
    levels = slots.bit_length() - 1
    rows = np.arange(len(values))
    columns = np.ascontiguousarray(values.T).ravel()
    # Where a step from each node leads, left and right; a leaf leads to itself.
    nodes = np.arange(slots)
    inner = feature != LEAF
    steps = np.stack([np.where(inner, 2 * nodes + 1, nodes), np.where(inner, 2 * nodes + 2, nodes)], axis=2)
    offset = np.where(inner, feature, 0) * len(values)
    depth = np.zeros(len(values))
    for tree in range(trees):
        step, start, split = steps[tree].ravel(), offset[tree], threshold[tree]
        node = np.zeros(len(values), dtype=np.intp)
        for _ in range(levels):
            right = columns[start[node] + rows] > split[node]
            node = step[2 * node + right]
        depth += path_length[tree][node]
    mean_depth = depth / trees
    return np.exp2(-mean_depth / max(average_path(sample_size), np.finfo(float).tiny))


# Trees that are with the executors already, by model: a stream scores with the same model
# in every micro-batch.
_sent: dict[int, tuple] = {}


def _broadcast(model: IsolationModel, spark: SparkSession):
    found = _sent.get(id(model))
    if found is None or found[0] is not model or found[1] != spark.sparkContext.applicationId:
        for _, application, trees in _sent.values():
            if application == spark.sparkContext.applicationId:
                trees.unpersist()
        _sent.clear()
        trees = spark.sparkContext.broadcast((model.feature, model.threshold, model.path_length))
        found = _sent[id(model)] = (model, spark.sparkContext.applicationId, trees)
    return found[2]


def _score_column(model: IsolationModel, spark: SparkSession) -> Column:
    trees = _broadcast(model, spark)
    sample_size = model.sample_size

    @F.pandas_udf(T.DoubleType())
    def scores(values: pd.DataFrame) -> pd.Series:
        return pd.Series(anomaly_scores(values.to_numpy(dtype=float), *trees.value, sample_size))

    return scores(F.struct(*[F.col(name).cast("double").alias(name) for name in model.features]))


def score(model: IsolationModel, readings: DataFrame) -> DataFrame:
    """Readings with score, verdict (-1 for an anomaly, else 1) and class."""
    kept = [c for c in readings.columns if c not in ("classification", "score", "verdict")]
    return (
        readings.withColumn("score", _score_column(model, readings.sparkSession))
        .withColumn(
            "verdict",
            F.when(F.col("score") > model.cut_off, C.ISOLATION_ANOMALY).otherwise(C.ISOLATION_NORMAL),
        )
        .select(*kept, "score", "verdict", E.class_from_isolation().alias("classification"))
    )
