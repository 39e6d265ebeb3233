"""The random forest: training on stored readings and scoring with it."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom import constants as C
from sensorloom.functions import expressions as E
from sensorloom.session import write_table

CELLS = 512

#: Buckets that values are counted in before they are put into cells, for each unit of log(1 + x).
BUCKETS = 2048
PARTS = 8

# The trees' resampling is seeded by partition, so the trainer's rows always lie in the
# same partitions, whatever the cores and the files of the table.
TRAINING_PARTITIONS = 16


def train(
    readings: DataFrame, trees: int = C.FOREST_TREES, depth: int = C.FOREST_DEPTH, seed: int = C.MODEL_SEED
) -> PipelineModel:
    """Fit the two-stage pipeline on all readings; a null feature raises.

    Only the two features, the label and the id are read from the table. The trainer
    holds a count per tree for every row it is given, so it gets weighted rows: readings
    counted in a fine grid by quantiles. That is done for tables of any size.
    """
    assembler = VectorAssembler(inputCols=list(C.FEATURES), outputCol="features", handleInvalid="error")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[assembler, forest]).fit(condense(readings))


def _bucket(m: str) -> Column:
    """Number of a value's bucket: ascending with the value, about 0.05 % wide, or 0.0005 below
    one. NULL for what is no finite number."""
    size = F.abs(F.col(m))
    bucket = F.floor(F.log1p(size) * BUCKETS) * F.when(F.col(m) < 0, -1).otherwise(1)
    return F.when(F.col(m).isNotNull() & ~F.isnan(m) & (size < float("inf")), bucket.cast("int"))


def quantile_cells(readings: DataFrame, cells: int = CELLS) -> DataFrame:
    """The cell of each bucket of each feature (feature, bucket, cell), so that all cells hold
    about the same number of readings, however far off single values lie.

    Buckets are counted exactly, inside each task first, so the cells are the same for any
    partitioning. There are as many rows as buckets with readings: thousands, and less than
    three million for any values at all. A null feature raises.
    """
    each = F.array(*[F.struct(F.lit(m).alias("feature"), _bucket(m).alias("bucket")) for m in C.FEATURES])
    counted = readings.select(F.explode(each).alias("b")).groupBy("b.feature", "b.bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum("n").over(before), F.lit(0)) / F.sum("n").over(Window.partitionBy("feature"))
    cell = F.floor(rank * cells).cast("int")
    found = write_table(counted.select("feature", "bucket", cell.alias("cell")), "cells")
    if not found.filter("bucket is null").isEmpty():
        raise ValueError("null feature in the training table")
    return found


def condense(readings: DataFrame, cells: int = CELLS, parts: int = PARTS) -> DataFrame:
    """All readings as weighted rows: mean features, label and number of readings of each
    cell of a grid by quantiles. The trainer itself tells at most 32 bins per feature apart.

    A cell is kept in several parts, by the id, so that the trees' resampling does not
    take or leave a whole cell at once. One pass finds the cells, one counts them; both
    combine inside each task, so a cell with most of the readings costs no more. Means are
    rounded, since their last digits depend on the order of tasks; where their sum could pass
    the largest number the smallest value stands for them.
    """
    found, placed = quantile_cells(readings, cells), readings
    for m in C.FEATURES:
        of_m = found.filter(F.col("feature") == m)
        of_m = of_m.select(F.col("bucket").alias(f"bucket_{m}"), F.col("cell").alias(f"cell_{m}"))
        # Spark broadcasts the cells if their files are small, as they are for any usual table.
        placed = placed.withColumn(f"bucket_{m}", _bucket(m)).join(of_m, f"bucket_{m}")
    means = [
        F.when(F.max(F.abs(m)) < 1e150, F.round(F.avg(m), 9)).otherwise(F.min(m)).alias(m) for m in C.FEATURES
    ]
    grouped = placed.groupBy(
        *[f"cell_{m}" for m in C.FEATURES],
        E.is_anomaly().alias("anomalous"),
        F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"),
    ).agg(*means, F.count("*").cast("double").alias("weight"))
    classified = grouped.withColumn("classification", E.class_name(F.col("anomalous")))
    # Read several times by the trainer; there are at most cells x cells x parts x 2 rows.
    rows = write_table(classified.select(*C.FEATURES, "classification", "weight"), "condensed")
    order = [*C.FEATURES, "classification", "weight"]
    return (
        rows.repartition(TRAINING_PARTITIONS, *C.FEATURES)
        .sortWithinPartitions(*order)
        .select(*C.FEATURES, E.label(), "weight")
    )


def score(model: PipelineModel, readings: DataFrame) -> DataFrame:
    """Readings with the class the forest gives them; tables and streams alike.

    All columns of a reading stay with its prediction, so nothing is joined back.
    """
    kept = [c for c in readings.columns if c != "classification"]
    return model.transform(readings).select(*kept, E.class_from_forest().alias("classification"))


def confusion(model: PipelineModel, readings: DataFrame) -> DataFrame:
    """Counts of readings by their own class and the one the forest gives them."""
    with_actual = readings.withColumn("actual", F.col("classification"))
    return (
        score(model, with_actual)
        .groupBy("actual", F.col("classification").alias("predicted"))
        .agg(F.count("*").alias("readings"))
    )


def agreement(model: PipelineModel, readings: DataFrame) -> DataFrame:
    """One row: readings, anomalies by their own class, and the share of readings that the
    forest puts into it."""
    actual, predicted, n = F.col("actual"), F.col("predicted"), F.sum("readings")
    return confusion(model, readings).agg(
        F.coalesce(n, F.lit(0)).alias("readings"),
        F.coalesce(F.sum(F.when(actual == C.ANOMALY, F.col("readings"))), F.lit(0)).alias("anomalies"),
        (F.sum(F.when(actual == predicted, F.col("readings"))) / n).alias("agreement"),
    )
