"""Choice of the model: the published forest, else the isolation forest."""

import logging

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.ml import forest, isolation, registry

log = logging.getLogger(__name__)

FOREST = "random_forest"
EDGE = "isolation_forest"

# What reading a damaged or missing model folder can raise.
LOAD_ERRORS = (PySparkException, Py4JError, ValueError, KeyError)


def newest_forest(spark: SparkSession, root: str) -> PipelineModel | None:
    """The newest published forest that loads, or None if there is none."""
    for found in registry.versions(spark, root):
        try:
            return registry.load(found)
        except LOAD_ERRORS:
            log.warning("model version %s did not load", found.version, exc_info=True)
    return None


def score_with_fallback(readings: DataFrame, root: str, edge: isolation.IsolationModel) -> DataFrame:
    """Score with the newest forest where it loads, else with the edge model; the column
    ``model_type`` tells which it was."""
    model = newest_forest(readings.sparkSession, root)
    if model is not None:
        return forest.score(model, readings).withColumn("model_type", F.lit(FOREST))
    return isolation.score(edge, readings).drop("score", "verdict").withColumn("model_type", F.lit(EDGE))
