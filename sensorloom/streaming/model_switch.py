"""Scoring a stream with the newest published forest.

A model inside a stream's plan would stay the one it started with. Here every
micro-batch, but not more often than every few seconds, looks up the newest version and
loads it only when it is higher than the one in use; a version that fails to load is
tried again with the next look.
"""

import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sensorloom import constants as C
from sensorloom.ml import forest, isolation, registry
from sensorloom.ml.scoring import EDGE, FOREST, LOAD_ERRORS
from sensorloom.sources import sinks

log = logging.getLogger(__name__)

SCORED = T.StructType(
    C.READING.fields
    + [T.StructField("model_type", T.StringType()), T.StructField("model_version", T.LongType())]
)


class NewestModel:
    """The model in use, held by the driver; starts with the edge model as version 0.

    Called with the readings of a micro-batch it scores them, looking for a newer model
    first if the last look is ``check_seconds`` ago.
    """

    def __init__(self, root: str, edge: isolation.IsolationModel, check_seconds: float = C.MODEL_CHECK_SECONDS):
        self.root = root
        self.edge = edge
        self.check_seconds = check_seconds
        self.next_check = 0.0
        self.version = 0
        self.forest = None

    def refresh(self, spark: SparkSession) -> None:
        if time.monotonic() < self.next_check:
            return
        self.next_check = time.monotonic() + self.check_seconds
        found = registry.latest(spark, self.root)
        if found is None or found.version <= self.version:
            return
        try:
            self.forest = registry.load(found)
            self.version = found.version
        except LOAD_ERRORS:
            log.warning("model version %s did not load", found.version, exc_info=True)

    def __call__(self, readings: DataFrame) -> DataFrame:
        self.refresh(readings.sparkSession)
        if self.forest is not None:
            scored, kind = forest.score(self.forest, readings), FOREST
        else:
            scored, kind = isolation.score(self.edge, readings).drop("score", "verdict"), EDGE
        return scored.withColumns(
            {"model_type": F.lit(kind), "model_version": F.lit(self.version).cast("bigint")}
        )


def score_with_newest(readings: DataFrame, out: str, newest: NewestModel) -> DataStreamWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.overwrite_batch(newest(batch).select(*SCORED.fieldNames()), out, batch_id)

    return readings.writeStream.foreachBatch(write)


def read_scored(spark: SparkSession, out: str) -> DataFrame:
    return sinks.read_batches(spark, out, SCORED)
