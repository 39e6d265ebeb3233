"""Published models: a folder for each and a table of the published versions."""

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.sources.sinks import create_file, path_exists

REGISTRY = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)


@dataclass(frozen=True)
class ModelVersion:
    version: int
    path: str


def published(spark: SparkSession, root: str) -> DataFrame:
    """All published versions; empty if there is none yet."""
    path = f"{root}/published"
    if not path_exists(spark, path):
        return spark.createDataFrame([], REGISTRY)
    return spark.read.schema(REGISTRY).json(path)


def latest_model(registry: DataFrame) -> DataFrame:
    """One row: whether a model exists, its version (1 if unnumbered) and its path."""
    newest = registry.agg(
        (F.count("*") > 0).alias("exists"),
        F.max(F.struct(F.coalesce("version", F.lit(1)).alias("version"), "path")).alias("m"),
    )
    return newest.select("exists", "m.version", "m.path")


def latest(spark: SparkSession, root: str) -> ModelVersion | None:
    row = latest_model(published(spark, root)).first()
    return ModelVersion(row["version"], row["path"]) if row["exists"] else None


def publish(spark: SparkSession, model: PipelineModel, root: str) -> ModelVersion:
    """Save the model in a folder of its own and announce it as the next version.

    The entry of a version is one file with that version's name, made only if there is none
    yet: of two trainers that finish at once one gets the number, and the other the next.
    Readers see either the version before or the complete new one.
    """
    path = f"{root}/models/{uuid.uuid4().hex}"
    model.write().save(path)
    if not path_exists(spark, f"{path}/metadata"):
        raise RuntimeError(f"model was not saved to {path}")
    now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    while True:
        before = latest(spark, root)
        version = before.version + 1 if before else 1
        entry = json.dumps({"version": version, "path": path, "created_at": now})
        if create_file(spark, f"{root}/published/version-{version}.json", entry + "\n"):
            return ModelVersion(version, path)


def versions(spark: SparkSession, root: str) -> list[ModelVersion]:
    """All published versions, newest first; there are as many rows as trainings."""
    rows = published(spark, root).orderBy(F.desc("version")).select("version", "path").collect()
    return [ModelVersion(r["version"], r["path"]) for r in rows]


def load(found: ModelVersion) -> PipelineModel:
    return PipelineModel.load(found.path)
