"""The retraining job: count, train on all stored readings, publish the next version."""

from pyspark.sql import DataFrame

from sensorloom.ml import forest, registry
from sensorloom.operators import aggregates


def retrain(readings: DataFrame, root: str) -> tuple[registry.ModelVersion, DataFrame]:
    """Publish a newly trained forest; also give the records per gateway it was trained on."""
    model = forest.train(readings)
    return registry.publish(readings.sparkSession, model, root), aggregates.per_gateway(readings)


def main(arguments: list[str] | None = None) -> None:
    import argparse

    from sensorloom import constants as C
    from sensorloom.session import build_session
    from sensorloom.sources.tables import scan_table

    parser = argparse.ArgumentParser(description="Retrain the forest on stored readings.")
    parser.add_argument("readings", help="folder of the sensor_data table")
    parser.add_argument("models", help="folder of the model registry")
    given = parser.parse_args(arguments)
    spark = build_session("sensorloom-retraining")
    version, counts = retrain(scan_table(spark, given.readings, C.READING), given.models)
    counts.show()
    print(f"published version {version.version} at {version.path}")


if __name__ == "__main__":
    main()
