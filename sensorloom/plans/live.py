"""The live job: messages in; scored readings, anomalies, rejects, outbox and state out."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sensorloom import constants as C
from sensorloom.ml.isolation import IsolationModel
from sensorloom.sources.messages import landed_messages
from sensorloom.streaming import routing
from sensorloom.streaming.model_switch import NewestModel
from sensorloom.streaming.runs import start


def run_live(
    messages: DataFrame,
    out: str,
    models: str,
    edge: IsolationModel,
    devices: routing.Devices | None = None,
    interval: str | None = C.SCORING_INTERVAL,
) -> StreamingQuery:
    """Start the stream. Started again with the same ``out`` it goes on where it was.

    The gateways' state is published every few seconds. ``sensorloom.plans.upkeep`` is a job of
    its own, to be run beside it: it delivers the outbox and compacts the stored tables.
    """
    writer = routing.route(messages, out, NewestModel(models, edge), devices, routing.StatePublisher(out))
    return start(writer, f"{out}/checkpoint", interval)


def main(arguments: list[str] | None = None) -> None:
    import argparse

    from sensorloom.session import build_session

    parser = argparse.ArgumentParser(description="Score and store the message stream.")
    parser.add_argument("landing", help="folder the raw messages land in")
    parser.add_argument("out", help="folder of the stored tables and the checkpoint")
    parser.add_argument("models", help="folder of the model registry")
    parser.add_argument("edge", help="folder of the saved edge model")
    parser.add_argument("--files-per-batch", type=int, default=1000)
    given = parser.parse_args(arguments)
    spark: SparkSession = build_session("sensorloom-live")
    messages = landed_messages(spark, given.landing, given.files_per_batch)
    run_live(messages, given.out, given.models, IsolationModel.load(spark, given.edge)).awaitTermination()


if __name__ == "__main__":
    main()
