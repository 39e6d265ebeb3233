"""Streams of raw device messages.

Every message is read by exactly one task, which is what a shared subscription gives
the gateways. Spark has no MQTT source: a bridge lands messages as
parquet files, or forwards them to Kafka.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from sensorloom import constants as C


#: Input of one micro-batch where the caller sets no number of files.
BATCH_BYTES = 8 * 1024**3

#: Offsets that one partition of a topic may have: 2**47.
_OFFSET_BITS = 47


def bounded(reader: DataStreamReader, files_per_batch: int | None) -> DataStreamReader:
    """Bound what a file stream reads in one micro-batch, by files or else by bytes."""
    if files_per_batch:
        return reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("maxBytesPerTrigger", BATCH_BYTES)


def landed_messages(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw messages from a landing folder of parquet files (id, gateway_id, value)."""
    return bounded(spark.readStream.schema(C.RAW_MESSAGE), files_per_batch).parquet(folder)


def kafka_messages(
    spark: SparkSession, servers: str, topic: str = "iot/sensors", offsets_per_batch: int = 10_000_000
) -> DataFrame:
    """Raw messages of one topic from Kafka, where its connector is on the class path.

    A Kafka topic name cannot hold a slash, so it is replaced by a dot.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic.replace("/", "."))
        .option("maxOffsetsPerTrigger", offsets_per_batch)
    )
    return from_kafka(reader.load())


def from_kafka(records: DataFrame) -> DataFrame:
    """Raw messages from the records (partition, offset, value) of one topic.

    The id is made of partition and offset, as offsets repeat in every partition. The
    partition stands for the gateway, as each is read by one consumer. Bytes that aren't
    valid UTF-8 give a NULL, which the checks reject.
    """
    return records.select(
        (F.shiftleft(F.col("partition").cast("bigint"), _OFFSET_BITS) + F.col("offset")).alias("id"),
        F.concat(F.lit("gw_"), F.col("partition").cast("string")).alias("gateway_id"),
        F.try_validate_utf8(F.col("value").cast("string")).alias("value"),
    )
