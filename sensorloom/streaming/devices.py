"""The stored device table, changed by batches of requests.

Every micro-batch of requests writes what it adds: registrations by device, and how often a
device's flag was toggled. What is read is their combination: of all registrations of a device
the one with the smallest request number, whichever batch it came in, and its flag flipped by
the number of toggles. Neither depends on the order of arrival, and a device is one row
however many batches asked for it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sensorloom.functions.expressions import device_name
from sensorloom.operators.devices import new_key
from sensorloom.sources import sinks
from sensorloom.streaming import snapshots

#: A request: ``kind`` is register or toggle.
REQUEST = T.StructType(
    [
        T.StructField("request_seq", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("device_number", T.LongType()),
        T.StructField("requested_at", T.TimestampNTZType()),
    ]
)

#: What a batch adds to a device. ``registered`` is NULL where it was only toggled.
CHANGE = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField(
            "registered",
            T.StructType(
                [
                    T.StructField("request_seq", T.LongType()),
                    T.StructField("registered_at", T.TimestampNTZType()),
                    T.StructField("device_number", T.LongType()),
                ]
            ),
        ),
        T.StructField("toggles", T.LongType()),
    ]
)


def changes(requests: DataFrame) -> DataFrame:
    """One row for each device that valid requests name. Numbers below zero, and requests of
    another kind, change nothing."""
    asked = requests.filter("device_number >= 0 and kind in ('register', 'toggle')")
    first = F.struct("request_seq", F.col("requested_at").alias("registered_at"), "device_number")
    return asked.groupBy(device_name("device_number").alias("device_id")).agg(
        F.min(F.when(F.col("kind") == "register", first)).alias("registered"),
        F.count_if(F.col("kind") == "toggle").alias("toggles"),
    )


def combined(added: DataFrame) -> DataFrame:
    """Changes of one device from several batches as one."""
    return added.groupBy("device_id").agg(F.min("registered").alias("registered"), F.sum("toggles").alias("toggles"))


def apply_requests(requests: DataFrame, out: str) -> DataStreamWriter:
    """Apply a stream of requests to the stored device table."""
    return requests.writeStream.foreachBatch(
        lambda batch, batch_id: sinks.overwrite_batch(changes(batch), f"{out}/changes", batch_id)
    )


def stored_devices(spark: SparkSession, out: str, salt: str) -> DataFrame:
    """The device table: id, device_id, api_key, active and registered_at, one row per device. A
    device starts active; devices that were only toggled are not there."""
    found = combined(snapshots.rows(spark, f"{out}/changes", CHANGE)).filter("registered is not null")
    return found.select(
        F.col("registered.device_number").alias("id"),
        "device_id",
        new_key(salt).alias("api_key"),
        (F.col("toggles") % 2 == 0).alias("active"),
        F.col("registered.registered_at").alias("registered_at"),
    )


def compact_devices(spark: SparkSession, out: str, clear: bool = True) -> None:
    """Snapshot of the changes so far, one row for each device."""
    snapshots.take(spark, f"{out}/changes", CHANGE, combined, clear=clear)
