"""Ingest and routing of the message stream.

A message is decoded and checked, scored, and stored; anomalies also go to the outbox and
to the anomaly table, bad messages to the rejects. Each micro-batch writes folders of its
own, so a batch repeated after a failure replaces what it had written.
"""

import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sensorloom import constants as C
from sensorloom.operators import outbox, state
from sensorloom.operators import readings as R
from sensorloom.operators.joins import join_sized
from sensorloom.operators.validation import decode_messages, valid_messages, with_gateway
from sensorloom.session import cached, spread
from sensorloom.sources import sinks
from sensorloom.streaming import snapshots

Scorer = Callable[[DataFrame], DataFrame]

REJECT = T.StructType(C.RAW_MESSAGE.fields + [T.StructField("reason", T.StringType())])

#: What reaches the store by delivery: the outbox's record, with its time.
DELIVERED = T.StructType(
    [T.StructField(f.name, T.TimestampNTZType()) if f.name == "timestamp" else f for f in C.OUTBOX_RECORD.fields]
)

#: Readings of one file, about, where a micro-batch holds very many of one day.
FILE_ROWS = 1_000_000


def ingest(messages: DataFrame, out: str) -> DataStreamWriter:
    """Store the valid messages of the stream, each exactly once."""
    return valid_messages(messages).writeStream.format("parquet").option("path", out).outputMode("append")


def store_scored(scored: DataFrame, out: str) -> DataStreamWriter:
    """Store a stream of scored readings, each exactly once."""
    return scored.writeStream.format("parquet").option("path", out).outputMode("append")


Devices = Callable[[SparkSession], DataFrame]


def route(
    messages: DataFrame,
    out: str,
    score: Scorer,
    devices: Devices | None = None,
    after: Callable[[SparkSession, int], None] | None = None,
) -> DataStreamWriter:
    """Score the valid messages and route them to readings, outbox and anomalies; all others go
    to the rejects with their reason. The gateways' counters are kept as what each micro-batch
    adds to them.

    Every message is stored or rejected: bad ones, those without a gateway, and those that the
    model gives no class. A micro-batch is decoded and scored once. ``devices``, if given, reads
    the device table anew for every micro-batch, and messages of devices that are not active
    are rejected. ``after`` is called with the number of each finished micro-batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        decoded = with_gateway(decode_messages(spread(batch))).drop("timestamp_text")
        if devices is not None:
            active = devices(spark).filter("active").select("device_id", F.lit(True).alias("_active")).distinct()
            decoded = join_sized(decoded, active, "device_id", "left")
            unknown = F.when(F.col("_active").isNull(), "inactive_device")
            decoded = decoded.withColumn("reason", F.coalesce("reason", unknown)).drop("_active")
        decoded = cached(decoded)
        try:
            arrived = decoded.count()
            scored = cached(score(decoded.filter("reason is null").drop("reason")))
            try:
                kept = scored.filter("classification is not null").select(*C.READING.fieldNames())
                parts = -(-arrived // FILE_ROWS) or 1
                sinks.overwrite_batch_by_day(kept, f"{out}/sensor_data", batch_id, parts)
                unclassed = scored.filter("classification is null").withColumn("reason", F.lit("missing_classification"))
                bad = decoded.filter("reason is not null")
                rejects = bad.select(*REJECT.fieldNames()).unionByName(unclassed.select(*REJECT.fieldNames()))
                sinks.overwrite_batch(rejects, f"{out}/rejects", batch_id)
            finally:
                scored.unpersist()
        finally:
            decoded.unpersist()
        stored = sinks.read_batch(spark, f"{out}/sensor_data", C.READING, batch_id)
        flagged = R.anomalies(stored)
        sinks.overwrite_batch_lines(outbox.to_lines(flagged), f"{out}/outbox", batch_id)
        sinks.overwrite_batch_by_day(flagged, f"{out}/anomalies", batch_id, parts)
        sinks.overwrite_batch(state.current_counters(stored), f"{out}/counters", batch_id)
        if after is not None:
            after(spark, batch_id)

    return messages.writeStream.foreachBatch(write)


def stored_readings(spark: SparkSession, out: str, by_day: bool = False) -> DataFrame:
    return snapshots.rows(spark, f"{out}/sensor_data", C.READING, by_day=by_day)


def stored_days(spark: SparkSession, out: str) -> list[date]:
    """The days of the stored readings, the newest first, from the folders' names."""
    return snapshots.days(spark, f"{out}/sensor_data")


def stored_anomalies(spark: SparkSession, out: str, by_day: bool = False) -> DataFrame:
    return snapshots.rows(spark, f"{out}/anomalies", C.READING, by_day=by_day)


def stored_rejects(spark: SparkSession, out: str) -> DataFrame:
    return snapshots.rows(spark, f"{out}/rejects", REJECT)


def compact_rows(spark: SparkSession, out: str, clear: bool = True) -> None:
    """The job that rewrites the many small files of a live run's readings, anomalies and rejects
    into few, by day. Readers see the same rows before, during and after."""
    for name in ("sensor_data", "anomalies"):
        snapshots.compact(spark, f"{out}/{name}", C.READING, by_day=True, clear=clear)
    snapshots.compact(spark, f"{out}/rejects", REJECT, clear=clear)


def stored_outbox(spark: SparkSession, out: str) -> DataFrame:
    return snapshots.rows(spark, f"{out}/outbox", sinks.LINES, lines=True)


def clear_outbox(spark: SparkSession, out: str, delivered: DataFrame, clear: bool = True) -> None:
    """Take lines that were acknowledged from outside out of the live outbox. Safe to run again:
    lines that are gone stay gone, and a run that failed half-way has changed nothing."""
    snapshots.take(
        spark, f"{out}/outbox", sinks.LINES, lambda lines: outbox.pending(lines, delivered), lines=True, clear=clear
    )


def deliver(spark: SparkSession, out: str, clear: bool = True) -> int | None:
    """Deliver the live outbox into the store: the lines of all finished batches that were not
    delivered yet are written as records, then one commit records these batches as delivered,
    then what nothing needs any more is removed from the outbox.

    The commit names the records, so that both happen at once: a job that stops before it has
    delivered nothing, however often it is run, and one that stops after it only has left to
    clear. Every line is delivered once, copies of it as often as they were written.
    """
    made = f"{out}/delivered"
    return snapshots.compact(
        spark, f"{out}/outbox", DELIVERED, lines=True, made=made, change=outbox.records, clear=clear
    )


def delivered(spark: SparkSession, out: str) -> DataFrame:
    """The records that reached the store."""
    return snapshots.table_rows(spark, f"{out}/delivered", DELIVERED)


def undelivered(spark: SparkSession, out: str) -> DataFrame:
    """The lines of the outbox that ``deliver`` has not delivered yet."""
    upto = snapshots.newest(spark, f"{out}/delivered").upto
    numbers = [n for n in sinks.finished(spark, f"{out}/outbox") if n > upto]
    return snapshots.batches(spark, f"{out}/outbox", sinks.LINES, numbers, lines=True)


def resend(spark: SparkSession, out: str, delivered: DataFrame) -> DataFrame:
    """The records of the live outbox that have not been delivered, each with its copies."""
    return outbox.replay(stored_outbox(spark, out), delivered)


def stored_counters(spark: SparkSession, out: str) -> DataFrame:
    """The gateway state: one row per gateway of the newest snapshot and what the
    micro-batches after it added."""
    return state.sum_counters(snapshots.rows(spark, f"{out}/counters", C.GATEWAY_STATE))


class StatePublisher:
    """Publishes the gateways' counters every few seconds, as updates for the state table.

    Called after each micro-batch. A publication first takes a snapshot of the counters, so
    that a restarted job recovers from one row per gateway.
    """

    def __init__(self, out: str, seconds: float = C.STATE_SECONDS):
        self.out, self.seconds, self.due = out, seconds, 0.0

    def __call__(self, spark: SparkSession, batch_id: int) -> None:
        if time.monotonic() < self.due:
            return
        self.due = time.monotonic() + self.seconds
        snapshots.take(spark, f"{self.out}/counters", C.GATEWAY_STATE, state.sum_counters)
        updates = stored_counters(spark, self.out).withColumn("arrival_seq", F.lit(batch_id).cast("bigint"))
        sinks.overwrite_batch(updates, f"{self.out}/published", batch_id)


def published_state(spark: SparkSession, out: str) -> DataFrame:
    """The state table: all published updates, merged by version."""
    return state.merge_updates(snapshots.rows(spark, f"{out}/published", C.STATE_UPDATE))


def compact(spark: SparkSession, out: str, clear: bool = True) -> None:
    """The job that keeps the small tables of a live run small: snapshots of the counters and
    of the published state, then the batches before the last snapshot but one go."""
    snapshots.take(spark, f"{out}/counters", C.GATEWAY_STATE, state.sum_counters, clear=clear)
    published = f"{out}/published"  # not every batch publishes
    snapshots.take(spark, published, C.STATE_UPDATE, state.newest_updates, clear=clear, contiguous=False)


def store_deliveries(anomalies: DataFrame, out: str) -> DataStreamWriter:
    """Store a stream of anomalies that are delivered at least once, as they come."""
    return anomalies.writeStream.foreachBatch(
        lambda batch, batch_id: sinks.overwrite_batch_by_day(batch, out, batch_id)
    )


def delivered_once(spark: SparkSession, out: str) -> DataFrame:
    """The stored deliveries without copies. Copies are equal in all columns, so they lie on
    the same day; however late one comes, none is taken for another record."""
    return sinks.read_batches(spark, out, C.READING, by_day=True).distinct().drop("day")
