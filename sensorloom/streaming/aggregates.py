"""Running aggregates over streams.

Counts are kept as what each micro-batch adds, in that batch's own folder, and summed on
reading; so no row is too late, and there is no state that grows with time. The merged
gateway state holds one row per gateway.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sensorloom import constants as C
from sensorloom.operators import aggregates, state
from sensorloom.sources import sinks
from sensorloom.streaming import snapshots

MINUTE_ROW = T.StructType([T.StructField("time", T.TimestampNTZType()), T.StructField("n", T.LongType())])


def _write_changes(changes: DataFrame, out: str) -> DataStreamWriter:
    return changes.writeStream.outputMode("update").foreachBatch(
        lambda batch, batch_id: sinks.overwrite_batch(batch, out, batch_id)
    )


def counters(readings: DataFrame, out: str) -> DataStreamWriter:
    """Counters per gateway, published whenever they change."""
    return _write_changes(state.current_counters(readings), out)


def read_counters(spark: SparkSession, out: str) -> DataFrame:
    """The gateway state after merging all published counters."""
    published = sinks.read_batches(spark, out, C.GATEWAY_STATE, with_batch=True)
    return state.merge_updates(published.withColumnRenamed("batch_id", "arrival_seq"))


def merge_state(updates: DataFrame, out: str) -> DataStreamWriter:
    """Version-gated merge of a stream of state updates."""
    return _write_changes(state.newest_updates(updates), out)


def read_state(spark: SparkSession, out: str) -> DataFrame:
    return state.merge_updates(sinks.read_batches(spark, out, C.STATE_UPDATE))


def _add_counts(readings: DataFrame, count, out: str) -> DataStreamWriter:
    return readings.writeStream.foreachBatch(
        lambda batch, batch_id: sinks.overwrite_batch(count(batch), out, batch_id)
    )


def per_minute(readings: DataFrame, out: str) -> DataStreamWriter:
    """Readings per minute, as what each micro-batch adds to a minute, however late."""
    return _add_counts(readings, lambda batch: aggregates.by_minute(batch, "n"), out)


def sum_minutes(added: DataFrame) -> DataFrame:
    return added.groupBy("time").agg(F.sum("n").alias("n"))


def read_per_minute(
    spark: SparkSession, out: str, name: str = "processed_data", first: date | None = None
) -> DataFrame:
    """Readings per minute, from the day ``first`` on if it is given."""
    if first is None:
        added = snapshots.rows(spark, out, MINUTE_ROW)
    else:
        added = snapshots.rows_since(spark, out, MINUTE_ROW, "time", first)
    return sum_minutes(added).select("time", F.col("n").alias(name)).orderBy("time")


def compact_minutes(spark: SparkSession, out: str, clear: bool = True) -> None:
    """Put the minutes so far into day files, one row for each. Minutes that were put there
    before stay as they are: what arrived for them since is a small run of corrections, which
    readers add, and which is put together with them once corrections have become many."""
    snapshots.compact(
        spark, out, MINUTE_ROW, by_day=True, combine=sum_minutes, time="time", key="time", clear=clear
    )


def anomaly_rate(readings: DataFrame, out: str) -> DataStreamWriter:
    """Counters that the rate is made of, as what each micro-batch adds."""
    return _add_counts(readings, state.current_counters, out)


def compact_anomaly_rate(spark: SparkSession, out: str, clear: bool = True) -> None:
    """Snapshot of the counters so far, one row for each gateway."""
    snapshots.take(spark, out, C.GATEWAY_STATE, state.sum_counters, clear=clear)


def running_counters(readings: DataFrame, out: str) -> DataStreamWriter:
    """The gateway's counters after every single reading, in order of arrival: the readings of a
    micro-batch by time and id, after all those of the batches before it.

    A micro-batch starts from the gateways' counters at the end of the batch before, and adds
    the running totals within itself; these don't put a gateway into one task. A batch that is
    run again starts from the same counters, also if a snapshot was taken of it meanwhile.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            added = state.running_counters(batch)
            before = counters_before(spark, out, batch_id)
            sinks.overwrite_batch(state.continued(added, before), f"{out}/running", batch_id)
            sinks.overwrite_batch(state.current_counters(batch), f"{out}/counters", batch_id)
        finally:
            batch.unpersist()

    return readings.writeStream.foreachBatch(write)


def counters_before(spark: SparkSession, out: str, batch_id: int) -> DataFrame:
    """The gateways' counters at the end of the batch before."""
    return state.sum_counters(snapshots.rows(spark, f"{out}/counters", C.GATEWAY_STATE, upto=batch_id - 1))


def read_running_counters(spark: SparkSession, out: str) -> DataFrame:
    return snapshots.rows(spark, f"{out}/running", state.RUNNING)


def compact_running_counters(spark: SparkSession, out: str, clear: bool = True) -> None:
    """Snapshot of the gateways' counters, and the readings' counters in few files by day."""
    snapshots.take(spark, f"{out}/counters", C.GATEWAY_STATE, state.sum_counters, clear=clear)
    snapshots.compact(spark, f"{out}/running", state.RUNNING, by_day=True, clear=clear)


def read_anomaly_rate(spark: SparkSession, out: str) -> DataFrame:
    counts = snapshots.rows(spark, out, C.GATEWAY_STATE).groupBy("gateway_id").agg(
        F.sum("total_processed").alias("n"), F.sum("total_anomalies").alias("flagged")
    )
    return counts.select("gateway_id", (F.col("flagged").cast("double") / F.col("n") * 100).alias("anomaly_rate"))
