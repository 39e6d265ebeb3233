"""Versioned gateway state."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom import constants as C
from sensorloom.functions import expressions as E
from sensorloom.operators.joins import join_sized
from sensorloom.operators.running import running_totals
from sensorloom.operators.validation import complete_records


#: The counters after one reading.
RUNNING = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("gateway_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        *(T.StructField(n, T.LongType()) for n in ("version", "total_processed", "total_anomalies")),
    ]
)


def newest_state() -> Column:
    """Aggregate that keeps the update with the highest version of a key and, among equal
    versions, the one that arrived first. It is combined in each task before the shuffle
    and gives the same result in any arrival order."""
    return F.max(
        F.struct(
            "version",
            (-F.col("arrival_seq")).alias("earliness"),
            "total_processed",
            "total_anomalies",
            "last_updated",
        )
    )


def newest_updates(updates: DataFrame) -> DataFrame:
    """The accepted update of each gateway, out of those with all fields. Usable on tables
    and on streams."""
    return (
        complete_records(updates, ["gateway_id", "version", "total_processed", "total_anomalies"])
        .groupBy("gateway_id")
        .agg(newest_state().alias("s"))
        .select(
            "gateway_id",
            "s.version",
            "s.total_processed",
            "s.total_anomalies",
            "s.last_updated",
            (-F.col("s.earliness")).alias("arrival_seq"),
        )
    )


def merge_updates(updates: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Merge state updates into the current state table.

    A new gateway is inserted. A known one is replaced only by a strictly higher version;
    a stored row counts as arrived before all updates, so a tie leaves it as it is.
    """
    if current is not None:
        stored = current.withColumn("arrival_seq", F.lit(-(2**62)).cast("bigint"))
        updates = updates.unionByName(stored)
    return newest_updates(updates).drop("arrival_seq")


def running_counters(readings: DataFrame, slices: int | None = None) -> DataFrame:
    """The gateway's counters after each reading: processed, anomalies and version."""
    counted = running_totals(
        readings.select("id", "gateway_id", "timestamp", "classification"),
        "gateway_id",
        ["timestamp", "id"],
        {
            "total_processed": F.lit(1).cast("bigint"),
            "total_anomalies": F.when(E.is_anomaly(), 1).otherwise(0).cast("bigint"),
        },
        slices,
    )
    return counted.select(
        "id",
        "gateway_id",
        "timestamp",
        F.col("total_processed").alias("version"),
        "total_processed",
        "total_anomalies",
    )


def continued(counted: DataFrame, before: DataFrame) -> DataFrame:
    """Running counters that go on from earlier counters of their gateway."""
    counters = ("version", "total_processed", "total_anomalies")
    earlier = before.select("gateway_id", *[F.col(n).alias(f"_{n}") for n in counters])
    both = join_sized(counted, earlier, "gateway_id", "left")
    sums = {n: F.col(n) + F.coalesce(f"_{n}", F.lit(0)) for n in counters}
    return both.withColumns(sums).select(*RUNNING.fieldNames())


def sum_counters(added: DataFrame) -> DataFrame:
    """Counters per gateway, out of what parts of the readings add to them."""
    return added.groupBy("gateway_id").agg(
        *[F.sum(n).alias(n) for n in ("version", "total_processed", "total_anomalies")],
        F.max("last_updated").alias("last_updated"),
    )


def published_counters(readings: DataFrame, interval: str = C.STATE_INTERVAL) -> DataFrame:
    """The counters as each gateway publishes them: once per interval with readings.

    Readings are first counted per gateway and interval, and the running totals are
    taken over those counts.
    """
    ticks = readings.groupBy("gateway_id", F.window("timestamp", interval)["end"].alias("tick")).agg(
        F.count("*").alias("n"),
        E.count_where(E.is_anomaly()).alias("n_anomalies"),
        F.max(F.struct("timestamp", "id")).alias("newest"),
    )
    return running_totals(
        ticks,
        "gateway_id",
        ["tick"],
        {"total_processed": F.col("n"), "total_anomalies": F.col("n_anomalies")},
    ).select(
        "gateway_id",
        F.col("total_processed").alias("version"),
        "total_processed",
        "total_anomalies",
        F.col("newest.timestamp").alias("last_updated"),
        F.col("newest.id").alias("id"),
    )


def current_counters(readings: DataFrame) -> DataFrame:
    """Counters per gateway over all readings; usable on tables and on streams."""
    return readings.groupBy("gateway_id").agg(
        F.count("*").alias("version"),
        F.count("*").alias("total_processed"),
        E.count_where(E.is_anomaly()).alias("total_anomalies"),
        F.max("timestamp").alias("last_updated"),
    )


def load_table(states: DataFrame) -> DataFrame:
    return states.select("gateway_id", "total_processed", "total_anomalies")


def lookup_states(asked: DataFrame, states: DataFrame) -> DataFrame:
    """State of each asked gateway; ``exists`` is false where none is known."""
    known = states.select(
        "gateway_id", "version", "total_processed", "total_anomalies", F.lit(True).alias("exists")
    )
    return join_sized(asked, known, "gateway_id", "left").withColumn(
        "exists", F.coalesce("exists", F.lit(False))
    )
