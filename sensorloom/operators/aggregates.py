"""Counts, rates, trends and reducers over readings.

Every aggregation here is on few or well-spread keys and is combined inside each task
before the shuffle, so a gateway with most of the rows costs no more than any other.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import expressions as E


def total(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def per_minute(readings: DataFrame, name: str = "processed_data") -> DataFrame:
    return by_minute(readings, name).orderBy("time")


def by_minute(readings: DataFrame, name: str) -> DataFrame:
    """The same without an order."""
    return readings.groupBy(E.truncated("minute").alias("time")).agg(F.count("*").alias(name))


def per_gateway(readings: DataFrame, name: str = "processed_data") -> DataFrame:
    return readings.groupBy("gateway_id").agg(F.count("*").alias(name))


def anomaly_rate(readings: DataFrame) -> DataFrame:
    """Share of anomalies per gateway in percent."""
    return readings.groupBy("gateway_id").agg(
        (E.count_where(E.is_anomaly()).cast("double") / F.count("*") * 100).alias("anomaly_rate")
    )


def gateways(readings: DataFrame) -> DataFrame:
    return readings.select("gateway_id").distinct()


def summary(readings: DataFrame) -> DataFrame:
    """Total records and total anomalies in one pass."""
    return readings.agg(
        F.count("*").alias("total_records"),
        E.count_where(E.is_anomaly()).alias("total_anomalies"),
    )


def hourly(readings: DataFrame) -> DataFrame:
    """Records per hour; the hour's text is made once per group, not per reading."""
    hours = readings.groupBy(E.truncated("hour").alias("time")).agg(F.count("*").alias("records"))
    return hours.select(E.hour_key("time").alias("hour"), "records")


def anomaly_report(anomalies: DataFrame) -> DataFrame:
    """Anomalies per gateway, each row with the overall total."""
    counts = per_gateway(anomalies, "anomalies")
    overall = counts.agg(F.coalesce(F.sum("anomalies"), F.lit(0))).scalar()
    return counts.withColumn("total_anomalies", overall)


def anomaly_report_row(anomalies: DataFrame) -> DataFrame:
    """The report head as one row, also where there are no anomalies: the total and the counts
    per gateway as JSON, by gateway.

    It holds one entry per gateway. The detail rows stay a table of their own
    (``anomaly_detail``), as one array of all anomalies would not fit one row.
    """
    counts = F.map_from_entries(F.array_sort(F.collect_list(F.struct("gateway_id", "n"))))
    return per_gateway(anomalies, "n").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_anomalies"), F.to_json(counts).alias("per_gateway")
    )


def anomaly_detail(anomalies: DataFrame) -> DataFrame:
    return anomalies.select(
        "gateway_id", "device_id", "temperature", "humidity", "timestamp", "classification"
    )


def leader(states: DataFrame) -> DataFrame:
    """Every gateway with the leader, the smallest known id, and whether it is the one."""
    elected = states.agg(F.min("gateway_id")).scalar()
    return states.select("gateway_id", elected.alias("leader")).withColumn(
        "is_leader", F.col("gateway_id") == F.col("leader")
    )


def series_totals(readings: DataFrame) -> DataFrame:
    """Sums of the two per-minute series, as their legends show them.

    Both series come from one aggregation by minute.
    """
    minutes = readings.groupBy(E.truncated("minute").alias("time")).agg(
        F.count("*").alias("processed_data"), E.count_where(E.is_anomaly()).alias("anomalies")
    )
    sums = minutes.agg(
        F.coalesce(F.sum("processed_data"), F.lit(0)).alias("processed_data"),
        F.coalesce(F.sum("anomalies"), F.lit(0)).alias("anomalies"),
    )
    return sums.unpivot([], ["processed_data", "anomalies"], "series", "total")


def load_totals(states: DataFrame) -> DataFrame:
    return states.agg(
        F.sum("total_processed").alias("total_processed"), F.sum("total_anomalies").alias("total_anomalies")
    )


def last_and_mean(readings: DataFrame, decimals: int = 6) -> DataFrame:
    """Last value and mean of temperature and humidity. Means are rounded, since the
    last digits of a sum of doubles depend on the order the tasks finish in."""
    newest = F.struct("timestamp", "id")
    return readings.agg(
        F.max_by("temperature", newest).alias("last_temperature"),
        F.round(F.avg("temperature"), decimals).alias("mean_temperature"),
        F.max_by("humidity", newest).alias("last_humidity"),
        F.round(F.avg("humidity"), decimals).alias("mean_humidity"),
    )


def last_not_null(series: DataFrame, value: str, time: str = "time") -> DataFrame:
    """The newest value of a series that is not null, with its time."""
    return series.filter(F.col(value).isNotNull()).agg(
        F.max(time).alias(time), F.max_by(value, time).alias("last_value")
    )


def anomaly_series(readings: DataFrame) -> DataFrame:
    """Anomalies for every minute with readings; minutes without any hold NULL."""
    return readings.groupBy(E.truncated("minute").alias("time")).agg(
        F.nullif(E.count_where(E.is_anomaly()), F.lit(0)).alias("anomalies")
    )


def throughput(readings: DataFrame) -> DataFrame:
    """Messages per second for each gateway and for all of them (gateway_id NULL).

    No rate is given for a time span of zero. The overall row is made from the few
    per-gateway rows, not from a second pass.
    """
    gateway = readings.groupBy("gateway_id").agg(
        F.count("*").alias("messages"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )
    overall = gateway.agg(
        F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    ).select(F.lit(None).cast("string").alias("gateway_id"), "messages", "first", "last")
    seconds = F.timestamp_diff("MICROSECOND", F.col("first"), F.col("last")) / F.lit(1_000_000)
    return (
        gateway.unionByName(overall)
        .withColumn("duration_seconds", seconds)
        .select(
            "gateway_id",
            "messages",
            "duration_seconds",
            F.try_divide(F.col("messages"), F.nullif("duration_seconds", F.lit(0.0))).alias("throughput"),
        )
    )
