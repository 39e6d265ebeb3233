"""The pipeline's tables as views over the events table.

All of them follow from ``events`` by fixed rules, so they grow with it. Each takes and
returns DataFrames; nothing is computed until a query uses them.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom import constants as C
from sensorloom.functions import expressions as E
from sensorloom.operators import readings as R
from sensorloom.operators import state
from sensorloom.session import write_table
from sensorloom.sources.tables import scan_events

GATEWAYS = 4
ANOMALY_FROM = 70.0
# Arrival numbers of the views' own updates stay below this; the tie and the stale
# update of each gateway arrive after them.
ARRIVALS = 1_000_003


def rule_class() -> Column:
    """Class by the panel's upper threshold, where no model is involved."""
    return E.class_name(F.col("temperature") >= ANOMALY_FROM)


def sensor_data(events: DataFrame) -> DataFrame:
    return (
        events.select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("gw_"), (F.col("user_id") % GATEWAYS).cast("string")).alias("gateway_id"),
            E.device_name("user_id").alias("device_id"),
            F.round(20 + F.col("value") % 60, 2).alias("temperature"),
            (30 + F.get_json_object("props", "$.k").cast("bigint") % 60).cast("double").alias("humidity"),
            F.col("ts").alias("timestamp"),
        )
        .withColumn("classification", rule_class())
    )


def load(spark: SparkSession, folder: str) -> DataFrame:
    """``sensor_data`` of a data folder."""
    return sensor_data(scan_events(spark, folder))


def devices(readings: DataFrame) -> DataFrame:
    number = F.substring_index("device_id", "_", -1).cast("bigint")
    return (
        readings.groupBy("device_id")
        .agg(F.min("timestamp").alias("registered_at"))
        .select(
            number.alias("id"),
            "device_id",
            F.md5("device_id").alias("api_key"),
            (number % 10 != 0).alias("active"),
            "registered_at",
        )
    )


def state_updates(readings: DataFrame) -> DataFrame:
    """Published counters in shuffled arrival order, and for each gateway a late update
    with the newest version but other totals (a tie) and one with an old version."""
    published = state.published_counters(readings).withColumn("arrival_seq", F.col("id") * 7919 % ARRIVALS).drop("id")
    last = state.current_counters(readings)
    tie = last.withColumns(
        {"total_anomalies": F.col("total_anomalies") + 1000, "arrival_seq": F.lit(2_000_000).cast("bigint")}
    )
    stale = last.withColumns(
        {
            "version": F.lit(1).cast("bigint"),
            "total_anomalies": F.lit(0).cast("bigint"),
            "arrival_seq": F.lit(3_000_000).cast("bigint"),
        }
    )
    return published.unionByName(tie).unionByName(stale).select(*C.STATE_UPDATE.fieldNames())


def gateway_state(readings: DataFrame) -> DataFrame:
    """The state table as the dashboards read it, in one pass. Versions only grow, so the merge
    of all updates keeps each gateway's last publication: its counters over all readings, which
    came before the tie."""
    return state.current_counters(readings)


def merged_state(readings: DataFrame) -> DataFrame:
    """The same table by the merge itself: what arrived first was merged into an empty table, all later
    updates, late ones, ties and stale ones among them, into the stored rows."""
    updates = write_table(state_updates(readings), "state-updates")
    early = F.col("arrival_seq") < ARRIVALS // 2
    stored = write_table(state.merge_updates(updates.filter(early)), "gateway-state")
    return write_table(state.merge_updates(updates.filter(~early), stored), "gateway-state")


def raw_messages(readings: DataFrame) -> DataFrame:
    """The readings as the JSON text devices send, some of it damaged: cut off, without
    humidity, with the temperature in quotes (which is allowed), with a bad time, or with
    numbers that aren't finite."""
    named = {
        "device_id": F.col("device_id"),
        "temperature": F.col("temperature"),
        "humidity": F.col("humidity"),
        "timestamp": E.iso_text(),
    }

    def text(**changed: Column | None) -> Column:
        fields = {**named, **changed}
        return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items() if c is not None]))

    value = (
        F.when(F.col("id") % 97 == 0, F.substring(text(), 1, 20))
        .when(F.col("id") % 101 == 0, text(humidity=None))
        .when(F.col("id") % 103 == 0, text(temperature=F.col("temperature").cast("string")))
        .when(F.col("id") % 107 == 0, text(timestamp=F.lit("bad")))
        .when(F.col("id") % 109 == 0, text(temperature=F.lit("nan")))
        .when(F.col("id") % 113 == 0, text(humidity=F.lit("-Infinity")))
        .otherwise(text())
    )
    return readings.select("id", "gateway_id", value.alias("value"))


def nameless_messages(readings: DataFrame) -> DataFrame:
    """The raw messages, some of them without the gateway they came through."""
    lost = F.when(F.col("id") % 31 != 0, F.col("gateway_id"))
    return raw_messages(readings).withColumn("gateway_id", lost)


def device_requests(readings: DataFrame) -> DataFrame:
    """A registration with every 7th reading and a toggle with every 11th, for its device; some
    are below zero."""
    number = F.substring_index("device_id", "_", -1).cast("bigint")
    kind = F.when(F.col("id") % 7 == 0, "register").when(F.col("id") % 11 == 0, "toggle")
    return readings.select(
        F.col("id").alias("request_seq"),
        kind.alias("kind"),
        F.when(F.col("id") % 91 == 0, -1 - number).otherwise(number).alias("device_number"),
        F.col("timestamp").alias("requested_at"),
    ).filter("kind is not null")


def validate_requests(readings: DataFrame) -> DataFrame:
    key = F.when(F.col("id") % 50 == 0, "unknown").otherwise(F.md5("device_id"))
    return readings.select("id", key.alias("api_key"))


def register_requests(devices: DataFrame) -> DataFrame:
    """One request per known device, for twice its number (about half of those exist), one
    more for the smallest of these, and one below zero."""
    numbers = devices.select((F.col("id") + 1).alias("request_seq"), (F.col("id") * 2).alias("device_number"))
    ends = devices.agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low is not null")
    more = ends.select(
        F.explode(
            F.array(
                F.struct((F.col("high") + 2).alias("request_seq"), (F.col("low") * 2).alias("device_number")),
                F.struct((F.col("high") + 3).alias("request_seq"), F.lit(-1).cast("bigint").alias("device_number")),
            )
        ).alias("r")
    )
    return numbers.unionByName(more.select("r.*"))


def toggle_requests(devices: DataFrame) -> DataFrame:
    """Each device's number modulo three requests, and one for a device that does not exist."""
    asked = devices.select(F.explode(F.array_repeat("device_id", (F.col("id") % 3).cast("int"))).alias("device_id"))
    return asked.unionByName(devices.sparkSession.createDataFrame([("unknown",)], "device_id string"))


def model_registry(readings: DataFrame) -> DataFrame:
    """One published model for each day with readings."""
    days = readings.groupBy(F.to_date("timestamp").alias("day")).agg(F.max("timestamp").alias("created_at"))
    first = days.agg(F.min("day")).scalar()
    version = (F.datediff("day", first) + 1).cast("bigint")
    return days.select(
        version.alias("version"), F.concat(F.lit("v="), version.cast("string")).alias("path"), "created_at"
    )


def outbox_lines(readings: DataFrame) -> DataFrame:
    """Outbox text of all anomalies; every fiftieth id was written twice."""
    copies = F.when(F.col("id") % 50 == 0, 2).otherwise(1)
    return R.anomalies(readings).select(F.explode(F.array_repeat(E.outbox_line(), copies)).alias("value"))


def delivered_lines(events: DataFrame) -> DataFrame:
    """Text of the anomalies that reached the store: all but those of error events."""
    arrived = sensor_data(events.filter("event_type != 'error'"))
    return R.anomalies(arrived).select(E.outbox_line().alias("value"))


def redelivered_anomalies(readings: DataFrame) -> DataFrame:
    """Anomalies as stored with at-least-once delivery: some came twice."""
    copies = F.when(F.col("id") % 50 == 0, 2).otherwise(1)
    stored = R.anomalies(readings)
    return stored.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy")


def register_views(spark: SparkSession, folder: str) -> None:
    """Register the tables under their names, for queries written as SQL text."""
    readings = load(spark, folder)
    for name, view in {
        "sensor_data": readings,
        "anomalies": R.anomalies(readings),
        "gateway_state": gateway_state(readings),
        "devices": devices(readings),
        "logs": R.log_rows(readings),
    }.items():
        view.createOrReplaceTempView(name)
