"""Device registration, activation and key checks as batch requests."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.expressions import device_name
from sensorloom.operators.joins import join_sized


def listing(devices: DataFrame) -> DataFrame:
    """All devices, without their keys."""
    return devices.select("device_id", "active", "registered_at")


def active_keys(devices: DataFrame) -> DataFrame:
    return devices.filter("active").select("api_key")


def valid_requests(requests: DataFrame, devices: DataFrame) -> DataFrame:
    """Requests whose key belongs to an active device."""
    return join_sized(requests, active_keys(devices), "api_key", "left_semi")


def rejected_requests(requests: DataFrame, devices: DataFrame) -> DataFrame:
    """Requests whose key is unknown or belongs to an inactive device."""
    return join_sized(requests, active_keys(devices), "api_key", "left_anti")


def new_key(salt: str) -> Column:
    """Key of a new device, 32 hex digits. Derived from the id and a secret salt rather
    than drawn at random, so that a repeated task gives the same key."""
    return F.substring(F.sha2(F.concat("device_id", F.lit(salt)), 256), 1, 32)


def register(requests: DataFrame, devices: DataFrame, salt: str) -> DataFrame:
    """Answer every registration request (request_seq, device_number) with a status.

    Numbers below zero are ``invalid``. For a device not yet known the first request is
    ``created`` and gets a key; all others are ``exists``.
    """
    named = requests.withColumn("device_id", F.when(F.col("device_number") >= 0, device_name("device_number")))
    # One row per new device, known ones removed. An outer join, as an anti join would be
    # moved below the aggregation, where a device with very many requests fills one task.
    first = (
        named.filter(F.col("device_id").isNotNull())
        .groupBy("device_id")
        .agg(F.min("request_seq").alias("first_seq"))
        .join(devices.select("device_id", F.lit(True).alias("known")), "device_id", "left")
        .filter(F.col("known").isNull())
        .drop("known")
    )
    answered = join_sized(named, first, "device_id", "left")
    status = (
        F.when(F.col("device_id").isNull(), "invalid")
        .when(F.col("request_seq") == F.col("first_seq"), "created")
        .otherwise("exists")
    )
    return answered.withColumn("status", status).select(
        "request_seq",
        "device_number",
        "device_id",
        "status",
        F.when(F.col("status") == "created", new_key(salt)).alias("api_key"),
    )


def created_devices(answers: DataFrame, registered_at: Column | None = None) -> DataFrame:
    """Device rows to append for the created requests."""
    return answers.filter("status = 'created'").select(
        "device_id",
        "api_key",
        F.lit(True).alias("active"),
        (F.localtimestamp() if registered_at is None else registered_at).alias("registered_at"),
    )


def toggle(requests: DataFrame, devices: DataFrame) -> DataFrame:
    """Outcome of toggle requests (device_id each): the new flag of every device asked
    for, NULL and ``unknown`` for devices that do not exist.

    Requests are counted per device first; an odd count flips the flag.
    """
    asked = requests.groupBy("device_id").agg(F.count("*").alias("toggles"))
    known = devices.select("device_id", "active")
    return asked.join(known, "device_id", "left").select(
        "device_id",
        "toggles",
        F.when(F.col("toggles") % 2 == 1, ~F.col("active")).otherwise(F.col("active")).alias("active"),
        F.when(F.col("active").isNull(), "unknown").otherwise("toggled").alias("status"),
    )


def apply_toggles(devices: DataFrame, outcome: DataFrame) -> DataFrame:
    """The device table with the new flags."""
    changed = outcome.filter("status = 'toggled'").select("device_id", F.col("active").alias("new_active"))
    return (
        devices.join(changed, "device_id", "left")
        .withColumn("active", F.coalesce("new_active", "active"))
        .select(*devices.columns)
    )


def key_violations(devices: DataFrame) -> DataFrame:
    """Device ids and keys that occur more than once."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("constraint_name"), F.col(name).alias("key_value"))
            for name in ("device_id", "api_key")
        ]
    )
    return (
        devices.select(F.explode(pairs).alias("k"))
        .groupBy("k.constraint_name", "k.key_value")
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )
