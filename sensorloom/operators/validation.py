"""Decoding and checking of raw messages and of stored records.

Rules for a message: its text has to be one JSON object; extra fields are ignored; a
missing or null field is an error; text fields have to be JSON strings; number fields may
be numbers, true/false or text that reads as a number, and have to be finite; the time has
to be ISO-8601. Text that isn't valid UTF-8 comes as NULL and is malformed.
"""

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.expressions import iso_timestamp

REQUIRED = ("device_id", "temperature", "humidity", "timestamp")

# All fields but one come out of the parser as text, whatever their JSON type: numbers may
# be quoted anyway, and no number reads as a time. Only the device keeps its type, as a
# variant. Text that is no object lands in bad.
_FIELDS = "device_id VARIANT, temperature STRING, humidity STRING, timestamp STRING, bad STRING"

# Java also reads '1d' and '0x1p3' as numbers, so text has to look like a number first.
_NUMBER_SHAPE = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$"

_LARGEST = sys.float_info.max


def decode_messages(raw: DataFrame) -> DataFrame:
    """Parse ``value``: each message with its fields, and a ``reason`` if it is bad.

    The JSON fields and then their checked values each come out of a generator. Filters
    on a generator's columns stay above it; filters on projected columns would be pushed
    down and parse the text again for every field they look at.
    """
    parsed = F.from_json("value", _FIELDS, {"columnNameOfCorruptRecord": "bad"})
    # The parser stops at the end of the object, so the end of the text is looked at too.
    closed = F.rtrim("value", F.lit(" \t\r\n")).endswith("}")
    checked = {
        "device_id": F.when(
            F.schema_of_variant("m.json.device_id") == "STRING",
            F.try_variant_get("m.json.device_id", "$", "string"),
        ),
        "temperature": _number("temperature"),
        "humidity": _number("humidity"),
        "timestamp": iso_timestamp("m.json.timestamp"),
    }
    carried = raw.columns
    return (
        _generate(raw, carried, "m", {"closed": closed, "json": parsed})
        .transform(_generate, [*carried, "m"], "v", checked)
        .select(
            *carried,
            *[F.col(f"v.{name}").alias(name) for name in REQUIRED],
            F.col("m.json.timestamp").alias("timestamp_text"),
            _reason().alias("reason"),
        )
    )


def _generate(df: DataFrame, carried: list[str], name: str, fields: dict[str, Column]) -> DataFrame:
    one = F.array(F.struct(*[value.alias(field) for field, value in fields.items()]))
    return df.select(*carried, F.explode(one).alias(name))


def _number(name: str) -> Column:
    text = F.col(f"m.json.{name}")
    truth = F.when(text == "true", 1.0).when(text == "false", 0.0)
    number = text.try_cast("double")
    return F.when(text.rlike(_NUMBER_SHAPE) & number.between(-_LARGEST, _LARGEST), number).otherwise(truth)


def _reason() -> Column:
    reason = F.when(
        ~F.coalesce("m.closed", F.lit(False)) | F.col("m.json.bad").isNotNull(), "malformed_json"
    )
    for name in REQUIRED:
        missing = F.col(f"m.json.{name}").isNull()
        if name == "device_id":
            missing |= F.is_variant_null("m.json.device_id")
        reason = reason.when(missing, f"missing_{name}")
    for name in REQUIRED:
        reason = reason.when(F.col(f"v.{name}").isNull(), f"bad_{name}")
    return reason


def valid_messages(raw: DataFrame) -> DataFrame:
    """The good messages as readings, with the columns that came with the message."""
    decoded = decode_messages(raw).filter(F.col("reason").isNull())
    return decoded.drop("value", "timestamp_text", "reason")


def rejected_messages(raw: DataFrame) -> DataFrame:
    """The bad messages with their text and reason."""
    return decode_messages(raw).filter(F.col("reason").isNotNull()).select(*raw.columns, "reason")


def with_gateway(decoded: DataFrame) -> DataFrame:
    """Decoded messages, with a reason also where no gateway is named: nothing could be stored
    for them."""
    nameless = F.when(F.col("gateway_id").isNull(), "missing_gateway_id")
    return decoded.withColumn("reason", F.coalesce("reason", nameless))


def reject_summary(raw: DataFrame) -> DataFrame:
    """Number of bad messages per reason."""
    return rejected_messages(raw).groupBy("reason").agg(F.count("*").alias("rejected"))


def parse_timestamps(raw: DataFrame) -> DataFrame:
    """The time text of every message next to its parsed value (NULL if it is none)."""
    return decode_messages(raw).select("id", "timestamp_text", F.col("timestamp").alias("parsed"))


def complete_records(df: DataFrame, required: list[str]) -> DataFrame:
    """Records with all required fields present, as the store demands on arrival."""
    return df.dropna(subset=required)
