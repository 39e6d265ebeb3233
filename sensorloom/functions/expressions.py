"""Column expressions shared by the batch and the stream operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorloom import constants as C

# Date, any one character, time to the second, fraction of any length, zone. Both parts may
# be written without their marks.
_ZONE = r"(Z|[+-]\d{2}(:?\d{2})?)?"
_DATE = r"(\d{4})-?(\d{2})-?(\d{2})"
_TIME = r"(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
ISO_SHAPE = (
    r"^(\d{4}-\d{2}-\d{2}|\d{8})"
    r"([T ](\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?|\d{4}(\d{2}([.,]\d+)?)?)" + _ZONE + ")?$"
)

# The form that messages nearly always have; it needs no taking apart.
USUAL_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def is_anomaly(classification: str = "classification") -> Column:
    return F.col(classification) == C.ANOMALY


def class_name(flagged: Column) -> Column:
    """Class name of a yes/no verdict; an unknown verdict counts as normal."""
    return F.when(flagged, C.ANOMALY).otherwise(C.NORMAL)


def class_from_forest(prediction: str = "prediction") -> Column:
    return class_name(F.col(prediction) == C.FOREST_ANOMALY)


def class_from_isolation(verdict: str = "verdict") -> Column:
    return class_name(F.col(verdict) == C.ISOLATION_ANOMALY)


def label(classification: str = "classification") -> Column:
    """Training label, 1 for an anomaly. It carries its two values as column metadata,
    which spares the trainer a pass over the table to find the number of classes."""
    values = {"ml_attr": {"name": "label", "type": "nominal", "vals": [C.NORMAL, C.ANOMALY]}}
    return F.when(is_anomaly(classification), 1).otherwise(0).alias("label", metadata=values)


def truncated(unit: str, time: Column | str = "timestamp") -> Column:
    """``date_trunc`` that stays without a time zone."""
    return F.date_trunc(unit, time).cast("timestamp_ntz")


def hour_key(time: Column | str = "timestamp") -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH")


def iso_text(time: Column | str = "timestamp") -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def iso_timestamp(text: Column | str) -> Column:
    """ISO-8601 text to a time without zone; NULL where the text is none. Digits after the
    sixth of a fraction are cut off.

    The other forms are made into the usual one by three replacements, each of the one before:
    taken apart into columns they would fill more code than is compiled, and every message
    would be decoded by interpreted code.
    """
    text = F.col(text) if isinstance(text, str) else text
    pattern = "^" + _DATE + "(?:[T ]" + _TIME + _ZONE + r")?\R?$"
    # Missing parts become zeros: two go before each part, of which the last two digits stay,
    # and six go behind the fraction, of which the first six stay.
    filled = F.regexp_replace(text, F.lit(pattern), F.lit("$1-$2-$3T00$4:00$5:00$6.$7000000 $8"))
    cut = r"T\d*(\d{2}):\d*(\d{2}):\d*(\d{2})\.(\d{6})\d* "
    whole = F.regexp_replace(filled, F.lit(cut), F.lit("T$1:$2:$3.$4"))
    # An hour alone as a zone gets its minutes.
    zoned = F.regexp_replace(whole, F.lit(r"(\.\d{6}[+-]\d{2})$"), F.lit("$1:00"))
    parsed = F.when(text.rlike(USUAL_SHAPE), F.try_to_timestamp(text)).when(
        text.rlike(ISO_SHAPE), F.try_to_timestamp(zoned)
    )
    return parsed.cast("timestamp_ntz")


def log_message(device: str = "device_id", classification: str = "classification") -> Column:
    return F.concat(F.col(device), F.lit(C.LOG_ARROW), F.col(classification))


def device_name(number: Column | str) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(C.DEVICE_PREFIX), number.cast("string"))


def band(measure: Column | str) -> Column:
    """Band of a value between the panel's steps; below the first step there is none."""
    measure = F.col(measure) if isinstance(measure, str) else measure
    bands = F.lit(None).cast("string")
    for step, name in zip(C.BAND_STEPS, C.BAND_NAMES):
        bands = F.when(measure >= step, name).otherwise(bands)
    return bands


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def outbox_line() -> Column:
    """The outbox text of a scored reading."""
    return F.to_json(
        F.struct(
            "gateway_id",
            "device_id",
            "temperature",
            "humidity",
            iso_text("timestamp").alias("timestamp"),
            "classification",
        )
    )
