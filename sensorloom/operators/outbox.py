"""The outbox of anomalies: written before delivery, removed once delivered."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom import constants as C
from sensorloom.functions import expressions as E
from sensorloom.operators.joins import join_sized


def to_lines(anomalies: DataFrame) -> DataFrame:
    """Anomalies as one column of outbox lines."""
    return anomalies.select(E.outbox_line().alias("value"))


def records(lines: DataFrame) -> DataFrame:
    """The records of outbox lines, one for each line; blank lines give none."""
    text = lines.select(F.trim("value").alias("text")).filter("text != ''")
    parsed = text.select(F.from_json("text", C.OUTBOX_RECORD).alias("r")).select("r.*")
    return parsed.withColumn("timestamp", E.iso_timestamp("timestamp"))


def _digest() -> Column:
    """What stands for a line's text in a join: 32 bytes in place of the whole text."""
    return F.sha2(F.trim("value"), 256)


def pending(lines: DataFrame, delivered: DataFrame) -> DataFrame:
    """Outbox lines left after delivery: all copies of a delivered text are gone."""
    done = delivered.select(_digest().alias("digest")).distinct()
    return join_sized(lines.withColumn("digest", _digest()), done, "digest", "left_anti").select("value")


def replay(lines: DataFrame, delivered: DataFrame) -> DataFrame:
    """Records still to be sent, one row per distinct text with its number of copies.

    Copies are counted before the join, so a text with very many copies is one row by
    then, and both sides of the join have unique keys. It is written as an outer join, as
    an anti join would be moved below the count, where such a text fills one task.
    """
    counted = lines.groupBy(_digest().alias("digest")).agg(
        F.count("*").alias("copies"), F.first(F.trim("value")).alias("text")
    )
    done = delivered.select(_digest().alias("digest")).distinct().withColumn("done", F.lit(True))
    return (
        counted.join(done, "digest", "left")
        .filter(F.col("done").isNull())
        .select(F.from_json("text", C.OUTBOX_RECORD).alias("r"), "copies")
        .select("r.*", "copies")
        .withColumn("timestamp", E.iso_timestamp("timestamp"))
    )


def deduplicated(anomalies: DataFrame) -> DataFrame:
    """Each delivered record once. Copies from repeated delivery are equal in every
    column; they are dropped inside each task before the shuffle."""
    return anomalies.distinct()
