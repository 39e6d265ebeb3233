"""Joins of a large table with a table of unknown size."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.session import write_table

BROADCAST_BYTES = 64 * 1024 * 1024

# A key with more than this share of the facts is joined apart from the others.
HOT_SHARE = 0.001


def join_sized(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str,
    max_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Join ``facts`` with ``lookup``, which has at most one row per key.

    The lookup table is measured first. Up to ``max_bytes`` it is broadcast and the facts
    are not shuffled at all. Beyond that it is written once and the facts are split: rows of the
    hot keys, of which there are at most 1 / ``hot_share``, meet a broadcast of just
    those lookup rows; all others are shuffled. No task gets all rows of a hot key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"not a join from facts to a lookup table: {how}")
    if measured_bytes(lookup) <= max_bytes:
        return facts.join(F.broadcast(lookup), key, how)
    table = write_table(lookup, "lookup")

    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    counts = write_table(counts, "key-counts")
    least = (counts.agg(F.sum("n")).first()[0] or 0) * hot_share
    hot = F.broadcast(counts.filter(F.col("n") > least).select(key, F.lit(True).alias("_hot")))
    flagged = facts.join(hot, key, "left")
    # Rows without a key match nothing; on the broadcast side they are not shuffled.
    apart = F.col("_hot").isNotNull() | F.col(key).isNull()
    hot_lookup = F.broadcast(table.join(hot, key, "left_semi"))
    return (
        flagged.filter(apart)
        .drop("_hot")
        .join(hot_lookup, key, how)
        .unionByName(flagged.filter(~apart).drop("_hot").join(table, key, how))
    )


def measured_bytes(table: DataFrame) -> int:
    """Size of a table's values as Spark holds them in a row, about."""

    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        return F.lit(8)

    row = sum((width(f) for f in table.schema.fields), F.lit(16))
    return table.agg(F.sum(row)).first()[0] or 0
