"""Helpers shared by the text operators: reading columns, drawing splits, bounded shards."""

from __future__ import annotations

import math
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import write_table

#: A word is a run of characters other than these six (space, tab to carriage return).
SPACES = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    """The named columns of one of the given tables."""
    df = spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")
    return df.select(*columns) if columns else df


def remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo ``modulus``; a missing key counts as the empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def drawn(df: DataFrame, key: str, wanted: int, total: int) -> DataFrame:
    """About ``wanted`` of ``total`` rows, drawn by a hash of the key: the same rows for
    any partitioning, and all rows where there are no more than wanted."""
    if total <= wanted:
        return df
    share = math.ceil(wanted / total * 2**32)
    draw = F.xxhash64(F.lit("draw"), F.col(key).cast("string")).bitwiseAND(F.lit(2**32 - 1))
    return df.filter(draw < share)


def labelled_texts(docs: DataFrame, picked: DataFrame, most_bytes: int) -> DataFrame:
    """The rows (_id, text, _label) of ``docs`` that a drawn table (_id, _label) covers, written
    once; if they hold more than ``most_bytes`` of text, as many of them as hold about that,
    drawn by a hash of id and text. The drawn table is bounded by its maker: it is broadcast,
    and no text is shuffled."""
    named = docs.select(F.col("doc_id").alias("_id"), "text")
    rows = write_table(named.join(F.broadcast(picked), "_id").select("_id", "text", "_label"), "labelled")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= most_bytes:
        return rows
    draw = F.xxhash64(F.lit("bytes"), F.col("_id").cast("string"), "text").bitwiseAND(F.lit(2**32 - 1))
    return rows.filter(draw < math.ceil(most_bytes / size * 2**32))


def shards(total_bytes: int, per_shard: int, least: int) -> int:
    """Number of shards so that one holds about ``per_shard`` bytes."""
    return max(least, math.ceil(total_bytes / per_shard))


def worker_cache() -> dict:
    """What this Python worker keeps from one task to the next. Code that comes by value has new
    globals in every task, so it is kept beside the loaded modules."""
    name = "sensorloom_worker"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))
