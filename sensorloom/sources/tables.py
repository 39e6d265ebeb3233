"""Table scans."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sensorloom.sources.messages import bounded

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def scan_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events table; the declared schema spares a look into the file footers."""
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The same table as a stream, whether it is one file or a folder of part files.

    A file stream wants a folder or a glob, hence the bracket in the name.
    """
    return bounded(spark.readStream.schema(EVENTS), files_per_batch).parquet(f"{folder}/[e]vents.parquet")


def scan_to_count(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table to be counted as a whole: the reader that takes counts from the files'
    footers is used, so that no row is read. The older reader, which all other scans use as it
    finds filters at run time, has no such thing; the session goes back to it."""
    older = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(older)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set(older, ",".join(name for name in before.split(",") if name.strip() != "parquet"))
    try:
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(older, before)


def scan_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored parquet table with its declared schema."""
    return spark.read.schema(schema).parquet(path)


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    lower: int,
    upper: int,
    partitions: int,
    key: str = "id",
    **options: str,
) -> DataFrame:
    """A database table read in parallel, by ranges of a whole-number key.

    Columns and filters used afterwards are pushed into the database's own query.
    """
    return (
        spark.read.format("jdbc")
        .options(**jdbc_options(url, table, lower, upper, partitions, key, **options))
        .load()
    )


def jdbc_options(
    url: str, table: str, lower: int, upper: int, partitions: int, key: str = "id", **options: str
) -> dict[str, str]:
    if partitions < 1 or upper < lower:
        raise ValueError("need at least one partition and lower <= upper")
    return {
        "fetchsize": "10000",
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
        **options,
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }
