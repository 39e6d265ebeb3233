"""Writers for readings, anomalies, logs and the outbox."""

import uuid
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Rows of one day are dealt over so many tasks when a table is laid out by day.
DAY_PARTS = 16

#: Rows of one file, about, where a table is written in files of bounded size.
FILE_ROWS = 2_000_000


def append_by_day(df: DataFrame, path: str, parts: int = DAY_PARTS) -> None:
    """Append rows to a table laid out by day, at most ``parts`` files for each day.

    A job that is run again appends again; where that can happen, ``overwrite_batch_by_day``
    is the one to use.
    """
    _by_day(df, parts).write.mode("append").partitionBy("day").parquet(path)


def _by_day(df: DataFrame, parts: int) -> DataFrame:
    dated = df.withColumn("day", F.to_date("timestamp"))
    salt = F.pmod(F.xxhash64("id"), F.lit(parts))
    return dated.repartition("day", salt)


def write_sized(
    df: DataFrame, path: str, by_day: bool, file_rows: int = FILE_ROWS, time: str = "timestamp", key: str = "id"
) -> None:
    """Write a table in files of about ``file_rows`` rows, of one day each with ``by_day``. Rows
    are counted first, so that a day that holds most of them is many tasks' work, dealt by
    ``key``. Where small parts are put together into one task, its files end at ``file_rows``."""
    if not by_day:
        parts = max(1, -(-df.count() // file_rows))
        df.repartition(parts).write.parquet(path)
        return
    dated = df.withColumn("day", F.to_date(time))
    sizes = dated.groupBy("day").agg(F.ceil(F.count("*") / file_rows).alias("_parts"))
    sizes = sizes.withColumnRenamed("day", "_day")
    dealt = dated.join(sizes, F.col("day").eqNullSafe(F.col("_day")))
    salt = F.pmod(F.xxhash64(key), F.col("_parts"))
    sized = dealt.repartition("day", salt).drop("_day", "_parts").write.option("maxRecordsPerFile", file_rows)
    sized.partitionBy("day").parquet(path)


def since(table: DataFrame, bound: Column) -> DataFrame:
    """Rows of a table from ``bound`` on. Where it is laid out by day, whole days are skipped."""
    kept = table.filter(F.col("timestamp") >= bound)
    if "day" in table.columns:
        kept = kept.filter(F.col("day") >= bound.cast("date"))
    return kept


def overwrite_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch into a folder of its own. Doing it again after a failure
    replaces the same folder, so a replayed batch leaves no second copy."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def overwrite_batch_by_day(df: DataFrame, path: str, batch_id: int, parts: int = DAY_PARTS) -> None:
    """The same, with the rows inside laid out by day."""
    _by_day(df, parts).write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch_id={batch_id}")


def overwrite_batch_lines(df: DataFrame, path: str, batch_id: int) -> None:
    """The same for a column of text lines."""
    df.write.mode("overwrite").text(f"{path}/batch_id={batch_id}")


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, with_batch: bool = False, by_day: bool = False
) -> DataFrame:
    """All micro-batch folders as one table; an empty table if none was written yet. With
    ``by_day`` the table also has the column ``day`` that its folders are named by."""
    more = [T.StructField("batch_id", T.LongType())] if with_batch else []
    more += [T.StructField("day", T.DateType())] if by_day else []
    full = T.StructType(schema.fields + more)
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    # Columns of the folders' names come along unasked.
    return spark.read.schema(full).parquet(path).select(*full.fieldNames())


def read_batch(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """The rows of one micro-batch."""
    found = spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id}")
    return found.select(*schema.fieldNames())


LINES = T.StructType([T.StructField("value", T.StringType())])


def read_batch_lines(spark: SparkSession, path: str, with_batch: bool = False) -> DataFrame:
    """All micro-batch folders of text lines as one column ``value``."""
    full = T.StructType(LINES.fields + [T.StructField("batch_id", T.LongType())])
    if not folders(spark, path, "batch_id"):
        table = spark.createDataFrame([], full)
    else:
        table = spark.read.schema(full).text(path)
    return table if with_batch else table.drop("batch_id")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system it belongs to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n of the folders ``name=n`` in a path, ascending."""
    if not path_exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [status.getPath().getName() for status in system.listStatus(target)]
    return sorted(int(n.split("=")[1]) for n in found if n.startswith(f"{name}="))


def finished(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batch folders that were written to the end, ascending."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*/_SUCCESS")
    system = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.globStatus(pattern) or []
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found)


def days(spark: SparkSession, *paths: str) -> list[date]:
    """The days that folders of tables laid out by day are named by, the newest first. Rows
    without a time have no day."""
    found = set()
    for path in paths:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/day=*")
        system = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [status.getPath().getName().removeprefix("day=") for status in system.globStatus(pattern) or []]
        found |= {date.fromisoformat(name) for name in names if name[:1].isdigit()}
    return sorted(found, reverse=True)


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_file(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place with its whole content, unless there is one of that name: then
    nothing changes and the answer is no."""
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    target = fs.Path(path)
    system = target.getFileSystem(conf)
    if system.exists(target):
        return False
    draft = fs.Path(f"{path.rpartition('/')[0]}/.draft-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    kind = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = fs.FileContext.getFileContext(system.makeQualified(target).toUri(), conf)
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(target), options)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if system.exists(target):
            return False
        raise error
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, unless there is one of that name: then nothing is written and the
    answer is no."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        stream = system.create(target, False)
    except Py4JJavaError as error:
        if system.exists(target):
            return False
        raise error
    stream.write(bytearray(text.encode()))
    stream.close()
    return True
