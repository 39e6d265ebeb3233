"""Session settings and the shared folder that written tables and checkpoints go to."""

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "sensorloom", master: str | None = None, **settings) -> SparkSession:
    """A session with UTC times, run-time re-planning and skew handling switched on.

    Sizes (shuffle partitions, memory) are left to the cluster's own defaults unless
    given in ``settings``, as in ``build_session(**{"spark.sql.shuffle.partitions": "8"})``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Keyed stream state lives on local disk with snapshots in the checkpoint, so
        # its size is not tied to the executors' heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, where driver and tasks share one disk, may fall back to a
    temporary folder; on a cluster a machine-local path would be lost with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="sensorloom-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows of one file, about, of a written table that is known to be small.
TABLE_ROWS = 100_000

#: Bytes, about, that a batch for a Python worker and a row group of a table of large rows hold,
#: unless one row has more.
LARGE_ROWS_BYTES = 4 << 20


def write_table(df: DataFrame, name: str, rows: int | None = None, large_rows: bool = False) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Used where a result is read more than once, or must not be computed twice with
    different outcomes. The written table survives the loss of executors. With ``rows``, the
    most rows that there can be, a table of fewer files' worth than there are shuffle partitions
    is dealt to so many files, where each partition would make a file of a few rows. With
    ``large_rows``, rows may have megabytes each: they are held a few at a time, in row groups of
    bounded size (the codec keeps buffers as large as the largest page outside the heap).
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    if rows is not None:
        files = max(1, -(-rows // TABLE_ROWS))
        df = df.repartition(files) if files < int(spark.conf.get("spark.sql.shuffle.partitions")) else df
    options = {}
    if large_rows:
        options = {
            "parquet.block.size": LARGE_ROWS_BYTES,
            "parquet.block.size.row.check.min": 1,
            "parquet.page.size.row.check.min": 1,
            "parquet.enable.dictionary": "false",
        }
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def bounded(spark: SparkSession) -> Iterator[None]:
    """What is computed meanwhile goes to Python workers in batches of bounded size (Spark makes
    64 MB of each, in buffers outside the heap that grow by doubling, and the worker has it again)
    and removes its shuffle files when done, not when the driver happens to collect garbage."""
    settings = {
        "spark.sql.execution.arrow.maxBytesPerBatch": str(LARGE_ROWS_BYTES),
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def spread(df: DataFrame) -> DataFrame:
    """Deal a table to all cores, ahead of work that goes over it many times. A scan that is cut
    into a partition or so for each core may have all its rows in a few of them, as a file's row
    groups are not cut. A table of far more partitions than cores is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < 4 * cores else df


def cached(df: DataFrame) -> DataFrame:
    """``df`` kept for a few passes right away. Trying out encodings for every column, mostly of
    texts that all differ, would take about as long as making the rows, so there are none."""
    conf, key = df.sparkSession.conf, "spark.sql.inMemoryColumnarStorage.compressed"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        return df.persist()
    finally:
        conf.set(key, before)
