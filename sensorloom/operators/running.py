"""Running totals per key that do not put a whole key into one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.operators.joins import measured_bytes
from sensorloom.session import write_table

#: Values of one slice, about: what one task sorts.
SLICE_BYTES = 128 * 1024 * 1024


def number_of_slices(df: DataFrame, slice_bytes: int = SLICE_BYTES) -> int:
    """Slices by the size of the values, at least one for each core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-measured_bytes(df) // slice_bytes))


def running_totals(
    df: DataFrame, key: str, order: list[str], measures: dict[str, Column], slices: int | None = None
) -> DataFrame:
    """Add, for every row, the running sum of each measure over the rows of its key.

    A window over the key alone would sort a gateway with a third of all rows in one
    task. Here the rows are cut into slices of about equal size by range of (key,
    order); ``order`` has to be unique within a key. Sums are taken inside a slice, and
    the totals of the slices before it are added. The cut is written once, as both
    steps must see the same slices.
    """
    prepared = df.withColumns({f"_{name}": measure for name, measure in measures.items()})
    slices = slices or number_of_slices(prepared)
    cut = write_table(
        prepared.repartitionByRange(slices, key, *order)
        .withColumn("_slice", F.spark_partition_id()),
        "slices",
    )

    # One row per slice and key: small, at most slices + keys rows.
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        cut.groupBy(key, "_slice")
        .agg(*[F.sum(f"_{name}").alias(f"_{name}") for name in measures])
        .select(
            key,
            "_slice",
            *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}") for name in measures],
        )
    )

    inside = Window.partitionBy(key, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.withColumns({name: F.sum(f"_{name}").over(inside) for name in measures})
        .join(before, [key, "_slice"])
        .withColumns({name: F.col(name) + F.col(f"_before_{name}") for name in measures})
        .select(*df.columns, *measures)
    )
