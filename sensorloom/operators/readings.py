"""Projections, filters and top-n reports over readings and logs."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom import constants as C
from sensorloom.functions import expressions as E
from sensorloom.sources.sinks import since


def enrich(readings: DataFrame, gateway: Column, classification: Column) -> DataFrame:
    """Add the handling gateway and the class to a reading."""
    return readings.withColumns({"gateway_id": gateway, "classification": classification})


def anomalies(readings: DataFrame) -> DataFrame:
    return readings.filter(E.is_anomaly())


def of_gateway(readings: DataFrame, gateway_id: str) -> DataFrame:
    return readings.filter(F.col("gateway_id") == gateway_id)


def recent(readings: DataFrame, look_back: str = C.LOOK_BACK, as_of: Column | None = None) -> DataFrame:
    """Readings of the last ``look_back`` before ``as_of``, by default the newest reading.

    The newest time is a scalar subquery, so the bound still reaches the parquet scan, and
    the folders of a table laid out by day.
    """
    if as_of is None:
        newest = readings.agg(F.max("timestamp").alias("newest"))
        bound = newest.select(F.col("newest") - F.expr(f"INTERVAL {look_back}")).scalar()
        return since(readings, bound)
    bound = as_of - F.expr(f"INTERVAL {look_back}")
    return since(readings, bound).filter(F.col("timestamp") <= as_of)


def trend(readings: DataFrame, measure: str) -> DataFrame:
    """Time series of one measure, in time order, times cut to the millisecond.

    The id as second sort key lets a moment with very many readings be split over
    several ranges of the sort.
    """
    return (
        readings.select(E.truncated("millisecond").alias("time"), measure, "id")
        .orderBy("time", "id")
        .select("time", measure)
    )


def labelled(readings: DataFrame) -> DataFrame:
    return readings.withColumn("label", E.label())


def bands(readings: DataFrame, measures: tuple[str, ...] = C.FEATURES) -> DataFrame:
    """Number of readings per measure and band, in one pass: counts per combination of
    bands first (a handful of rows), then one row per measure and band."""
    combined = readings.select(*[E.band(m).alias(m) for m in measures]).groupBy(*measures).agg(
        F.count("*").alias("n")
    )
    return (
        combined.select(
            F.explode(
                F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("band")) for m in measures])
            ).alias("b"),
            "n",
        )
        .groupBy("b.measure", "b.band")
        .agg(F.sum("n").alias("readings"))
    )


def log_rows(readings: DataFrame) -> DataFrame:
    """One log row per reading: the gateway reports the device and its class."""
    return readings.select(
        "id", F.col("gateway_id").alias("source"), E.log_message().alias("message"), "timestamp"
    )


def recent_logs(logs: DataFrame, rows: int = C.RECENT_LOG_ROWS) -> DataFrame:
    """The newest log rows first; each task keeps only ``rows`` candidates."""
    return logs.orderBy(F.desc("timestamp"), F.desc("id")).limit(rows)


def newest_time(stored: DataFrame, days: list[date]):
    """The newest time in a table laid out by day, out of the newest day that holds any."""
    for day in days:
        newest = stored.filter(F.col("day") == F.lit(day)).agg(F.max("timestamp")).first()[0]
        if newest is not None:
            return newest
    return None


def recent_stored(stored: DataFrame, days: list[date], look_back: str = C.LOOK_BACK) -> DataFrame:
    """``recent`` over a table laid out by day, whose ``days`` are known from its folders, the
    newest first: the time that it counts back from is read from the newest of them, and older
    days than the bound's are not looked at."""
    newest = newest_time(stored, days)
    if newest is None:
        return stored.limit(0)
    return since(stored, F.lit(newest) - F.expr(f"INTERVAL {look_back}"))


def first_day_of(stored: DataFrame, days: list[date], rows: int) -> date | None:
    """The day from which on the newest ``rows`` rows lie; None if there are fewer in all. Days
    are counted from the newest on, twice as many at a time; a count reads no column."""
    looked, n = 0, 0
    while looked < len(days):
        some = days[looked : max(2, 2 * looked)]
        inside = stored.filter(F.col("day").between(F.lit(some[-1]), F.lit(some[0])))
        counts = {r["day"]: r["count"] for r in inside.groupBy("day").count().collect()}
        for day in some:
            n += counts.get(day, 0)
            if n >= rows:
                return day
        looked += len(some)
    return None


def recent_logs_stored(stored: DataFrame, days: list[date], rows: int = C.RECENT_LOG_ROWS) -> DataFrame:
    """``recent_logs`` over a table laid out by day: only the newest days that hold ``rows`` rows
    are read, mostly one."""
    first = first_day_of(stored, days, rows)
    return recent_logs(stored if first is None else stored.filter(F.col("day") >= F.lit(first)), rows)


def scatter_sample(readings: DataFrame, rows: int = C.SCATTER_ROWS) -> DataFrame:
    """Temperature and humidity pairs for the scatter panel, the first by id."""
    return readings.select("id", *C.FEATURES).orderBy("id").limit(rows).select(*C.FEATURES)
