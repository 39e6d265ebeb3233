"""Plans: what is read, pushed down, shuffled and broadcast."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import MEDIUM
from sensorloom.operators import aggregates as A
from sensorloom.operators import outbox as O
from sensorloom.operators import readings as R
from sensorloom.operators import validation as V
from sensorloom.operators.running import number_of_slices
from sensorloom.plans import catalog, views
from sensorloom.sources import sinks
from sensorloom.sources.tables import jdbc_options, scan_table
from sensorloom import constants as C


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, medium, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "sensor_data")
    medium.write.parquet(path)
    return scan_table(spark, path, C.READING)


def test_stored_table_reads_only_what_is_asked(stored):
    text = plan(A.anomaly_rate(stored))
    assert "ReadSchema: struct<gateway_id:string,classification:string>" in text
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


def test_filters_reach_the_scan(stored):
    text = plan(A.per_minute(R.anomalies(stored), "anomalies"))
    assert "PushedFilters: [IsNotNull(classification), EqualTo(classification,ANOMALY)]" in text
    assert "EqualTo(gateway_id,gw_1)" in plan(A.per_gateway(R.of_gateway(stored, "gw_1")))
    assert "GreaterThanOrEqual(timestamp,ScalarSubquery" in plan(R.recent(stored))


def test_top_rows_need_no_sort_of_the_table(stored):
    assert "TakeOrderedAndProject" in plan(R.recent_logs(R.log_rows(stored)))
    assert "TakeOrderedAndProject" in plan(R.scatter_sample(stored))


def test_trend_sort_can_split_one_moment(stored):
    assert "rangepartitioning(time" in plan(R.trend(stored, "temperature"))
    assert "id#" in plan(R.trend(stored, "temperature")).split("rangepartitioning(")[1].split(")")[0]


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - catalog.RUN_ONCE))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, MEDIUM))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in text


def test_running_counters_window_is_by_slice(spark):
    text = plan(entry.queries()["running_counters"](spark, MEDIUM))
    assert "Exchange hashpartitioning(gateway_id" in text and "_slice" in text
    assert "Exchange SinglePartition" not in text


def test_slices_follow_the_size(spark, medium):
    least = spark.sparkContext.defaultParallelism
    assert number_of_slices(medium) == least
    assert number_of_slices(medium, 10_000) > least
    assert number_of_slices(medium.limit(0)) == least


def test_time_filter_skips_days_of_a_stored_table(spark, medium, tmp_path):
    sinks.overwrite_batch_by_day(medium, f"{tmp_path}/sensor_data", 0)
    stored = sinks.read_batches(spark, f"{tmp_path}/sensor_data", C.READING, by_day=True)
    text = plan(R.recent(stored))
    assert "PartitionFilters: [isnotnull(day" in text and "GreaterThanOrEqual(timestamp,ScalarSubquery" in text
    newest = R.recent(stored).select(*C.READING.fieldNames())
    assert sorted(newest.collect()) == sorted(R.recent(medium).collect())


def test_jdbc_options():
    options = jdbc_options("jdbc:postgresql://db/iot", "sensor_data", 1, 1000, 16, user="u")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "16"
    assert (options["lowerBound"], options["upperBound"], options["user"]) == ("1", "1000", "u")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", 5, 1, 4)



def test_views_have_the_table_schemas(spark):
    readings = views.load(spark, MEDIUM)
    assert readings.dtypes == [(f.name, f.dataType.simpleString()) for f in C.READING]
    assert views.gateway_state(readings).dtypes == [(f.name, f.dataType.simpleString()) for f in C.GATEWAY_STATE]
    assert views.raw_messages(readings).dtypes == [(f.name, f.dataType.simpleString()) for f in C.RAW_MESSAGE]


def test_total_is_taken_from_the_footers(spark):
    found = catalog.queries()["total_records"](spark, MEDIUM)
    assert "PushedAggregation: [COUNT(*)]" in plan(found) and found.first().total_records == 10_000
    assert "BatchScan" not in plan(views.load(spark, MEDIUM))


@pytest.fixture(scope="module")
def by_day(spark, medium, tmp_path_factory):
    """Readings by day, three of them from a day apart, and a newest folder without rows."""
    path = str(tmp_path_factory.mktemp("by_day") / "logs")
    late = medium.filter("id < 3").withColumn("timestamp", F.expr("TIMESTAMP_NTZ'2024-02-05 10:00:00'"))
    logs = R.log_rows(medium.filter("id >= 3").unionByName(late))
    sinks.append_by_day(logs.unionByName(logs.limit(2).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))), path)
    empty = logs.limit(0).coalesce(1).write
    empty.parquet(f"{path}/day=2024-02-09")
    return path, logs


def test_newest_logs_read_one_or_two_days(spark, by_day):
    path, logs = by_day
    days, stored = sinks.days(spark, path), spark.read.parquet(path)
    assert len(days) == 32 and str(days[0]) == "2024-02-09"
    found = R.recent_logs_stored(stored, days).select(*logs.columns)
    assert found.collect() == R.recent_logs(logs).collect()
    assert "PartitionFilters: [isnotnull(day" in plan(found) and ">= 2024-01-30" in plan(found)
    # Counting goes on until there are enough rows, or no day is left.
    assert R.first_day_of(stored, days, 3) == days[1] and R.first_day_of(stored, days, 4) == days[2]
    assert R.first_day_of(stored, days, logs.count()) == days[-1] and R.first_day_of(stored, days, 10**6) is None
    assert R.recent_logs_stored(stored, days, 10**6).count() == logs.count() + 2


def test_newest_time_is_read_from_one_day(spark, by_day):
    path, logs = by_day
    stored, days = spark.read.parquet(path), sinks.days(spark, path)
    found = R.recent_stored(stored, days)
    assert sorted(found.select(*logs.columns).collect()) == sorted(R.recent(logs).collect())
    assert len({f.rpartition("/")[0] for f in found.inputFiles()}) > 2  # files are pruned when it runs:
    assert "PartitionFilters: [isnotnull(day" in plan(found) and "2024-02-05" in plan(found)
    assert R.recent_stored(stored, []).count() == 0


def test_decoding_is_compiled(spark, stored):
    """The JVM leaves methods over 8,000 bytes to its interpreter."""
    messages = stored.select("id", "gateway_id", F.col("device_id").alias("value"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (V.decode_messages(messages), O.records(messages.select("value"))):
            made = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package")
            made = made.codegenStringSeq(df._jdf.queryExecution().executedPlan())
            assert max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
