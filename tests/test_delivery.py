"""Outbox, logs and repeated delivery."""

from pyspark.sql import functions as F

from conftest import SMALL
from sensorloom import constants as C
from sensorloom.operators import outbox as O
from sensorloom.operators import readings as R
from sensorloom.plans import views
from sensorloom.sources import sinks
from sensorloom.sources.tables import scan_events


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_acknowledged_lines_go_with_all_copies(spark):
    left = O.pending(lines(spark, "a", "b", "b ", "c", "c"), lines(spark, "b"))
    assert sorted(r.value for r in left.collect()) == ["a", "c", "c"]


def test_acknowledging_nothing_and_everything(spark):
    box = lines(spark, "a", "b")
    assert O.pending(box, lines(spark).filter("false")).count() == 2
    assert O.pending(box, box).count() == 0


def test_replay_gives_back_the_records(spark, small):
    flagged = R.anomalies(small)
    box = O.to_lines(flagged)
    replayed = O.replay(box.union(box), lines(spark))
    assert {r.copies for r in replayed.collect()} == {2}
    back = replayed.drop("copies")
    assert sorted(back.collect()) == sorted(flagged.select(*back.columns).collect())


def test_replay_counts_before_it_joins(spark, small):
    """A text with many copies is one row before the join."""
    plan = O.replay(views.outbox_lines(small), views.delivered_lines(scan_events(spark, SMALL)))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join LeftOuter") < text.index("Aggregate")


def test_redelivered_anomalies_are_dropped(medium):
    flagged = R.anomalies(medium)
    assert views.redelivered_anomalies(medium).count() > flagged.count()
    assert sorted(O.deduplicated(views.redelivered_anomalies(medium)).collect()) == sorted(flagged.collect())


def test_repeated_batch_leaves_no_second_copy(spark, small, tmp_path):
    path = str(tmp_path / "out")
    for _ in range(2):
        sinks.overwrite_batch(small, path, 0)
    sinks.overwrite_batch(small.limit(10), path, 1)
    assert sinks.read_batches(spark, path, C.READING).count() == small.count() + 10


def test_reading_batches_that_were_never_written(spark, tmp_path):
    assert sinks.read_batches(spark, str(tmp_path / "none"), C.READING).count() == 0
    assert sinks.read_batch_lines(spark, str(tmp_path / "none")).count() == 0


def test_appended_logs_are_laid_out_by_day(spark, small, tmp_path):
    path = str(tmp_path / "logs")
    logs = R.log_rows(small)
    sinks.append_by_day(logs, path)
    stored = spark.read.parquet(path)
    assert stored.count() == logs.count()
    day = stored.filter(F.col("day") == F.lit("2024-01-05").cast("date"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert 0 < day.count() < logs.count()
