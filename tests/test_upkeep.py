"""Jobs beside a stream: nothing is lost or seen twice, whatever runs or stops at the same time."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensorloom import constants as C
from sensorloom.operators import outbox as O
from sensorloom.operators import readings as R
from sensorloom.operators import state as S
from sensorloom.plans import upkeep, views
from sensorloom.sources import sinks
from sensorloom.sources.messages import landed_messages
from sensorloom.streaming import aggregates as SA
from sensorloom.streaming import devices as SD
from sensorloom.streaming import routing, snapshots
from sensorloom.streaming.runs import run


def write(df, path, number, by_day=False, done=True):
    """One micro-batch's folder, or one that is still being written."""
    if by_day:
        sinks.overwrite_batch_by_day(df, path, number, 2)
    else:
        sinks.overwrite_batch(df, path, number)
    if not done:
        os.remove(f"{path}/batch_id={number}/_SUCCESS")


def counts(spark, n):
    return spark.range(n).select(F.lit("gw").alias("gateway_id")).groupBy("gateway_id").agg(
        *[F.count("*").alias(c) for c in ("version", "total_processed", "total_anomalies")],
        F.lit(None).cast("timestamp_ntz").alias("last_updated"),
    )


def total(spark, path):
    return S.sum_counters(snapshots.rows(spark, path, C.GATEWAY_STATE)).first().total_processed


def take(spark, path, **more):
    return snapshots.take(spark, path, C.GATEWAY_STATE, S.sum_counters, **more)


def same(a, b, *columns):
    return Counter(a.select(*columns).collect()) == Counter(b.select(*columns).collect())


def test_a_batch_in_progress_is_not_taken(spark, tmp_path):
    path = f"{tmp_path}/counters"
    write(counts(spark, 10), path, 0)
    write(counts(spark, 1), path, 1, done=False)
    assert take(spark, path, clear=True) == 0
    write(counts(spark, 5), path, 1)
    assert total(spark, path) == 15
    # Batch 3 is there before batch 2: it waits.
    write(counts(spark, 7), path, 3)
    assert take(spark, path, clear=True) == 1
    write(counts(spark, 3), path, 2)
    assert take(spark, path, clear=True) == 3 and total(spark, path) == 25


def test_two_takers_at_once(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/counters"
    for n in range(3):
        write(counts(spark, 10), path, n)
    put, met = snapshots.commit, []

    def other_first(spark, made, found):
        if not met:
            met.append(0)
            met.append(take(spark, path))
        return put(spark, made, found)

    monkeypatch.setattr(snapshots, "commit", other_first)
    assert take(spark, path, clear=True) == 2 and total(spark, path) == 30 and met == [0, 2]
    runs = [f for f in os.listdir(f"{path}_snapshots") if f.startswith("run=")]
    assert len(runs) == 1  # the loser's is gone
    # The other one takes less: both commits are whole, and the higher one counts.
    write(counts(spark, 10), path, 3)
    met.clear()
    before = snapshots.ready
    monkeypatch.setattr(snapshots, "ready", lambda *a, **k: before(*a, **k)[: 1 if met else None])
    write(counts(spark, 10), path, 4)
    assert take(spark, path) == 4 and total(spark, path) == 50 and met == [0, 3]


def test_a_reader_during_clearing(spark, tmp_path):
    path = f"{tmp_path}/counters"
    write(counts(spark, 10), path, 0)
    take(spark, path)
    write(counts(spark, 10), path, 1)
    reader = S.sum_counters(snapshots.rows(spark, path, C.GATEWAY_STATE))
    assert take(spark, path, clear=True) == 1
    assert reader.first().total_processed == 20 == total(spark, path)
    write(counts(spark, 10), path, 2)
    assert take(spark, path, clear=True) == 2 and total(spark, path) == 30
    assert sinks.folders(spark, path, "batch_id") == [2]


def test_an_earlier_state_can_be_read(spark, tmp_path):
    path = f"{tmp_path}/counters"
    for n in range(3):
        write(counts(spark, 10), path, n)
        take(spark, path, clear=True)
    for upto, expected in ((1, 20), (2, 30)):
        assert S.sum_counters(snapshots.rows(spark, path, C.GATEWAY_STATE, upto=upto)).first().total_processed == expected


def test_many_batches_become_few_files(spark, small, tmp_path):
    """200 batches of one day, another one in progress, a job that stops, and one that goes on."""
    out, day = str(tmp_path), small.select(*C.READING.fieldNames()).withColumn("timestamp", F.to_date("timestamp").cast("timestamp_ntz"))
    day = day.withColumn("timestamp", F.expr("TIMESTAMP_NTZ'2024-01-05 00:00:00'")).coalesce(1).cache()
    path, n = f"{out}/sensor_data", day.count()
    write(day, path, 0, by_day=True)
    for k in range(1, 200):
        os.system(f"cp -r {path}/batch_id=0 {path}/batch_id={k}")
    write(day, path, 200, by_day=True, done=False)
    stored = routing.stored_readings(spark, out, by_day=True)
    assert stored.count() == 200 * n and len(stored.inputFiles()) >= 200
    assert snapshots.compact(spark, path, C.READING, by_day=True, clear=True) == 199
    compacted = routing.stored_readings(spark, out, by_day=True)
    assert compacted.count() == 200 * n and len(compacted.inputFiles()) <= 16
    assert stored.count() == 200 * n  # a reader from before
    write(day, path, 200, by_day=True)
    assert routing.stored_readings(spark, out).count() == 201 * n
    routing.compact_rows(spark, out)
    for number in (201, 202):
        write(day, path, number, by_day=True)
        routing.compact_rows(spark, out)
    found = snapshots.newest(spark, f"{path}_snapshots")
    assert [r.batches for r in found.runs] == [200, 3]  # small runs were rewritten together
    assert routing.stored_readings(spark, out).count() == 203 * n
    assert sinks.folders(spark, path, "batch_id") == [202]
    bound = F.expr("TIMESTAMP_NTZ'2024-01-06 00:00:00'")
    assert sinks.since(routing.stored_readings(spark, out, by_day=True), bound).count() == 0


def test_files_are_sized_and_days_apart(spark, small, tmp_path):
    rows = small.select(*C.READING.fieldNames())
    sinks.write_sized(rows, f"{tmp_path}/a", True, file_rows=20)
    found = spark.read.parquet(f"{tmp_path}/a")
    files = found.select("day", F.input_file_name()).distinct().count()
    assert same(found, rows, *rows.columns) and files > found.select("day").distinct().count()
    sinks.write_sized(rows.limit(0), f"{tmp_path}/b", True)
    sinks.write_sized(rows.limit(0), f"{tmp_path}/c", False)
    without = rows.withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    sinks.write_sized(without, f"{tmp_path}/d", True)
    assert spark.read.parquet(f"{tmp_path}/d").count() == rows.count()


@pytest.mark.parametrize("step", ("write", "commit", "tidy", None))
def test_delivery_that_stops_after_each_step(spark, small, tmp_path, monkeypatch, step):
    out, flagged = str(tmp_path), R.anomalies(small).cache()
    for n in range(3):
        lines = O.to_lines(flagged.filter(F.col("id") % 3 == n))
        sinks.overwrite_batch_lines(lines.unionByName(lines.limit(2)), f"{out}/outbox", n)
    sinks.overwrite_batch_lines(O.to_lines(flagged.limit(1)), f"{out}/outbox", 3)
    os.remove(f"{out}/outbox/batch_id=3/_SUCCESS")
    expected = Counter(flagged.select(*routing.DELIVERED.fieldNames()).collect())
    for n in range(3):
        some = flagged.filter(F.col("id") % 3 == n).select(*routing.DELIVERED.fieldNames())
        expected.update(O.records(O.to_lines(some).limit(2)).collect())

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        if step == "write":
            patch.setattr(sinks, "write_sized", stop)
        elif step:
            patch.setattr(snapshots, step, stop)
        if step:
            with pytest.raises(RuntimeError):
                routing.deliver(spark, out)
    for _ in range(2):
        assert routing.deliver(spark, out) == 2
        assert Counter(routing.delivered(spark, out).collect()) == expected
        assert routing.undelivered(spark, out).count() == 0
    sinks.overwrite_batch_lines(O.to_lines(flagged.limit(1)), f"{out}/outbox", 3)
    assert routing.undelivered(spark, out).count() == 1
    assert routing.deliver(spark, out) == 3
    assert routing.delivered(spark, out).count() == sum(expected.values()) + 1
    assert sinks.folders(spark, f"{out}/outbox", "batch_id") == [3]


def test_nothing_to_deliver(spark, tmp_path):
    assert routing.deliver(spark, str(tmp_path)) is None
    assert routing.delivered(spark, str(tmp_path)).count() == routing.undelivered(spark, str(tmp_path)).count() == 0


def test_every_message_is_stored_or_rejected(spark, small, tmp_path):
    """Bad ones, some without a gateway, some of inactive devices, some that get no class."""
    messages = views.nameless_messages(small).cache()
    messages.repartition(3).write.parquet(f"{tmp_path}/landing")
    devices, out = views.devices(small), f"{tmp_path}/out"

    def half(readings):
        return readings.withColumn("classification", F.when(F.col("id") % 5 != 0, views.rule_class()))

    run(routing.route(landed_messages(spark, f"{tmp_path}/landing", 1), out, half, lambda _: devices), f"{out}/checkpoint")
    upkeep.upkeep(spark, out)
    stored, rejects = routing.stored_readings(spark, out), routing.stored_rejects(spark, out)
    assert same(stored.select("id").union(rejects.select("id")), messages, "id")
    assert same(rejects.join(messages.select("id", "value"), ["id", "value"]), rejects, "id")
    found = {r.reason for r in rejects.select("reason").distinct().collect()}
    assert {"missing_gateway_id", "inactive_device", "missing_classification", "malformed_json"} <= found
    assert stored.filter("id % 5 = 0 or id % 31 = 0").count() == 0
    assert routing.delivered(spark, out).count() == routing.stored_anomalies(spark, out).count()


def test_running_counters_go_on_after_a_stop(spark, small, tmp_path):
    """Five files, one run each, a snapshot between them, and a batch that is written again."""
    landing, out = f"{tmp_path}/landing", f"{tmp_path}/out"
    readings, expected, seen = small.select(*C.READING.fieldNames()), {}, Counter()
    for part in (3, 0, 4, 1, 2):
        some = readings.filter(F.col("id") % 5 == part)
        some.coalesce(1).write.mode("append").parquet(landing)
        run(SA.running_counters(spark.readStream.schema(C.READING).parquet(landing), out), f"{tmp_path}/checkpoint")
        for r in some.orderBy("timestamp", "id").collect():
            seen[r.gateway_id] += 1
            seen[r.gateway_id, "anomalies"] += r.classification == C.ANOMALY
            n, flagged = seen[r.gateway_id], seen[r.gateway_id, "anomalies"]
            expected[r.id] = (r.id, r.gateway_id, r.timestamp, n, n, flagged)
        if part in (0, 1):
            SA.compact_running_counters(spark, out)
    found = SA.read_running_counters(spark, out).collect()
    assert sorted(tuple(r) for r in found) == [expected[i] for i in sorted(expected)]
    # The last batch again: a snapshot has taken it meanwhile, but it starts from the one before.
    SA.compact_running_counters(spark, out)
    assert SA.counters_before(spark, out, 4).agg(F.sum("version")).first()[0] == readings.filter("id % 5 != 2").count()


def test_one_row_for_a_device_that_two_batches_ask_for(spark, tmp_path):
    from datetime import datetime

    def at(day):
        return datetime(2024, 1, day)

    late = [(9, "register", 5, at(9)), (8, "toggle", 5, at(8)), (7, "register", 6, at(7)), (6, "toggle", 4, at(6))]
    early = [(1, "register", 5, at(1)), (2, "register", 5, at(2)), (3, "register", -1, at(3)), (4, "other", 8, at(4))]
    out, landing = f"{tmp_path}/out", f"{tmp_path}/landing"
    for k, some in enumerate((late, early, [(10, "toggle", 6, at(10)), (11, "toggle", 6, at(10)), (12, None, None, None)])):
        spark.createDataFrame(some, SD.REQUEST).coalesce(1).write.mode("append").parquet(landing)
        run(SD.apply_requests(spark.readStream.schema(SD.REQUEST).parquet(landing), out), f"{tmp_path}/checkpoint")
        if k:
            SD.compact_devices(spark, out)
    found = {r.id: r for r in SD.stored_devices(spark, out, "salt").collect()}
    assert {i: (r.device_id, r.active, r.registered_at) for i, r in found.items()} == {
        5: ("sensor_5", False, at(1)),
        6: ("sensor_6", True, at(7)),
    }
    assert len({r.api_key for r in found.values()}) == 2
