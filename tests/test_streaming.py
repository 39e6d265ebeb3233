"""Streams: equal to their batch form, over several batches, after restarts and replays."""

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from sensorloom import constants as C
from sensorloom.ml import forest, isolation, registry
from sensorloom.operators import aggregates as A
from sensorloom.operators import outbox as O
from sensorloom.operators import readings as R
from sensorloom.operators import state as S
from sensorloom.operators import validation as V
from sensorloom.plans import catalog, live, views
from sensorloom.session import cached, spread
from sensorloom.sources import sinks
from sensorloom.sources.messages import from_kafka, landed_messages
from sensorloom.sources.tables import EVENTS, scan_events, stream_events
from sensorloom.streaming import aggregates as SA
from sensorloom.streaming import model_switch, routing, snapshots
from sensorloom.streaming.runs import run, start


def by_rule(readings):
    return readings.withColumn("classification", views.rule_class())


@pytest.fixture(scope="module")
def landing(spark, small, tmp_path_factory):
    """The raw messages in five files."""
    path = str(tmp_path_factory.mktemp("landing") / "messages")
    views.raw_messages(small).repartition(5).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def expected(small):
    return by_rule(V.valid_messages(views.raw_messages(small))).select(*C.READING.fieldNames()).cache()


def rows(df, *columns):
    return sorted(df.select(*columns).collect() if columns else df.collect(), key=str)


def test_routing_over_several_batches(spark, landing, expected, tmp_path):
    out = str(tmp_path)
    run(routing.route(landed_messages(spark, landing, 1), out, by_rule), f"{out}/checkpoint")
    columns = C.READING.fieldNames()
    stored = sinks.read_batches(spark, f"{out}/sensor_data", C.READING, with_batch=True)
    assert stored.select("batch_id").distinct().count() == 5
    assert rows(routing.stored_readings(spark, out), *columns) == rows(expected, *columns)
    assert rows(routing.stored_anomalies(spark, out), *columns) == rows(R.anomalies(expected), *columns)
    assert routing.stored_outbox(spark, out).count() == R.anomalies(expected).count()
    assert rows(routing.stored_counters(spark, out)) == rows(S.current_counters(expected))


def test_routing_goes_on_after_a_stop(spark, small, expected, tmp_path):
    """Two runs with one checkpoint give what one run gives, and a third adds nothing."""
    out, landing = f"{tmp_path}/out", f"{tmp_path}/landing"
    messages = views.raw_messages(small)
    for part in (F.col("id") < 500, F.col("id") >= 500, F.lit(False)):
        messages.filter(part).write.mode("append").parquet(landing)
        run(routing.route(landed_messages(spark, landing), out, by_rule), f"{out}/checkpoint")
    columns = C.READING.fieldNames()
    assert rows(routing.stored_readings(spark, out), *columns) == rows(expected, *columns)
    assert rows(routing.stored_counters(spark, out)) == rows(S.current_counters(expected))


def test_a_failed_batch_is_replayed_without_copies(spark, landing, expected, tmp_path):
    """The scorer fails once, after the batch before was stored."""
    out = str(tmp_path)
    calls = []

    def failing(readings):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return by_rule(readings)

    with pytest.raises(Exception, match="lost"):
        run(routing.route(landed_messages(spark, landing, 1), out, failing), f"{out}/checkpoint")
    run(routing.route(landed_messages(spark, landing, 1), out, failing), f"{out}/checkpoint")
    columns = C.READING.fieldNames()
    assert rows(routing.stored_readings(spark, out), *columns) == rows(expected, *columns)
    assert routing.stored_outbox(spark, out).count() == R.anomalies(expected).count()


def test_routing_can_leave_out_inactive_devices(spark, small, landing, expected, tmp_path):
    out = str(tmp_path)
    devices = views.devices(small)
    run(routing.route(landed_messages(spark, landing), out, by_rule, lambda _: devices), f"{out}/checkpoint")
    allowed = expected.join(devices.filter("active"), "device_id", "left_semi")
    stored = routing.stored_readings(spark, out)
    assert rows(stored, "id") == rows(allowed, "id")
    assert 0 < stored.count() < expected.count()


def test_counters_and_rate_over_several_batches(spark, landing, expected, tmp_path):
    def scored():
        return by_rule(V.valid_messages(landed_messages(spark, landing, 1)))

    run(SA.counters(scored(), f"{tmp_path}/c"), f"{tmp_path}/c-checkpoint")
    assert rows(SA.read_counters(spark, f"{tmp_path}/c")) == rows(S.current_counters(expected))
    run(SA.anomaly_rate(scored(), f"{tmp_path}/r"), f"{tmp_path}/r-checkpoint")
    assert rows(SA.read_anomaly_rate(spark, f"{tmp_path}/r")) == rows(A.anomaly_rate(expected))


def test_minutes_over_several_batches_newest_first(spark, small, tmp_path):
    """No row is too late, and compaction between the batches changes nothing."""
    landing, out = f"{tmp_path}/landing", f"{tmp_path}/out"
    for part in (2, 0, 1):
        chosen = small.filter(F.col("id").between(part * 400, part * 400 + 399))
        chosen.coalesce(1).write.mode("append").parquet(landing)
        run(SA.per_minute(spark.readStream.schema(C.READING).parquet(landing), out), f"{tmp_path}/checkpoint")
        SA.compact_minutes(spark, out, clear=part == 0)
    assert rows(SA.read_per_minute(spark, out)) == rows(A.per_minute(small))
    assert SA.read_per_minute(spark, out).agg(F.sum("processed_data")).first()[0] == small.count()


def test_finished_days_are_not_written_again(spark, medium, tmp_path):
    """Late rows of a finished day are corrections in a run of their own."""
    path, day = f"{tmp_path}/minutes", F.to_date("timestamp")
    late = F.col("id") % 100 == 0
    numbers = [medium.filter(~late & (F.dayofmonth("timestamp") % 6 == k)) for k in range(6)]
    for k, some in enumerate(numbers):
        sinks.overwrite_batch(A.by_minute(some, "n"), path, k)
    SA.compact_minutes(spark, path)
    before = sorted(snapshots.newest(spark, snapshots.made_of(path)).runs)
    sinks.overwrite_batch(A.by_minute(medium.filter(late), "n"), path, 6)
    SA.compact_minutes(spark, path)
    after = snapshots.newest(spark, snapshots.made_of(path)).runs
    assert after[0] == before[0] and len(after) == 2
    assert rows(SA.read_per_minute(spark, path)) == rows(A.per_minute(medium))
    first = F.expr("DATE'2024-01-20'")
    expected = A.per_minute(medium.filter(day >= first))
    found = SA.read_per_minute(spark, path, first=medium.select(first).first()[0])
    assert rows(found) == rows(expected)
    assert "PartitionFilters: [isnotnull(day" in found._jdf.queryExecution().executedPlan().toString()


def test_snapshots_half_done_or_taken_again(spark, small, tmp_path):
    path = f"{tmp_path}/counts"
    counts = A.by_minute(small, "n")
    sinks.overwrite_batch(counts, path, 0)
    sinks.overwrite_batch(counts, path, 1)
    expected = rows(SA.read_per_minute(spark, path))

    def take(clear=False):
        return snapshots.take(spark, path, SA.MINUTE_ROW, SA.sum_minutes, clear=clear)

    # A run that no commit names isn't looked at.
    counts.write.parquet(f"{path}_snapshots/run=1-lost")
    assert rows(SA.read_per_minute(spark, path)) == expected
    assert take() == 1 and take() == 1
    assert rows(SA.read_per_minute(spark, path)) == expected
    # A micro-batch that is replayed after the snapshot took it is counted once.
    sinks.overwrite_batch(counts, path, 1)
    assert rows(SA.read_per_minute(spark, path)) == expected
    # What the snapshot before the newest one stands for goes; the others stay for its readers.
    sinks.overwrite_batch(counts, path, 2)
    assert take(clear=True) == 2
    assert sinks.folders(spark, path, "batch_id") == [2]
    assert sum(r.processed_data for r in SA.read_per_minute(spark, path).collect()) == 3 * small.count()
    assert snapshots.take(spark, f"{tmp_path}/none", SA.MINUTE_ROW, SA.sum_minutes) is None


def test_odd_messages_do_not_stop_the_live_job(spark, small, tmp_path):
    good = views.raw_messages(small.filter("id between 1 and 20"))
    odd = [
        (1000, "gw_0", '{"device_id":"d","temperature":"nan","humidity":1,"timestamp":"2024-01-01T00:00:00"}'),
        (1001, "gw_0", '{"device_id":"d","temperature":1,"humidity":-1e999,"timestamp":"2024-01-01T00:00:00"}'),
        (1002, "gw_0", None),
        (1003, "gw_0", '{"device_id":"d","temperature":NaN,"humidity":1,"timestamp":"2024-01-01T00:00:00"}'),
    ]
    good.unionByName(spark.createDataFrame(odd, C.RAW_MESSAGE)).coalesce(1).write.parquet(f"{tmp_path}/landing")
    root, edge = f"{tmp_path}/models", isolation.train(small)
    for step in range(2):  # with the edge model, then with a forest
        out = f"{tmp_path}/out{step}"
        live.run_live(landed_messages(spark, f"{tmp_path}/landing"), out, root, edge, interval=None).awaitTermination()
        assert routing.stored_readings(spark, out).count() == 20
        found = {r.id: r.reason for r in routing.stored_rejects(spark, out).collect()}
        assert found.keys() == {1000, 1001, 1002, 1003}
        assert (found[1000], found[1001], found[1002]) == ("bad_temperature", "bad_humidity", "malformed_json")
        assert rows(routing.published_state(spark, out)) == rows(routing.stored_counters(spark, out))
        registry.publish(spark, forest.train(small), root)


def test_kafka_records(spark):
    """Equal offsets in two partitions, and bytes that are no text."""
    records = spark.createDataFrame(
        [(0, 5, bytearray(b"a")), (1, 5, bytearray(b"b")), (1, 6, bytearray(b"\xff\xfe"))],
        "partition int, offset long, value binary",
    )
    found = from_kafka(records).collect()
    assert len({r.id for r in found}) == 3
    assert [(r.gateway_id, r.value) for r in found] == [("gw_0", "a"), ("gw_1", "b"), ("gw_1", None)]


def test_devices_added_while_the_stream_runs(spark, small, tmp_path):
    """The device table is read anew for every micro-batch."""
    table, out, landing = f"{tmp_path}/devices", f"{tmp_path}/out", f"{tmp_path}/landing"
    devices = views.devices(small).withColumn("active", F.lit(True))
    one = devices.orderBy("id").limit(1)
    one.write.parquet(table)
    messages = views.raw_messages(small)
    for part in range(2):
        messages.filter(F.col("id") % 2 == part).coalesce(1).write.mode("append").parquet(landing)
        stream = routing.route(landed_messages(spark, landing), out, by_rule, lambda s: s.read.parquet(table))
        run(stream, f"{out}/checkpoint")
        devices.join(one.select("device_id"), "device_id", "left_anti").write.mode("append").parquet(table)
    valid = V.valid_messages(messages)
    first = one.first().device_id
    expected = valid.filter((F.col("id") % 2 == 1) | (F.col("device_id") == first)).count()
    assert routing.stored_readings(spark, out).count() == expected


def test_live_outbox_is_cleared_and_resent(spark, landing, expected, tmp_path):
    out = str(tmp_path)
    run(routing.route(landed_messages(spark, landing, 1), out, by_rule), f"{out}/checkpoint")
    flagged = R.anomalies(expected)
    delivered = O.to_lines(flagged.filter("id % 2 = 0"))
    left = flagged.filter("id % 2 = 1").count()
    assert routing.resend(spark, out, delivered).count() == left
    for _ in range(2):
        routing.clear_outbox(spark, out, delivered, clear=True)
        assert routing.stored_outbox(spark, out).count() == left


def test_merge_stream_in_any_file_order(spark, small, tmp_path):
    updates = views.state_updates(small)
    updates.repartition(5).write.parquet(f"{tmp_path}/landing")
    arriving = spark.readStream.schema(C.STATE_UPDATE).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/landing")
    run(SA.merge_state(arriving, f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    assert rows(SA.read_state(spark, f"{tmp_path}/out")) == rows(S.merge_updates(updates))


def test_redelivered_rows_of_later_batches_are_dropped(spark, medium, tmp_path):
    """Copies come in a file of their own, older rows after newer ones; none is lost."""
    flagged = R.anomalies(medium)
    landing = f"{tmp_path}/landing"
    newer = F.col("timestamp") >= F.expr("TIMESTAMP_NTZ'2024-01-20 00:00:00'")
    for part in (newer, ~newer, F.col("id") < 5000):
        flagged.filter(part).coalesce(1).write.mode("append").parquet(landing)
    arriving = spark.readStream.schema(C.READING).option("maxFilesPerTrigger", 1).parquet(landing)
    run(routing.store_deliveries(arriving, f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    stored = routing.delivered_once(spark, f"{tmp_path}/out")
    assert rows(stored, *C.READING.fieldNames()) == rows(flagged, *C.READING.fieldNames())


def test_table_of_many_files_can_be_streamed(spark, tmp_path):
    """The events table may be a folder of part files instead of one file."""
    events = scan_events(spark, SMALL)
    events.repartition(4).write.parquet(f"{tmp_path}/data/events.parquet")
    folder = f"{tmp_path}/data"
    assert rows(scan_events(spark, folder)) == rows(events)
    stream = stream_events(spark, folder, files_per_batch=2)
    run(stream.writeStream.format("parquet").option("path", f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    assert rows(spark.read.schema(EVENTS).parquet(f"{tmp_path}/out")) == rows(events)


def test_model_switch_and_live_job(spark, small, landing, expected, tmp_path):
    """A version published while the stream runs is used from the next batch on."""
    root, out = f"{tmp_path}/models", f"{tmp_path}/out"
    model = forest.train(small)
    edge = isolation.train(small)
    newest = model_switch.NewestModel(root, edge, check_seconds=0)
    published = []

    class Publishing:
        def __call__(self, readings):
            if newest.version == 0 and published == [0]:
                published.append(registry.publish(spark, model, root).version)
            elif not published:
                published.append(0)
            return newest(readings)

    arriving = V.valid_messages(landed_messages(spark, landing, 1))
    run(model_switch.score_with_newest(arriving, out, Publishing()), f"{out}-checkpoint")
    scored = model_switch.read_scored(spark, out)
    assert scored.count() == expected.count()
    versions = {(r.model_type, r.model_version) for r in scored.select("model_type", "model_version").collect()}
    assert versions == {("isolation_forest", 0), ("random_forest", 1)}
    second = scored.filter("model_version = 1")
    by_forest = forest.score(model, expected).join(second.select("id"), "id", "left_semi")
    assert rows(second, "id", "classification") == rows(by_forest, "id", "classification")

    live_out = f"{tmp_path}/live"
    live.run_live(landed_messages(spark, landing), live_out, root, edge, interval=None).awaitTermination()
    stored = routing.stored_readings(spark, live_out)
    assert rows(stored, "id", "classification") == rows(forest.score(model, expected), "id", "classification")


def test_running_on_an_interval(spark, landing, tmp_path):
    query = start(routing.ingest(landed_messages(spark, landing), f"{tmp_path}/out"), f"{tmp_path}/c", C.SCORING_INTERVAL)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(f"{tmp_path}/out").count() > 0


def test_rows_of_one_row_group_are_dealt_to_all_cores(spark, medium, tmp_path):
    """Cut by bytes, the file has a partition for every core, and all rows in one of them."""
    path = f"{tmp_path}/messages"
    views.raw_messages(medium).coalesce(1).write.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "messages").glob("*.parquet"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size // 10)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        cut = spark.read.schema(C.RAW_MESSAGE).parquet(path)
        assert cut.rdd.getNumPartitions() >= 8
        dealt = spread(cut).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(dealt) == 8 and max(r["count"] for r in dealt) <= 1.5 * min(r["count"] for r in dealt)


def test_landed_files_are_work_for_all_cores(spark, medium, tmp_path):
    """Also where all readings come out of one file, and for steps as of larger tables."""
    next(catalog._landed_halves(spark, MEDIUM, f"{tmp_path}/halves"))
    assert len(list((tmp_path / "halves/landing").glob("*.parquet"))) == 8
    assert catalog.LANDED_ROWS <= 100_000
    landing = catalog._landed(spark, medium, f"{tmp_path}/steps", views.raw_messages)
    files = len(list((tmp_path / "steps").glob("*.parquet")))
    assert files == landing.files * catalog.FILES and spark.read.parquet(landing.path).count() == medium.count()


def test_micro_batches_are_kept_without_encodings(spark):
    """A column of one value is encoded into next to nothing, which takes a pass over the rows."""
    before = spark.conf.get("spark.sql.inMemoryColumnarStorage.compressed")
    kept = cached(spark.range(200_000).select(F.lit(7).cast("long").alias("same")))
    try:
        assert kept.count() == 200_000
        kinds = spark.sparkContext._jsc.sc().getRDDStorageInfo()
        assert max(k.memSize() + k.diskSize() for k in kinds) >= 8 * 200_000
        assert spark.conf.get("spark.sql.inMemoryColumnarStorage.compressed") == before
    finally:
        kept.unpersist()


def test_model_switch_makes_its_readings_once(spark, monkeypatch):
    """Both trainings and the landing read a written table, not the events anew."""
    found = []

    def landed(spark, folder, base, readings=None):
        found.append(readings)
        raise StopIteration

    monkeypatch.setattr(catalog, "_edge_model", found.append)
    monkeypatch.setattr(catalog, "_landed_halves", landed)
    with pytest.raises(StopIteration):
        catalog._stream_model_switch(spark, SMALL)
    assert len(found) == 2 and all("events.parquet" not in f for r in found for f in r.inputFiles())
    assert found[0].exceptAll(views.load(spark, SMALL)).isEmpty() and found[0].count() == views.load(spark, SMALL).count()


def test_scales_agree(spark):
    assert scan_events(spark, MEDIUM).count() == 10 * scan_events(spark, SMALL).count()
