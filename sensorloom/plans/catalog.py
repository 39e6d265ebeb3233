"""All queries by name: each takes a session and a data folder and gives a DataFrame."""

from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom import constants as C
from sensorloom.functions import expressions as E
from sensorloom.ml import forest, isolation, registry, scoring
from sensorloom.operators import aggregates as A
from sensorloom.operators import devices as D
from sensorloom.operators import outbox as O
from sensorloom.operators import readings as R
from sensorloom.operators import state as S
from sensorloom.operators import validation as V
from sensorloom.plans import views
from sensorloom.plans.retraining import retrain
from sensorloom.session import spread, work_dir, write_table
from sensorloom.sources import sinks
from sensorloom.sources.messages import bounded, landed_messages
from sensorloom.sources.tables import EVENTS, scan_events, scan_to_count, stream_events
from sensorloom.streaming import aggregates as SA
from sensorloom.streaming import devices as SD
from sensorloom.streaming import model_switch, routing
from sensorloom.streaming.runs import run

Query = Callable[[SparkSession, str], DataFrame]

GATEWAY = "gw_1"
SALT = "sensorloom"


def _on_readings(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: f(views.load(spark, folder))


def _on_state(f: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_readings(lambda r: f(views.gateway_state(r)))


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    return views.sensor_data(stream_events(spark, folder))


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return views.raw_messages(_stream(spark, folder))


def _by_rule(readings: DataFrame) -> DataFrame:
    return readings.withColumn("classification", views.rule_class())


# Batch queries that need more than one view.


def _scan_sensor_data(spark: SparkSession, folder: str) -> DataFrame:
    return views.load(spark, folder)


def _enrich(spark: SparkSession, folder: str) -> DataFrame:
    events = views.load(spark, folder)
    bare = events.select("id", "device_id", "temperature", "humidity", "timestamp", F.col("gateway_id").alias("g"))
    return R.enrich(bare, F.col("g"), views.rule_class()).drop("g")


def _state_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Every gateway seen in the readings, and for each one an id nobody knows."""
    readings = views.load(spark, folder)
    known = A.gateways(readings)
    asked = known.select(
        F.explode(F.array("gateway_id", F.concat("gateway_id", F.lit("_new")))).alias("gateway_id")
    )
    return S.lookup_states(asked, views.gateway_state(readings))


def _validate(spark: SparkSession, folder: str) -> DataFrame:
    r = views.load(spark, folder)
    return D.valid_requests(views.validate_requests(r), views.devices(r))


def _reject(spark: SparkSession, folder: str) -> DataFrame:
    r = views.load(spark, folder)
    return D.rejected_requests(views.validate_requests(r), views.devices(r))


def _register(spark: SparkSession, folder: str, salt: str = SALT) -> DataFrame:
    known = views.devices(views.load(spark, folder))
    return D.register(views.register_requests(known), known, salt)


def _toggle(spark: SparkSession, folder: str) -> DataFrame:
    known = views.devices(views.load(spark, folder))
    return D.toggle(views.toggle_requests(known), known)


def _toggled_devices(spark: SparkSession, folder: str) -> DataFrame:
    known = views.devices(views.load(spark, folder))
    return D.listing(D.apply_toggles(known, D.toggle(views.toggle_requests(known), known)))


def _key_violations(spark: SparkSession, folder: str) -> DataFrame:
    """The known devices, those that the requests create, and those that requests for existing
    devices would insert if nobody asked first."""
    known = views.devices(views.load(spark, folder))
    answers = D.register(views.register_requests(known), known, SALT)
    unasked = answers.filter("status = 'exists'").select("device_id", F.md5("device_id").alias("api_key"))
    pairs = known.select("device_id", "api_key")
    created = D.created_devices(answers).select("device_id", "api_key")
    return D.key_violations(pairs.unionByName(created).unionByName(unasked))


def _outbox_write(spark: SparkSession, folder: str) -> DataFrame:
    path = work_dir(spark, "outbox")
    O.to_lines(R.anomalies(views.load(spark, folder))).write.text(path)
    return spark.read.text(path)


def _outbox_replay(spark: SparkSession, folder: str) -> DataFrame:
    events = scan_events(spark, folder)
    return O.replay(views.outbox_lines(views.sensor_data(events)), views.delivered_lines(events))


def _outbox_ack(spark: SparkSession, folder: str) -> DataFrame:
    events = scan_events(spark, folder)
    return O.pending(views.outbox_lines(views.sensor_data(events)), views.delivered_lines(events))


def _log_append(spark: SparkSession, folder: str) -> DataFrame:
    """Logs as stored by day; every stored day is read back."""
    path = work_dir(spark, "logs")
    logs = R.log_rows(views.load(spark, folder))
    sinks.append_by_day(logs, path)
    return spark.read.parquet(path).select(*logs.columns)


def _recent_logs_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The newest logs of a table stored by day, of which only the newest days are read."""
    path = work_dir(spark, "logs")
    logs = R.log_rows(views.load(spark, folder))
    sinks.append_by_day(logs, path)
    return R.recent_logs_stored(spark.read.parquet(path), sinks.days(spark, path)).select(*logs.columns)


def _total_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every event is a reading, so the files' own counts are enough."""
    return A.total(scan_to_count(spark, f"{folder}/events.parquet", EVENTS), "total_records")


# Streams.

FILES = 5


#: Readings of one landed file, about.
LANDED_ROWS = 100_000


class _Landing(NamedTuple):
    """A landing folder, and the number of its files that arrived together."""

    path: str
    files: int


def _place(low: int | None, high: int | None):
    """Which of the landings a reading is in: by time, but every 500th id in the last one."""
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    slot = F.floor((micros - F.lit(low or 0)) * FILES / F.lit((high or 0) - (low or 0) + 1))
    return F.when(F.col("id") % 500 == 0, 0).otherwise(slot).cast("int")


def _landed(
    spark: SparkSession, readings: DataFrame, path: str, view: Callable[[DataFrame], DataFrame] = lambda r: r
) -> _Landing:
    """Land a view of the readings in five steps, one after the other: the newest times first,
    and every 500th reading only in the last step, so that it is late. Each step lands the same
    number of files, small ones, as a file is one task's to write and often one task's to decode.
    The readings are read twice in all, for their bounds and to be set apart."""
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    low, high, n = readings.agg(F.min(micros), F.max(micros), F.count("*")).first()
    files = max(1, -(-n // (FILES * LANDED_ROWS)))
    apart = readings.withColumn("_place", _place(low, high))
    apart.repartition(FILES * files, "_place", F.pmod("id", F.lit(files))).write.partitionBy("_place").parquet(f"{path}-apart")
    for place in reversed(range(FILES)):
        step = spark.read.schema(apart.schema).parquet(f"{path}-apart").filter(F.col("_place") == place)
        view(step.drop("_place")).repartition(files).write.mode("append").parquet(path)
    return _Landing(path, files)


def _arriving(spark: SparkSession, landing: _Landing, schema: T.StructType = C.READING) -> DataFrame:
    """A landing folder as a stream of one landing step per micro-batch."""
    return bounded(spark.readStream.schema(schema), landing.files).parquet(landing.path)


def _late_readings(spark: SparkSession, folder: str, base: str) -> DataFrame:
    return _arriving(spark, _landed(spark, views.load(spark, folder), f"{base}/landing"))


def _late_messages(
    spark: SparkSession, folder: str, base: str, view: Callable[[DataFrame], DataFrame] = views.raw_messages
) -> DataFrame:
    landing = _landed(spark, views.load(spark, folder), f"{base}/landing", view)
    return landed_messages(spark, landing.path, landing.files)


def _stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    base = work_dir(spark, "ingest")
    run(routing.ingest(_messages(spark, folder), f"{base}/out"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


def _routed(
    spark: SparkSession,
    folder: str,
    after: Callable | None = None,
    view: Callable[[DataFrame], DataFrame] = views.raw_messages,
) -> str:
    base = work_dir(spark, "routed")
    messages = _late_messages(spark, folder, base, view)
    run(routing.route(messages, base, _by_rule, after=after and after(base)), f"{base}/checkpoint")
    return base


def _stream_store_readings(spark: SparkSession, folder: str) -> DataFrame:
    return routing.stored_readings(spark, _routed(spark, folder))


def _stream_store_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return routing.stored_anomalies(spark, _routed(spark, folder))


def _stream_outbox(spark: SparkSession, folder: str) -> DataFrame:
    return routing.stored_outbox(spark, _routed(spark, folder))


def _stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rejects of messages some of which name no gateway."""
    return routing.stored_rejects(spark, _routed(spark, folder, view=views.nameless_messages))


def _stream_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The stored readings, compacted beside the stream after every second micro-batch."""

    def compacting(base: str) -> Callable:
        return lambda spark, batch_id: routing.compact_rows(spark, base) if batch_id % 2 else None

    return routing.stored_readings(spark, _routed(spark, folder, compacting))


def _stream_delivered(spark: SparkSession, folder: str) -> DataFrame:
    """The outbox delivered into the store after each micro-batch, and once more at the end."""
    base = _routed(spark, folder, lambda out: lambda spark, _: routing.deliver(spark, out))
    routing.deliver(spark, base)
    return routing.delivered(spark, base)


def _stream_running_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters after every reading in order of arrival, read over a snapshot and a compaction."""
    base = work_dir(spark, "running")
    landing = _landed(spark, views.load(spark, folder), f"{base}/landing")
    run(SA.running_counters(_arriving(spark, landing), f"{base}/out"), f"{base}/checkpoint")
    SA.compact_running_counters(spark, f"{base}/out")
    return SA.read_running_counters(spark, f"{base}/out")


def _stream_register_devices(spark: SparkSession, folder: str) -> DataFrame:
    """The device table after all requests, newest first, with a snapshot between two runs."""
    base = work_dir(spark, "devices")
    readings = views.load(spark, folder)
    landing = _landed(spark, readings, f"{base}/landing", views.device_requests)
    run(SD.apply_requests(_arriving(spark, landing, SD.REQUEST), f"{base}/out"), f"{base}/checkpoint")
    SD.compact_devices(spark, f"{base}/out")
    return SD.stored_devices(spark, f"{base}/out", SALT)


def _stream_stored_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters after a compaction that has removed the batches it stands for."""
    base = _routed(spark, folder)
    routing.compact(spark, base, clear=True)
    return routing.stored_counters(spark, base)


def _stream_published_state(spark: SparkSession, folder: str) -> DataFrame:
    """State published after every micro-batch and merged by version."""
    base = _routed(spark, folder, lambda out: routing.StatePublisher(out, seconds=0))
    return routing.published_state(spark, base)


def _stream_outbox_pending(spark: SparkSession, folder: str) -> DataFrame:
    """The live outbox once delivered lines are taken out, twice over."""
    base = _routed(spark, folder)
    delivered = views.delivered_lines(scan_events(spark, folder))
    for _ in range(2):
        routing.clear_outbox(spark, base, delivered)
    return routing.stored_outbox(spark, base)


def _stream_recent_readings(spark: SparkSession, folder: str) -> DataFrame:
    base = _routed(spark, folder)
    stored = routing.stored_readings(spark, base, by_day=True)
    return R.recent_stored(stored, routing.stored_days(spark, base)).select(*C.READING.fieldNames())


def _stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries stored as they come; copies come with their first and again in a late file."""
    base = work_dir(spark, "dedup")
    readings = views.load(spark, folder)
    landing = _landed(spark, readings, f"{base}/landing", views.redelivered_anomalies)
    again = R.anomalies(readings).filter(F.col("id") % 500 == 0)
    again.repartition(landing.files).write.mode("append").parquet(landing.path)
    run(routing.store_deliveries(_arriving(spark, landing), f"{base}/out"), f"{base}/checkpoint")
    return routing.delivered_once(spark, f"{base}/out")


def _stream_counters(spark: SparkSession, folder: str) -> DataFrame:
    base = work_dir(spark, "counters")
    run(SA.counters(_late_readings(spark, folder, base), f"{base}/out"), f"{base}/checkpoint")
    return SA.read_counters(spark, f"{base}/out")


def _landed_halves(
    spark: SparkSession, folder: str, base: str, readings: DataFrame | None = None
) -> Iterator[int]:
    """Land the raw messages of a data folder (or of its ``readings``, where the caller has them
    at hand) in two steps, the older half of the time first; after each the caller runs its stream."""
    readings = views.load(spark, folder) if readings is None else readings
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    low, high = readings.agg(F.min(micros), F.max(micros)).first()
    late = micros > F.lit(((low or 0) + (high or 0)) // 2)
    for half, chosen in enumerate((~late, late)):
        views.raw_messages(spread(readings.filter(chosen))).write.mode("append").parquet(f"{base}/landing")
        yield half


def _stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of a stream that is stopped after half the data and started again."""
    base = work_dir(spark, "restart")
    for _ in _landed_halves(spark, folder, base):
        scored = _by_rule(V.valid_messages(landed_messages(spark, f"{base}/landing")))
        run(SA.counters(scored, f"{base}/out"), f"{base}/checkpoint")
    return SA.read_counters(spark, f"{base}/out")


def _stream_merge_state(spark: SparkSession, folder: str) -> DataFrame:
    """State updates landed in several files by arrival, merged one file at a time."""
    base = work_dir(spark, "merge")
    updates = views.state_updates(views.load(spark, folder))
    updates.repartitionByRange(5, "arrival_seq").write.parquet(f"{base}/landing")
    arriving = _arriving(spark, _Landing(f"{base}/landing", 1), C.STATE_UPDATE)
    run(SA.merge_state(arriving, f"{base}/out"), f"{base}/checkpoint")
    return SA.read_state(spark, f"{base}/out")


def _stream_per_minute(spark: SparkSession, folder: str) -> DataFrame:
    base = work_dir(spark, "minutes")
    run(SA.per_minute(_late_readings(spark, folder, base), f"{base}/out"), f"{base}/checkpoint")
    SA.compact_minutes(spark, f"{base}/out")
    return SA.read_per_minute(spark, f"{base}/out")


def _stream_anomalies_per_minute(spark: SparkSession, folder: str) -> DataFrame:
    base = work_dir(spark, "anomaly-minutes")
    arriving = R.anomalies(_late_readings(spark, folder, base))
    run(SA.per_minute(arriving, f"{base}/out"), f"{base}/checkpoint")
    return SA.read_per_minute(spark, f"{base}/out", "anomalies")


def _stream_rate(spark: SparkSession, folder: str) -> DataFrame:
    base = work_dir(spark, "rate")
    run(SA.anomaly_rate(_late_readings(spark, folder, base), f"{base}/out"), f"{base}/checkpoint")
    SA.compact_anomaly_rate(spark, f"{base}/out")
    return SA.read_anomaly_rate(spark, f"{base}/out")


# Models. What a model says depends on its training; these queries give what must hold for
# any: the rows and columns that go through it, versions, counts, and measured bounds.

LEAST_AGREEMENT = 0.98
FLAGGED = (0.04, 0.06)
#: The same over a part of the rows that the model was fitted on.
FLAGGED_OF_HALF = (0.01, 0.12)


def _agrees(model, readings: DataFrame):
    """Whether the forest gives enough of the readings their own class, measured on all."""
    share = forest.agreement(model, readings).select(F.col("agreement") >= LEAST_AGREEMENT)
    return share.scalar()


def _carried(scored: DataFrame) -> DataFrame:
    """The columns that scoring carries through, and whether it gave a class."""
    known = F.col("classification").isin(C.NORMAL, C.ANOMALY).alias("classified")
    return scored.select("id", "gateway_id", "device_id", *C.FEATURES, "timestamp", known)


def _train_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Train on all readings: how many there are, and whether the forest reproduces them."""
    readings = views.load(spark, folder)
    model = forest.train(readings)
    return forest.agreement(model, readings).select(
        "readings",
        "anomalies",
        F.lit(len(model.stages[-1].trees)).alias("trees"),
        F.lit(max(t.depth for t in model.stages[-1].trees)).alias("depth"),
        (F.col("agreement") >= LEAST_AGREEMENT).alias("agrees"),
    )


def _score_batch(spark: SparkSession, folder: str) -> DataFrame:
    readings = views.load(spark, folder)
    model = forest.train(readings)
    return _carried(forest.score(model, readings)).withColumn("agrees", _agrees(model, readings))


def _model_publish(spark: SparkSession, folder: str) -> DataFrame:
    """Retrain and publish, load that version and publish it again as the next one; the
    readings under the newest version, loaded, and whether it classes them as the first."""
    readings = views.load(spark, folder)
    root = work_dir(spark, "models")
    first, _ = retrain(readings, root)
    original = registry.load(first)
    registry.publish(spark, original, root)
    found = registry.latest(spark, root)
    both = forest.score(original, readings).withColumnRenamed("classification", "first")
    both = forest.score(registry.load(found), both)
    return both.groupBy(F.lit(found.version).cast("bigint").alias("version")).agg(
        F.count("*").alias("readings"), (F.count_if(F.col("first") != F.col("classification")) == 0).alias("same")
    )


def _edge_model(readings: DataFrame) -> isolation.IsolationModel:
    return isolation.train(readings.filter(~E.is_anomaly()))


def _flagged_share(model: isolation.IsolationModel, readings: DataFrame):
    """Whether the model flags the share of its training rows that it is meant to."""
    flagged = isolation.score(model, readings.filter(~E.is_anomaly())).select(
        F.avg((F.col("verdict") == C.ISOLATION_ANOMALY).cast("int")).between(*FLAGGED)
    )
    return flagged.scalar()


def _train_edge_model(spark: SparkSession, folder: str) -> DataFrame:
    """The trees: how many, of which sample size, whether all have a root and no leaf is
    deeper than allowed; and whether the cut-off flags the share it should."""
    readings = views.load(spark, folder)
    model = _edge_model(readings)
    deepest = 2 ** (1 + (model.sample_size - 1).bit_length()) - 1
    return (
        model.nodes(spark)
        .agg(
            F.count_distinct("tree").alias("trees"),
            F.count_if(F.col("node") == 0).alias("roots"),
            (F.max("node") < deepest).alias("within_depth"),
        )
        .withColumn("sample_size", F.lit(model.sample_size))
        .withColumn("flags_its_share", _flagged_share(model, readings))
    )


def _edge_score(spark: SparkSession, folder: str) -> DataFrame:
    readings = views.load(spark, folder)
    model = _edge_model(readings)
    scored = isolation.score(model, readings)
    agreed = (F.col("verdict") == C.ISOLATION_ANOMALY) == (F.col("classification") == C.ANOMALY)
    scored = scored.withColumn("_consistent", agreed & F.col("score").between(0, 1))
    return scored.select(
        *_carried(scored).columns[:-1],
        F.col("classification").isin(C.NORMAL, C.ANOMALY).alias("classified"),
        F.col("_consistent").alias("consistent"),
    ).withColumn("flags_its_share", _flagged_share(model, readings))


def _score_with_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """All readings scored before and after a forest is published: the readings that each model
    gave a class, counted. A model whose classes break its bound over all readings (the share
    of the forest's that agree, and of the normal ones that the edge model flags) gives no row."""
    readings = views.load(spark, folder)
    edge = _edge_model(readings)
    root = work_dir(spark, "models")
    known = readings.withColumn("own", F.col("classification"))
    before = scoring.score_with_fallback(known, root, edge)
    retrain(readings, root)
    both = before.unionByName(scoring.score_with_fallback(known, root, edge))
    return _bounded_counts(both)


def _bounded_counts(scored: DataFrame) -> DataFrame:
    """Readings with a class per model, of the models within their bounds."""
    classified = F.col("classification").isin(C.NORMAL, C.ANOMALY)
    flagged = F.when(~E.is_anomaly("own"), E.is_anomaly().cast("int"))
    agrees = (F.col("own") == F.col("classification")).cast("int")
    counted = scored.groupBy("model_type").agg(
        F.count_if(classified).alias("readings"),
        F.count_distinct(F.when(classified, F.col("id"))).alias("ids"),
        F.avg(agrees).alias("agreement"),
        F.avg(flagged).alias("flagged"),
    )
    bound = F.when(F.col("model_type") == scoring.FOREST, F.col("agreement") >= LEAST_AGREEMENT).otherwise(
        F.col("flagged").between(*FLAGGED)
    )
    return counted.filter(bound).select("model_type", "readings", "ids")


def _stream_score(spark: SparkSession, folder: str) -> DataFrame:
    base = work_dir(spark, "scored")
    readings = views.load(spark, folder)
    model = forest.train(readings)
    scored = forest.score(model, V.valid_messages(_late_messages(spark, folder, base)))
    run(routing.store_scored(scored, f"{base}/out"), f"{base}/checkpoint")
    return _carried(spark.read.parquet(f"{base}/out")).withColumn("agrees", _agrees(model, readings))


def _stream_model_switch(spark: SparkSession, folder: str) -> DataFrame:
    """The first half arrives before any forest is published, the second half after; the
    readings scored by each model and version, and whether their classes keep its bound: the
    forest's agree with their own, and the edge model flags about the share that it is meant to.
    Both trainings and the landing go over the readings again and again, so these are made out of
    the events once and written."""
    readings = write_table(spread(views.load(spark, folder)), "readings")
    edge = _edge_model(readings)
    base = work_dir(spark, "switch")
    for half in _landed_halves(spark, folder, base, readings):
        arriving = V.valid_messages(landed_messages(spark, f"{base}/landing"))
        newest = model_switch.NewestModel(f"{base}/models", edge)
        run(model_switch.score_with_newest(arriving, f"{base}/out", newest), f"{base}/checkpoint")
        if half == 0:
            retrain(readings, f"{base}/models")
    scored = model_switch.read_scored(spark, f"{base}/out").withColumn("own", views.rule_class())
    flagged = F.avg(F.when(~E.is_anomaly("own"), E.is_anomaly().cast("int"))).between(*FLAGGED_OF_HALF)
    agrees = F.avg((F.col("own") == F.col("classification")).cast("int")) >= LEAST_AGREEMENT
    return scored.groupBy("model_type", "model_version").agg(
        F.count("*").alias("readings"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
        F.when(F.first("model_type") == scoring.FOREST, agrees).otherwise(flagged).alias("within_bounds"),
    )


# Queries that run streams or train models: they take seconds whether warm or not.
RUN_ONCE = {
    "recent_logs_stored",
    "stream_ingest",
    "stream_store_readings",
    "stream_store_anomalies",
    "stream_compacted_readings",
    "stream_outbox",
    "stream_outbox_delivered",
    "stream_rejects",
    "stream_running_counters",
    "stream_register_devices",
    "stream_stored_counters",
    "stream_published_state",
    "stream_outbox_pending",
    "stream_recent_readings",
    "stream_dedup_anomalies",
    "stream_counters",
    "stream_restart",
    "stream_merge_gateway_state",
    "stream_records_per_minute",
    "stream_anomalies_per_minute",
    "stream_anomaly_rate",
    "train_forest",
    "score_batch",
    "model_publish",
    "train_edge_model",
    "edge_score",
    "score_with_fallback",
    "stream_score",
    "stream_model_switch",
}


def queries() -> dict[str, Query]:
    return {
        # Scans, projections and filters.
        "scan_sensor_data": _scan_sensor_data,
        "enrich_reading": _enrich,
        "label_column": _on_readings(lambda r: R.labelled(r).select("id", "classification", "label")),
        "reading_bands": _on_readings(R.bands),
        "anomaly_filter": _on_readings(R.anomalies),
        "gateway_records": _on_readings(lambda r: A.per_gateway(R.of_gateway(r, GATEWAY))),
        "recent_readings": _on_readings(R.recent),
        "temperature_trend": _on_readings(lambda r: R.trend(r, "temperature")),
        "humidity_trend": _on_readings(lambda r: R.trend(r, "humidity")),
        "recent_logs": _on_readings(lambda r: R.recent_logs(R.log_rows(r))),
        "recent_logs_stored": _recent_logs_stored,
        "scatter_sample": _on_readings(R.scatter_sample),
        # Validation.
        "validate_messages": _on_readings(lambda r: V.valid_messages(views.raw_messages(r))),
        "rejected_messages": _on_readings(lambda r: V.rejected_messages(views.raw_messages(r))),
        "reject_summary": _on_readings(lambda r: V.reject_summary(views.raw_messages(r))),
        "parse_timestamp": _on_readings(lambda r: V.parse_timestamps(views.raw_messages(r))),
        # Aggregations.
        "total_records": _total_records,
        "active_gateways": _on_state(lambda s: A.total(s, "active_gateways")),
        "total_anomalies": _on_readings(lambda r: A.total(R.anomalies(r), "total_anomalies")),
        "records_per_minute": _on_readings(A.per_minute),
        "anomalies_per_minute": _on_readings(lambda r: A.per_minute(R.anomalies(r), "anomalies")),
        "records_per_gateway": _on_readings(A.per_gateway),
        "gateway_anomaly_rate": _on_readings(A.anomaly_rate),
        "distinct_gateways": _on_readings(A.gateways),
        "analytics_summary": _on_readings(A.summary),
        "hourly_trend": _on_readings(A.hourly),
        "anomaly_report": _on_readings(lambda r: A.anomaly_report(R.anomalies(r))),
        "anomaly_report_row": _on_readings(lambda r: A.anomaly_report_row(R.anomalies(r))),
        "anomaly_detail": _on_readings(lambda r: A.anomaly_detail(R.anomalies(r))),
        "series_totals": _on_readings(A.series_totals),
        "reading_last_mean": _on_readings(A.last_and_mean),
        "last_not_null": _on_readings(lambda r: A.last_not_null(A.anomaly_series(r), "anomalies")),
        "throughput": _on_readings(A.throughput),
        # Gateway state.
        "merge_gateway_state": _on_readings(views.merged_state),
        "running_counters": _on_readings(S.running_counters),
        "state_updates": _on_readings(views.state_updates),
        "gateway_states": _on_state(lambda s: s),
        "gateway_load": _on_state(S.load_table),
        "gateway_load_totals": _on_state(A.load_totals),
        "gateway_leader": _on_state(A.leader),
        "gateway_state_lookup": _state_lookup,
        # Devices.
        "device_list": _on_readings(lambda r: D.listing(views.devices(r))),
        "validate_devices": _validate,
        "reject_devices": _reject,
        "register_devices": _register,
        "toggle_devices": _toggle,
        "toggled_device_list": _toggled_devices,
        "device_key_violations": _key_violations,
        # Outbox, logs, delivery.
        "outbox_write": _outbox_write,
        "outbox_replay": _outbox_replay,
        "outbox_ack": _outbox_ack,
        "log_append": _log_append,
        "dedup_anomalies": _on_readings(lambda r: O.deduplicated(views.redelivered_anomalies(r))),
        # Streams.
        "stream_ingest": _stream_ingest,
        "stream_store_readings": _stream_store_readings,
        "stream_store_anomalies": _stream_store_anomalies,
        "stream_compacted_readings": _stream_compacted,
        "stream_outbox": _stream_outbox,
        "stream_outbox_delivered": _stream_delivered,
        "stream_rejects": _stream_rejects,
        "stream_stored_counters": _stream_stored_counters,
        "stream_published_state": _stream_published_state,
        "stream_outbox_pending": _stream_outbox_pending,
        "stream_recent_readings": _stream_recent_readings,
        "stream_dedup_anomalies": _stream_dedup,
        "stream_counters": _stream_counters,
        "stream_running_counters": _stream_running_counters,
        "stream_register_devices": _stream_register_devices,
        "stream_restart": _stream_restart,
        "stream_merge_gateway_state": _stream_merge_state,
        "stream_records_per_minute": _stream_per_minute,
        "stream_anomalies_per_minute": _stream_anomalies_per_minute,
        "stream_anomaly_rate": _stream_rate,
        # Models.
        "latest_model": _on_readings(lambda r: registry.latest_model(views.model_registry(r))),
        "train_forest": _train_forest,
        "score_batch": _score_batch,
        "model_publish": _model_publish,
        "train_edge_model": _train_edge_model,
        "edge_score": _edge_score,
        "score_with_fallback": _score_with_fallback,
        "stream_score": _stream_score,
        "stream_model_switch": _stream_model_switch,
    }
