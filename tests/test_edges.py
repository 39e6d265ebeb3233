"""No rows, one gateway, no anomalies, no time span, nulls."""

import json

from sensorloom import constants as C
from sensorloom.functions import expressions as E
from sensorloom.ml import registry
from sensorloom.operators import aggregates as A
from sensorloom.operators import readings as R
from sensorloom.operators import state as S
from sensorloom.plans import views


def one_row(df):
    return tuple(df.first())


def test_no_rows(spark):
    none = spark.createDataFrame([], C.READING)
    assert one_row(A.total(none, "n")) == (0,)
    assert one_row(A.summary(none)) == (0, 0)
    assert A.anomaly_rate(none).count() == 0
    assert A.anomaly_report(R.anomalies(none)).count() == 0
    assert one_row(A.anomaly_report_row(R.anomalies(none))) == (0, "{}")
    assert A.leader(views.gateway_state(none)).count() == 0
    assert {r.series: r.total for r in A.series_totals(none).collect()} == {"processed_data": 0, "anomalies": 0}
    assert [tuple(r) for r in A.throughput(none).collect()] == [(None, 0, None, None)]
    assert S.running_counters(none).count() == 0
    assert R.recent(none).count() == 0
    assert one_row(registry.latest_model(views.model_registry(none))) == (False, None, None)


def test_one_gateway_without_anomalies(reading):
    rows = reading(*[(i, "g", "d", 20.0, 30.0, i, C.NORMAL) for i in range(3)])
    assert one_row(A.anomaly_rate(rows)) == ("g", 0.0)
    assert one_row(A.leader(views.gateway_state(rows))) == ("g", "g", True)
    assert A.per_minute(R.anomalies(rows), "anomalies").count() == 0
    assert one_row(A.last_not_null(A.anomaly_series(rows), "anomalies")) == (None, None)


def test_no_time_span_has_no_rate(reading):
    rows = reading((1, "g", "d", 20.0, 30.0, 0, C.NORMAL), (2, "g", "d", 20.0, 30.0, 0, C.NORMAL))
    assert {r.throughput for r in A.throughput(rows).collect()} == {None}
    spread = reading((1, "g", "d", 20.0, 30.0, 0, C.NORMAL), (2, "h", "d", 20.0, 30.0, 4, C.NORMAL))
    overall = [r for r in A.throughput(spread).collect() if r.gateway_id is None][0]
    assert (overall.messages, overall.duration_seconds, overall.throughput) == (2, 4.0, 0.5)


def test_last_not_null_skips_newer_nulls(reading):
    rows = reading(
        (1, "g", "d", 75.0, 30.0, 0, C.ANOMALY),
        (2, "g", "d", 75.0, 30.0, 30, C.ANOMALY),
        (3, "g", "d", 20.0, 30.0, 120, C.NORMAL),
    )
    got = A.last_not_null(A.anomaly_series(rows), "anomalies").first()
    assert (got.time.minute, got.last_value) == (0, 2)


def test_bands_at_their_steps(spark):
    values = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 29.9, 30.0, 69.9, 70.0)], "v double")
    assert [r[0] for r in values.select(E.band("v")).collect()] == [None, "low", "low", "medium", "medium", "high"]


def test_report_row_equals_report(small):
    flagged = R.anomalies(small)
    total, text = one_row(A.anomaly_report_row(flagged))
    per_gateway = json.loads(text)
    rows = A.anomaly_report(flagged).collect()
    assert {r.gateway_id: r.anomalies for r in rows} == per_gateway
    assert {r.total_anomalies for r in rows} == {total} == {sum(per_gateway.values())}


def test_recent_with_a_given_time(spark, small):
    from pyspark.sql import functions as F

    as_of = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    got = R.recent(small, as_of=as_of)
    expected = small.filter("timestamp BETWEEN TIMESTAMP_NTZ'2024-01-10 06:00:00' AND TIMESTAMP_NTZ'2024-01-10 12:00:00'")
    assert sorted(got.collect()) == sorted(expected.collect()) and got.count() > 0


def test_queries_as_sql_text(spark):
    from conftest import SMALL

    views.register_views(spark, SMALL)
    chosen = spark.sql(
        "SELECT gateway_id, COUNT(*) AS n FROM sensor_data WHERE gateway_id = :gateway GROUP BY gateway_id",
        args={"gateway": "gw_2"},
    ).collect()
    assert len(chosen) == 1 and chosen[0].gateway_id == "gw_2"
    assert spark.sql("SELECT COUNT(*) FROM gateway_state").first()[0] == 4
    assert spark.sql("SELECT * FROM logs ORDER BY timestamp DESC LIMIT 20").count() == 20
