"""Message decoding: every kind of bad message lands under its own reason."""

import itertools
from datetime import datetime, timedelta

import pytest

from sensorloom.functions import expressions as E
from sensorloom.operators import validation as V
from sensorloom.plans import views

GOOD = '{"device_id":"a","temperature":21.5,"humidity":33,"timestamp":"2024-01-01T00:00:00"}'

REASONS = [
    (GOOD, None),
    (GOOD.replace("21.5", '"21.5"'), None),
    (GOOD.replace("21.5", "true"), None),
    (GOOD.replace("21.5", "1e3"), None),
    (GOOD.replace("}", ',"extra":{"x":[1,2]}}'), None),
    (f"  {GOOD}\n", None),
    (GOOD.replace('"a"', '"a","device_id":"b"'), None),
    (GOOD.replace("00:00:00", "00:00:00.123456"), None),
    (GOOD.replace("00:00:00", "00:00:00+02:00"), None),
    (GOOD[:20], "malformed_json"),
    (GOOD[:-1], "malformed_json"),
    (GOOD + " and more", "malformed_json"),
    ("", "malformed_json"),
    ("   ", "malformed_json"),
    (None, "malformed_json"),
    ("5", "malformed_json"),
    ("null", "malformed_json"),
    (f"[{GOOD}]", "malformed_json"),
    ("{}", "missing_device_id"),
    (GOOD.replace('"a"', "null"), "missing_device_id"),
    (GOOD.replace("temperature", "temp"), "missing_temperature"),
    (GOOD.replace("33", "null"), "missing_humidity"),
    (GOOD.replace("timestamp", "time"), "missing_timestamp"),
    (GOOD.replace('"a"', "5"), "bad_device_id"),
    (GOOD.replace("21.5", '"warm"'), "bad_temperature"),
    (GOOD.replace("21.5", '"21.5d"'), "bad_temperature"),
    (GOOD.replace("21.5", '""'), "bad_temperature"),
    (GOOD.replace("33", "[33]"), "bad_humidity"),
    (GOOD.replace("33", '{"v":33}'), "bad_humidity"),
    (GOOD.replace('"2024-01-01T00:00:00"', "5"), "bad_timestamp"),
    (GOOD.replace("2024-01-01T00:00:00", "bad"), "bad_timestamp"),
    (GOOD.replace("2024-01-01T00:00:00", "2024-13-01T00:00:00"), "bad_timestamp"),
    (GOOD.replace("2024-01-01T00:00:00", "2024"), "bad_timestamp"),
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(i, f"gw_{i % 3}", text) for i, (text, _) in enumerate(REASONS)]
    return spark.createDataFrame(rows, "id bigint, gateway_id string, value string")


def test_reasons(raw):
    got = {r.id: r.reason for r in V.decode_messages(raw).collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(REASONS)}


def test_good_and_bad_are_all(raw):
    good, bad = V.valid_messages(raw), V.rejected_messages(raw)
    assert good.count() + bad.count() == raw.count()
    assert good.join(bad, "id").count() == 0


def test_values(raw):
    from datetime import datetime

    rows = {r.id: r for r in V.valid_messages(raw).collect()}
    assert (rows[0].device_id, rows[0].temperature, rows[0].humidity) == ("a", 21.5, 33.0)
    assert rows[0].timestamp == datetime(2024, 1, 1)
    assert rows[1].temperature == 21.5
    assert rows[2].temperature == 1.0
    assert rows[3].temperature == 1000.0
    assert rows[6].device_id == "b"
    assert rows[7].timestamp.microsecond == 123456
    assert rows[8].timestamp == datetime(2023, 12, 31, 22)


def test_damaged_views(small):
    messages = views.raw_messages(small)
    counts = {r.reason: r.rejected for r in V.reject_summary(messages).collect()}
    ids = range(1000)
    first = [i for i in ids if i % 97 == 0]
    second = [i for i in ids if i % 97 and i % 101 == 0]
    fourth = [i for i in ids if i % 97 and i % 101 and i % 103 and i % 107 == 0]
    sound = [i for i in ids if i % 97 and i % 101 and i % 103 and i % 107]
    assert counts == {
        "malformed_json": len(first),
        "missing_humidity": len(second),
        "bad_timestamp": len(fourth),
        "bad_temperature": sum(i % 109 == 0 for i in sound),
        "bad_humidity": sum(i % 109 != 0 and i % 113 == 0 for i in sound),
    }


def test_text_is_parsed_once(small):
    """Neither the filter nor the projection brings a second JSON parse into the plan."""
    plan = V.valid_messages(views.raw_messages(small))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_complete_records(spark):
    rows = spark.createDataFrame([("g", 1), (None, 2), ("h", None)], "gateway_id string, version int")
    assert [r.gateway_id for r in V.complete_records(rows, ["gateway_id", "version"]).collect()] == ["g"]


def test_all_forms_of_a_time(spark):
    """Every date with every time, fraction and zone, against the time that they are made of."""
    dates = ("2024-01-02", "20240102")
    times = {"": (0, 0, 0), "T05": (5, 0, 0), " 05:06": (5, 6, 0), "T0506": (5, 6, 0), "T05:06:07": (5, 6, 7), "T050607": (5, 6, 7)}
    fractions = {"": 0, ".1": 100_000, ",000001": 1, ".1234567": 123_456}
    zones = {"": 0, "Z": 0, "+05": 300, "-0530": -330, "+05:30": 330}
    expected = {}
    for date, (time, at), (fraction, micros), (zone, minutes) in itertools.product(
        dates, times.items(), fractions.items(), zones.items()
    ):
        if (fraction and at[2] == 0) or (zone and not time):
            continue
        moment = datetime(2024, 1, 2, *at, micros) - timedelta(minutes=minutes)
        expected[date + time + fraction + zone] = moment
    bad = ("2024-1-2", "2024-0102", "2024-13-02", "T05:06", "2024-01-02T05:0607", "2024-01-02T05:06.1", "now", "$1", None)
    rows = spark.createDataFrame([(t,) for t in (*expected, *bad)], "t string")
    found = {r["t"]: r["at"] for r in rows.select("t", E.iso_timestamp("t").alias("at")).collect()}
    assert found == {**expected, **dict.fromkeys(bad)} and len(expected) > 100
