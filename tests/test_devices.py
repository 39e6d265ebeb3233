"""Registration, activation, key checks; joins with and without broadcast."""

from datetime import datetime

import pytest

from sensorloom.operators import devices as D
from sensorloom.operators import joins
from sensorloom.operators.joins import join_sized

DAY = datetime(2024, 1, 1)


@pytest.fixture
def known(spark):
    return spark.createDataFrame(
        [(1, "sensor_1", "k1", True, DAY), (2, "sensor_2", "k2", False, DAY)],
        "id bigint, device_id string, api_key string, active boolean, registered_at timestamp_ntz",
    )


def test_register(spark, known):
    asked = spark.createDataFrame(
        [(1, 1), (2, 7), (3, -1), (4, 7), (5, 0)], "request_seq bigint, device_number bigint"
    )
    answers = D.register(asked, known, "salt")
    got = {r.request_seq: (r.device_id, r.status) for r in answers.collect()}
    assert got == {
        1: ("sensor_1", "exists"),
        2: ("sensor_7", "created"),
        3: (None, "invalid"),
        4: ("sensor_7", "exists"),
        5: ("sensor_0", "created"),
    }
    new = D.created_devices(answers).collect()
    assert sorted(r.device_id for r in new) == ["sensor_0", "sensor_7"]
    assert all(r.active and len(r.api_key) == 32 for r in new)
    assert len({r.api_key for r in new}) == 2


def test_toggle(spark, known):
    asked = spark.createDataFrame([("sensor_1",), ("sensor_2",), ("sensor_2",), ("x",)], "device_id string")
    outcome = D.toggle(asked, known)
    got = {r.device_id: (r.active, r.status) for r in outcome.collect()}
    assert got == {"sensor_1": (False, "toggled"), "sensor_2": (False, "toggled"), "x": (None, "unknown")}
    after = {r.device_id: r.active for r in D.apply_toggles(known, outcome).collect()}
    assert after == {"sensor_1": False, "sensor_2": False}


def test_valid_and_rejected_are_all(spark, known):
    asked = spark.createDataFrame([(1, "k1"), (2, "k2"), (3, "none"), (4, "k1")], "id bigint, api_key string")
    assert sorted(r.id for r in D.valid_requests(asked, known).collect()) == [1, 4]
    assert sorted(r.id for r in D.rejected_requests(asked, known).collect()) == [2, 3]


def test_listing_hides_keys(known):
    assert D.listing(known).columns == ["device_id", "active", "registered_at"]


def test_key_violations(spark, known):
    assert D.key_violations(known).count() == 0
    doubled = known.union(known.filter("id = 1").selectExpr("9", "device_id", "'other'", "active", "registered_at"))
    assert [tuple(r) for r in D.key_violations(doubled).collect()] == [("device_id", "sensor_1", 2)]


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with most rows, some rows without a key."""
    return spark.range(1000).selectExpr(
        "id", "CASE WHEN id < 700 THEN 'hot' WHEN id < 800 THEN NULL ELSE concat('k', id % 20) END AS key"
    )


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("hot", 1), ("k3", 2), ("k4", 3), ("zz", 4)], "key string, x int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_share", [0.02, 0.5, 1.0])
def test_join_is_the_same_beyond_the_broadcast_bound(skewed, lookup, how, hot_share):
    expected = skewed.join(lookup, "key", how)
    broadcast = join_sized(skewed, lookup, "key", how)
    split = join_sized(skewed, lookup, "key", how, max_bytes=0, hot_share=hot_share)
    assert broadcast.columns == split.columns == expected.columns
    assert sorted(split.collect(), key=str) == sorted(broadcast.collect(), key=str)
    assert sorted(split.collect(), key=str) == sorted(expected.collect(), key=str)


def test_hot_lookup_without_hot_row(skewed, lookup):
    """The hot key is missing from the lookup table."""
    rest = lookup.filter("key != 'hot'")
    split = join_sized(skewed, rest, "key", "left_anti", max_bytes=0)
    assert sorted(split.collect(), key=str) == sorted(skewed.join(rest, "key", "left_anti").collect(), key=str)


def test_broadcast_only_below_the_bound(spark, skewed, lookup):
    size = joins.measured_bytes(lookup)
    assert size >= sum(len(k) for k in ("hot", "k3", "k4", "zz"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        below = join_sized(skewed, lookup, "key", "left_semi", max_bytes=size)
        below = below._jdf.queryExecution().executedPlan().toString()
        beyond = join_sized(skewed, lookup, "key", "left_semi", max_bytes=size - 1)
        beyond = beyond._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in below and "Union" not in below
    assert "Union" in beyond and beyond.count("SortMergeJoin") == 1


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        joins.join_sized(spark.range(1), spark.range(1), "id", "full")
