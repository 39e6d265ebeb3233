"""Version-gated merging and running counters."""

import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sensorloom import constants as C
from sensorloom.operators import state as S
from sensorloom.plans import views

DAY = datetime(2024, 1, 1)


def merged_in_order(updates):
    """One update after the other, as they arrive."""
    state = {}
    for gateway, version, processed, anomalies, _, arrival in sorted(updates, key=lambda u: u[5]):
        if gateway not in state or version > state[gateway][0]:
            state[gateway] = (version, processed, anomalies)
    return state


def merged_by_spark(spark, updates, current=None):
    frame = spark.createDataFrame(updates, C.STATE_UPDATE)
    return {
        r.gateway_id: (r.version, r.total_processed, r.total_anomalies)
        for r in S.merge_updates(frame, current).collect()
    }


update = st.tuples(
    st.sampled_from(["a", "b", "c"]), st.integers(0, 4), st.integers(0, 9), st.integers(0, 9), st.just(DAY)
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(update, min_size=1, max_size=30), st.randoms(use_true_random=False))
def test_merge_equals_one_by_one(spark, rows, rng):
    updates = [(*row, arrival) for arrival, row in enumerate(rows)]
    shuffled = updates[:]
    rng.shuffle(shuffled)
    assert merged_by_spark(spark, shuffled) == merged_in_order(updates)


def test_tie_and_stale_leave_the_stored_row(spark):
    current = spark.createDataFrame([("a", 5, 50, 5, DAY)], C.GATEWAY_STATE)
    tie, stale, newer = ("a", 5, 99, 99, DAY, -7), ("a", 4, 1, 1, DAY, 1), ("b", 1, 1, 0, DAY, 2)
    assert merged_by_spark(spark, [tie, stale, newer], current) == {"a": (5, 50, 5), "b": (1, 1, 0)}
    assert merged_by_spark(spark, [("a", 6, 60, 6, DAY, 3)], current) == {"a": (6, 60, 6)}


def test_merging_twice_changes_nothing(spark, small):
    updates = views.state_updates(small)
    once = S.merge_updates(updates)
    assert sorted(S.merge_updates(updates, once).collect()) == sorted(once.collect())


def test_gateway_state_view_is_the_merged_state(small):
    assert sorted(views.gateway_state(small).collect()) == sorted(S.merge_updates(views.state_updates(small)).collect())


@pytest.mark.parametrize("slices", [1, 5, 16])
def test_running_counters_with_a_hot_gateway(spark, reading, slices):
    """Most readings in one gateway, many of them at the very same moment."""
    rng = random.Random(slices)
    rows = [
        (
            i,
            "hot" if rng.random() < 0.8 else f"g{rng.randrange(5)}",
            "d",
            1.0,
            1.0,
            7 if rng.random() < 0.5 else rng.randrange(100),
            C.ANOMALY if rng.random() < 0.3 else C.NORMAL,
        )
        for i in range(2000)
    ]
    expected = {}
    totals = {}
    for i, gateway, *_, second, kind in sorted(rows, key=lambda r: (r[5], r[0])):
        n, a = totals.get(gateway, (0, 0))
        totals[gateway] = (n + 1, a + (kind == C.ANOMALY))
        expected[i] = totals[gateway]
    got = S.running_counters(reading(*rows), slices).collect()
    assert {r.id: (r.total_processed, r.total_anomalies) for r in got} == expected
    assert all(r.version == r.total_processed for r in got)


def test_hot_gateway_is_split_over_slices(spark, reading):
    """No slice holds more than a fair part of a gateway that has all the rows."""
    from pyspark.sql import functions as F

    rows = reading(*[(i, "hot", "d", 1.0, 1.0, 5, C.NORMAL) for i in range(4000)])
    cut = rows.repartitionByRange(8, "gateway_id", "timestamp", "id").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in cut.collect()) < 1000


def test_lookup_marks_unknown_gateways(spark, small):
    asked = spark.createDataFrame([("gw_0",), ("nobody",)], "gateway_id string")
    got = {r.gateway_id: (r.exists, r.version) for r in S.lookup_states(asked, views.gateway_state(small)).collect()}
    assert got["nobody"] == (False, None)
    assert got["gw_0"][0] is True and got["gw_0"][1] > 0
