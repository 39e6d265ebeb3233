"""Forest, isolation forest, registry and the choice between the models."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from sensorloom import constants as C
from sensorloom.functions import expressions as E
from sensorloom.ml import forest, isolation, registry, scoring
from sensorloom.operators import readings as R
from sensorloom.plans import catalog, retraining
from sensorloom.sources import sinks


@pytest.fixture(scope="module")
def model(medium):
    return forest.train(medium)


@pytest.fixture(scope="module")
def edge(medium):
    return isolation.train(medium.filter(~E.is_anomaly()))


def classes(scored):
    return {r.id: r.classification for r in scored.select("id", "classification").collect()}


def test_forest_settings(model):
    trained = model.stages[1]
    assert (trained.getNumTrees, trained.getOrDefault("maxDepth"), trained.numClasses) == (50, 5, 2)
    assert model.stages[0].getInputCols() == ["temperature", "humidity"]


def test_forest_agrees_with_its_labels(model, medium):
    truth = classes(medium)
    given = classes(forest.score(model, medium))
    assert given.keys() == truth.keys()
    assert sum(given[i] == truth[i] for i in truth) / len(truth) >= 0.98
    table = forest.confusion(model, medium).collect()
    assert sum(r.readings for r in table) == len(truth)


def test_scoring_keeps_the_columns(model, small):
    assert forest.score(model, small).columns == small.columns


def test_label_column(small):
    labelled = R.labelled(small)
    assert labelled.schema["label"].metadata["ml_attr"]["vals"] == [C.NORMAL, C.ANOMALY]
    assert labelled.filter((F.col("label") == 1) != E.is_anomaly()).count() == 0


def test_null_feature_raises(spark, small):
    broken = small.withColumn("temperature", F.when(F.col("id") != 5, F.col("temperature")))
    with pytest.raises(Exception, match="[Nn]ull"):
        forest.train(broken)


def test_condensed_training_rows_hold_all_readings(medium):
    rows = forest.condense(medium)
    weights = {r.label: r.w for r in rows.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert weights == {0: 10_000 - 958, 1: 958}
    few = forest.condense(medium, cells=4, parts=1)
    assert few.count() <= 2 * 5 * 5
    assert few.agg(F.sum("weight")).first()[0] == 10_000
    assert rows.schema["label"].metadata["ml_attr"]["vals"] == [C.NORMAL, C.ANOMALY]


def test_forest_is_the_same_for_any_files_and_cores(model, medium):
    """One path at every size, and rows dealt to the trainer by their values."""
    for parts in (1, 4, 13):
        again = forest.train(medium.repartition(parts))
        assert again.stages[1].toDebugString.split("\n", 1)[1] == model.stages[1].toDebugString.split("\n", 1)[1]


def test_publish_load_and_latest(spark, model, small, tmp_path):
    root = str(tmp_path / "models")
    assert registry.latest(spark, root) is None
    assert tuple(registry.latest_model(registry.published(spark, root)).first()) == (False, None, None)
    first = registry.publish(spark, model, root)
    second = registry.publish(spark, model, root)
    assert (first.version, second.version) == (1, 2)
    assert registry.latest(spark, root) == second
    assert registry.published(spark, root).count() == 2
    assert classes(forest.score(registry.load(second), small)) == classes(forest.score(model, small))


def test_a_version_not_announced_is_not_used(spark, model, tmp_path):
    root = str(tmp_path / "models")
    registry.publish(spark, model, root)
    model.write().save(f"{root}/models/other")  # a publisher that died before the announcement
    assert registry.latest(spark, root).version == 1
    assert registry.publish(spark, model, root).version == 2


def test_two_trainers_at_once_get_two_versions(spark, model, tmp_path, monkeypatch):
    """The other one announces between this one's look and its announcement."""
    root = str(tmp_path / "models")
    create, other = registry.create_file, []

    def late(session, path, text):
        if not other:
            other.append(True)
            assert create(session, path, '{"version": 1, "path": "elsewhere"}\n')
        return create(session, path, text)

    monkeypatch.setattr(registry, "create_file", late)
    assert registry.publish(spark, model, root).version == 2
    assert [v.version for v in registry.versions(spark, root)] == [2, 1]


def test_an_older_forest_is_used_if_the_newest_is_damaged(spark, model, edge, small, tmp_path):
    root = str(tmp_path / "models")
    registry.publish(spark, model, root)
    assert sinks.create_file(spark, f"{root}/published/version-2.json", '{"version": 2, "path": "/nowhere"}\n')
    scored = scoring.score_with_fallback(small, root, edge)
    assert {r.model_type for r in scored.select("model_type").distinct().collect()} == {scoring.FOREST}


def test_unnumbered_model_is_version_one(spark):
    unnumbered = spark.createDataFrame([(None, "somewhere", None)], registry.REGISTRY)
    assert tuple(registry.latest_model(unnumbered).first()) == (True, 1, "somewhere")


def test_retraining_publishes_and_reports(spark, small, tmp_path):
    version, counts = retraining.retrain(small, str(tmp_path / "models"))
    assert version.version == 1
    assert sum(r.processed_data for r in counts.collect()) == small.count()


def test_average_path():
    assert isolation.average_path(1) == 0.0
    assert isolation.average_path(2) == 1.0
    # 2 H(n-1) - 2 (n-1) / n with the harmonic number of 255.
    exact = 2 * sum(1 / k for k in range(1, 256)) - 2 * 255 / 256
    assert abs(isolation.average_path(256) - exact) < 0.01


def test_isolation_flags_its_share(edge, medium):
    train = medium.filter(~E.is_anomaly())
    scored = isolation.score(edge, train)
    flagged = scored.filter("verdict = -1").count()
    assert 0.04 <= flagged / train.count() <= 0.06
    assert scored.filter((F.col("verdict") == -1) != E.is_anomaly()).count() == 0


def test_isolation_is_the_same_again(edge, medium):
    again = isolation.train(medium.filter(~E.is_anomaly()).repartition(13))
    assert np.array_equal(edge.feature, again.feature)
    assert np.array_equal(edge.threshold, again.threshold, equal_nan=True)
    other = isolation.train(medium.filter(~E.is_anomaly()), seed=7)
    assert not np.array_equal(edge.threshold, other.threshold, equal_nan=True)


def test_nodes_are_the_same_for_any_partitions(edge, medium):
    for parts in (1, 4):
        again = isolation.train(medium.filter(~E.is_anomaly()).repartition(parts))
        assert np.array_equal(edge.threshold, again.threshold, equal_nan=True) and edge.cut_off == again.cut_off


def test_trees_are_sent_to_executors_once(spark, edge, small):
    first = isolation._broadcast(edge, spark)
    isolation.score(edge, small).count()
    assert isolation._broadcast(edge, spark) is first


def test_far_out_points_are_anomalies(edge, reading):
    points = reading(
        (1, "g", "d", 500.0, 500.0, 0, None),
        (2, "g", "d", -400.0, -400.0, 0, None),
        (3, "g", "d", 28.0, 60.0, 0, None),
        (4, "g", "d", 28.0, 500.0, 0, None),
    )
    rows = {r.id: r for r in isolation.score(edge, points).collect()}
    assert rows[1].classification == rows[2].classification == C.ANOMALY
    assert rows[3].score < rows[4].score < min(rows[1].score, rows[2].score)


def test_isolation_scores_equal_a_walk_down_the_trees(edge, small):
    """Against a plain walk, node by node."""
    sample = small.select("id", *C.FEATURES).limit(50)
    got = {r.id: r.score for r in isolation.score(edge, sample).collect()}
    for row in sample.collect():
        values = (row.temperature, row.humidity)
        lengths = []
        for feature, threshold, length in zip(edge.feature, edge.threshold, edge.path_length):
            node = 0
            while feature[node] != isolation.LEAF:
                node = 2 * node + (2 if values[feature[node]] > threshold[node] else 1)
            lengths.append(length[node])
        expected = 2 ** (-np.mean(lengths) / isolation.average_path(edge.sample_size))
        assert abs(got[row.id] - expected) < 1e-9


def test_trees_hold_all_their_rows(edge):
    """Leaf depths stay within the height limit and every inner node has two children."""
    for feature, length in zip(edge.feature, edge.path_length):
        inner = np.flatnonzero(feature != isolation.LEAF)
        for node in inner:
            for child in (2 * node + 1, 2 * node + 2):
                assert feature[child] != isolation.LEAF or not np.isnan(length[child])


def test_large_table_is_sampled_without_repeats_inside_a_tree(spark, medium):
    trees, size = 10, 64
    samples, got = isolation.draw_samples(medium.select("id", *C.FEATURES), 10_000, trees, size, 1, "id", ("id",))
    rows = samples.collect()
    assert got == size and len(rows) == trees * size
    assert len({(r.tree, r.id) for r in rows}) == len(rows)
    assert {t: sum(r.tree == t for r in rows) for t in range(trees)} == {t: size for t in range(trees)}


def test_small_table_is_sampled_per_tree(small):
    samples, size = isolation.draw_samples(small.select("id", *C.FEATURES), 1000, 20, 2000, 1, "id", ("id",))
    assert size == 1000
    per_tree = samples.groupBy("tree").agg(F.count("*").alias("n"), F.countDistinct("id").alias("d")).collect()
    assert len(per_tree) == 20 and {(r.n, r.d) for r in per_tree} == {(1000, 1000)}


def test_isolation_saved_and_loaded(spark, edge, small, tmp_path):
    edge.save(spark, str(tmp_path / "edge"))
    loaded = isolation.IsolationModel.load(spark, str(tmp_path / "edge"))
    assert classes(isolation.score(loaded, small)) == classes(isolation.score(edge, small))
    assert loaded.cut_off == edge.cut_off


def test_isolation_needs_rows_and_values(spark, small, edge):
    with pytest.raises(ValueError):
        isolation.train(small.filter("false"))
    with pytest.raises(Exception, match="null"):
        isolation.score(edge, small.withColumn("humidity", F.lit(None).cast("double"))).collect()


def test_fallback_until_a_forest_is_published(spark, model, edge, small, tmp_path):
    root = str(tmp_path / "models")
    before = scoring.score_with_fallback(small, root, edge)
    assert {r.model_type for r in before.select("model_type").distinct().collect()} == {scoring.EDGE}
    assert classes(before) == classes(isolation.score(edge, small))
    registry.publish(spark, model, root)
    after = scoring.score_with_fallback(small, root, edge)
    assert {r.model_type for r in after.select("model_type").distinct().collect()} == {scoring.FOREST}
    assert classes(after) == classes(forest.score(model, small))


@pytest.mark.parametrize("broken", (scoring.FOREST, scoring.EDGE))
def test_fallback_counts_need_the_classes(spark, model, edge, small, monkeypatch, broken):
    """Readings without a class from a model aren't counted for it; with wrong classes neither."""
    choose = scoring.score_with_fallback

    def wrong(*args):
        scored = choose(*args)
        return scored.withColumn("classification", F.when(F.col("model_type") != broken, F.col("classification")))

    monkeypatch.setattr(catalog.scoring, "score_with_fallback", wrong)
    rows = catalog.queries()["score_with_fallback"](spark, SMALL).collect()
    assert [r.model_type for r in rows if r.readings] == [{scoring.FOREST: scoring.EDGE, scoring.EDGE: scoring.FOREST}[broken]]
    assert [(r.readings, r.ids) for r in rows if r.readings] == [(1000, 1000)]


def test_fallback_when_the_forest_does_not_load(spark, edge, small, tmp_path):
    root = str(tmp_path / "models")
    entry = [(1, f"{root}/models/none", None)]
    spark.createDataFrame(entry, registry.REGISTRY).write.json(f"{root}/published")
    scored = scoring.score_with_fallback(small, root, edge)
    assert {r.model_type for r in scored.select("model_type").distinct().collect()} == {scoring.EDGE}


def test_outliers_do_not_spoil_the_grid(spark, medium):
    """Readings far off on both sides and in both features take a few cells, not the grid."""
    columns = C.READING.fieldNames()
    far = [
        (10**6 + k, "gw_0", "sensor_1", t, h, None, C.ANOMALY if t >= 70 else C.NORMAL)
        for k, (t, h) in enumerate([(1e6, 50.0), (-1e6, 50.0), (50.0, 1e9), (50.0, -1e9), (1e308, 1.0), (1e308, -1e308), (-1e308, 0.0)])
    ]
    readings = medium.select(*columns).unionByName(spark.createDataFrame(far, C.READING))
    assert forest.agreement(forest.train(readings), readings).first().agreement >= 0.99
    rows = forest.condense(readings).agg(F.sum("weight"), F.count("*")).first()
    assert rows[0] == readings.count() and rows[1] > 5000


def test_cells_hold_equal_shares_for_any_partitioning(medium):
    one = forest.quantile_cells(medium.repartition(3), 64).orderBy("feature", "bucket").collect()
    assert one == forest.quantile_cells(medium.repartition(11), 64).orderBy("feature", "bucket").collect()
    for feature in C.FEATURES:
        cells = {r.bucket: r.cell for r in one if r.feature == feature}
        assert list(cells.values()) == sorted(cells.values()) and 0 <= min(cells.values()) <= max(cells.values()) < 64
    counted = medium.withColumn("bucket", forest._bucket("temperature")).groupBy("bucket").count().collect()
    sizes = {}
    for r in counted:
        cell = next(c.cell for c in one if c.feature == "temperature" and c.bucket == r.bucket)
        sizes[cell] = sizes.get(cell, 0) + r["count"]
    assert max(sizes.values()) < 2 * medium.count() / 64 + max(r["count"] for r in counted)


def test_values_that_are_no_numbers_raise(spark, medium):
    for odd in (None, float("nan"), float("inf")):
        bad = medium.limit(5).withColumn("humidity", F.lit(odd).cast("double"))
        with pytest.raises(ValueError):
            forest.condense(bad)


def test_few_rows_are_hashed_more_than_once(medium):
    """Samples don't depend on the partitioning, and each task sends no more than a tree keeps."""
    rows = medium.select("id", *C.FEATURES)
    found = [isolation.draw_samples(rows.repartition(n), 10_000, 10, 64, 3, "id", ("id",)) for n in (2, 9)]
    assert Counter(found[0][0].collect()) == Counter(found[1][0].collect()) and found[0][1] == 64
    assert {r["count"] for r in found[0][0].groupBy("tree").count().collect()} == {64}
    plan = found[0][0]._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
