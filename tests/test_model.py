import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickmill.operators import model


def frame(spark, labels, points):
    rows = [(float(l), Vectors.dense([float(x) for x in p])) for l, p in zip(labels, points)]
    return spark.createDataFrame(rows, ["label", "features"])


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(2)
    points = rng.random((400, 3))
    labels = (points[:, 0] + 0.3 * rng.standard_normal(400) > 0.8).astype(int)
    return labels, points, frame(spark, labels, points)


def test_label_index(spark):
    rows = frame(spark, [1, 1, 0], [[0], [1], [2]])
    assert model.index_labels(rows).labels == ["1.0", "0.0"]
    tied = frame(spark, [1, 0], [[0], [1]])
    assert model.index_labels(tied).labels == ["0.0", "1.0"]


def test_logistic_regression_reaches_the_optimum(noisy):
    labels, points, data = noisy
    fitted = model.train_lr(data, max_iter=200).stages[0]
    # Newton's method on the same loss: the penalty applies to standardized features.
    scale = points.std(axis=0, ddof=1)
    x = np.hstack([points / scale, np.ones((len(points), 1))])
    penalty = np.diag([0.01] * 3 + [0.0])
    weights = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ weights))
        gradient = x.T @ (p - labels) / len(x) + penalty @ weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(x) + penalty
        weights -= np.linalg.solve(hessian, gradient)
    assert fitted.coefficients.toArray() == pytest.approx(weights[:3] / scale, rel=1e-3)
    assert fitted.intercept == pytest.approx(weights[3], rel=1e-3)


def test_training_parameters(noisy):
    fitted = model.train_lr(noisy[2]).stages[0]
    assert (fitted.getMaxIter(), fitted.getRegParam()) == (10, 0.01)
    forest = model.train_rf(noisy[2]).stages[-1]
    assert (forest.getNumTrees, forest.getMaxDepth(), forest.getSeed()) == (3, 2, 0)


def step(x):
    return int(x >= 100) if x % 7 else int(x < 100)


def segments(x):
    return int(70 <= x < 130)


@pytest.mark.parametrize("depth, label_of", [(1, step), (2, segments)])
def test_forest_equals_a_classifier_that_merges_no_leaves(spark, depth, label_of):
    # All neighbouring leaves predict different labels.
    data = frame(spark, [label_of(x) for x in range(200)], [[x, 200 - x] for x in range(200)])
    fitted = model.train_rf(data, depth=depth)
    indexed = model.index_labels(data).transform(data)
    classifier = RandomForestClassifier(labelCol="indexed", numTrees=3, maxDepth=depth, seed=0)
    theirs = classifier.fit(indexed)
    assert theirs.totalNumNodes == fitted.stages[-1].totalNumNodes > 6
    for name in ("probability", "rawPrediction"):
        p = [r[0].toArray() for r in model.score(fitted, data).select(name).collect()]
        q = [r[0].toArray() for r in theirs.transform(indexed).select(name).collect()]
        assert np.allclose(p, q)


def test_forest_keeps_the_probabilities_of_rare_clicks(spark):
    rng = np.random.default_rng(4)
    points = rng.random((2000, 2))
    labels = (rng.random(2000) < 0.05 + 0.3 * (points[:, 0] > 0.5)).astype(int)
    data = frame(spark, labels, points)
    scored = model.score(model.train_rf(data), data)
    assert scored.select("prediction").distinct().collect() == [(0.0,)]
    assert scored.select("score").distinct().count() > 3


@pytest.mark.parametrize("trainer", ["lr", "rf"])
@pytest.mark.parametrize("majority", [0, 1])
def test_score_is_the_probability_of_the_positive_label(spark, trainer, majority):
    points = [[x] for x in range(100)]
    # Large x means label 1; which label is more frequent must not matter.
    border = 70 if majority == 0 else 30
    data = frame(spark, [int(x >= border) for x in range(100)], points)
    scored = model.score(model.TRAINERS[trainer](data), data).orderBy(F.desc("score"))
    rows = scored.select("label", "prediction", "score", vector_to_array("probability").alias("p")).collect()
    assert rows[0]["label"] == 1.0 and rows[-1]["label"] == 0.0
    assert rows[0]["score"] > 0.5 > rows[-1]["score"]
    assert rows[0]["prediction"] == 1.0 and rows[-1]["prediction"] == 0.0
    assert all(sum(row["p"]) == pytest.approx(1.0) for row in rows)
    assert "indexed" not in scored.columns


def test_scoring_keeps_rows_with_labels_never_seen(spark):
    data = frame(spark, [0, 1, 1], [[0], [1], [2]])
    unseen = frame(spark, [5, 1], [[0], [1]])
    assert model.score(model.train_rf(data), unseen).count() == 2


def test_forest_refuses_more_than_two_labels(spark):
    with pytest.raises(ValueError):
        model.train_rf(frame(spark, [0, 1, 2], [[0], [1], [2]]))


@pytest.mark.parametrize("trainer", ["lr", "rf"])
def test_saved_model_scores_the_same(noisy, tmp_path, trainer):
    fitted = model.TRAINERS[trainer](noisy[2])
    model.save_model(fitted, str(tmp_path / "m"))
    loaded = model.load_model(str(tmp_path / "m"))
    before = [r[0] for r in model.score(fitted, noisy[2]).select("score").collect()]
    after = [r[0] for r in model.score(loaded, noisy[2]).select("score").collect()]
    assert before == after


def test_preview_is_limited(noisy):
    scored = model.score(model.train_lr(noisy[2]), noisy[2])
    assert model.preview(scored).count() == 100
    assert model.preview(scored, 3).columns == ["features", "label", "prediction", "probability"]


def test_many_training_rows_are_dealt_out_to_more_tasks(spark, monkeypatch):
    rows = spark.range(90).coalesce(2)
    assert model._dealt(rows) is rows
    monkeypatch.setattr(model, "TRAINING_ROWS_PER_TASK", 10)
    dealt = model._dealt(rows)
    assert dealt.rdd.getNumPartitions() == 9 and dealt.distinct().count() == 90


def test_a_task_with_far_more_training_rows_than_others_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(model, "TRAINING_ROWS_PER_TASK", 10)
    key = F.when(F.col("id") < 60, -1).otherwise(F.col("id"))
    # As many tasks as the rows need, but most rows have one key and lie in one of them.
    rows = spark.range(90).repartition(9, key).persist()
    few = spark.range(30).coalesce(1)
    for skewed, tasks in ((rows, 9), (few, 3)):
        dealt = model._dealt(skewed)
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 20 and sum(sizes) == skewed.count()
        assert dealt.rdd.getNumPartitions() == tasks and dealt.distinct().count() == sum(sizes)
    rows.unpersist()
    even = spark.range(0, 90, 1, 9)
    assert model._dealt(even) is even
    assert model._dealt(spark.range(0)).count() == 0
