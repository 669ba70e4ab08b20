import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from clickmill.operators import evaluate


def scored(spark, rows):
    return spark.createDataFrame([(float(s), int(l)) for s, l in rows], "score double, label int")


def brute_curve(rows, positive=1):
    positives = sum(l == positive for _, l in rows)
    negatives = len(rows) - positives
    points = [(max(s for s, _ in rows) + 1, 0.0, 0.0)]
    for cut in sorted({s for s, _ in rows}, reverse=True):
        tp = sum(l == positive for s, l in rows if s >= cut)
        fp = sum(l != positive for s, l in rows if s >= cut)
        points.append((cut, fp / negatives, tp / positives))
    return points


def brute_thin(rows):
    """Curve without the points whose step in and step out are equal."""
    cuts = sorted({s for s, _ in rows}, reverse=True)
    steps = [
        (sum(l != 1 for s, l in rows if s == cut), sum(l == 1 for s, l in rows if s == cut))
        for cut in cuts
    ]
    full = brute_curve(rows)
    kept = [
        point
        for n, point in enumerate(full[1:])
        if n in (0, len(cuts) - 1) or steps[n] != steps[n + 1]
    ]
    return [full[0], *kept]


def collected(curve):
    return [tuple(row) for row in curve.orderBy(F.desc("threshold")).collect()]


@pytest.fixture(scope="module")
def tied_rows():
    rng = random.Random(8)
    # A third of all rows share one score; the others crowd in a narrow range.
    return [
        (0.25 if rng.random() < 1 / 3 else round(0.2 + rng.random() / 10, 3), rng.randrange(2))
        for _ in range(600)
    ]


@pytest.mark.parametrize("scores_per_task", [1_000_000, 40, 3])
def test_curve_equals_brute_force(spark, tied_rows, scores_per_task):
    curve = evaluate.roc_curve(scored(spark, tied_rows), scores_per_task=scores_per_task)
    assert collected(curve) == brute_curve(tied_rows)
    assert curve.columns == ["threshold", "fpr", "tpr"]


@pytest.mark.parametrize("scores_per_task", [1_000_000, 40, 3])
def test_thin_curve_equals_brute_force(spark, tied_rows, scores_per_task):
    rows = tied_rows + [(2.0 + n / 100, 1) for n in range(30)]
    curve = evaluate.roc_curve(scored(spark, rows), thin=True, scores_per_task=scores_per_task)
    thin = collected(curve)
    assert thin == brute_thin(rows)
    area = sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(thin, thin[1:]))
    full = evaluate.roc_auc(scored(spark, rows)).first()["auc"]
    assert area == pytest.approx(full)


def test_ranges_hold_similar_numbers_of_scores(spark, tied_rows):
    points = evaluate.score_counts(scored(spark, tied_rows))
    sizes = [r["count"] for r in evaluate._in_ranges(points, 10).groupBy("bucket").count().collect()]
    assert len(sizes) > 5 and max(sizes) <= 30


@pytest.mark.parametrize("scores_per_task", [1_000_000, 25])
def test_area_equals_the_library_evaluator(spark, tied_rows, scores_per_task):
    rows = scored(spark, tied_rows)
    ours = evaluate.roc_auc(rows, scores_per_task=scores_per_task).first()["auc"]
    vectors = rows.select(
        array_to_vector(F.array(1 - F.col("score"), "score")).alias("rawPrediction"),
        F.col("label").cast("double").alias("label"),
    )
    theirs = BinaryClassificationEvaluator(numBins=0).evaluate(vectors)
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_area_of_the_other_label(spark, tied_rows):
    rows = scored(spark, tied_rows)
    one = evaluate.roc_auc(rows).first()["auc"]
    zero = evaluate.roc_auc(rows, positive_label=0.0).first()["auc"]
    assert one + zero == pytest.approx(1.0)


def test_hard_area_equals_the_library_evaluator(spark):
    rng = random.Random(1)
    data = [(rng.randrange(2), rng.randrange(2)) for _ in range(300)]
    rows = spark.createDataFrame([(float(p), float(l)) for p, l in data], "prediction double, label double")
    vectors = rows.select(
        array_to_vector(F.array(1 - F.col("prediction"), "prediction")).alias("rawPrediction"), "label"
    )
    theirs = BinaryClassificationEvaluator(numBins=0).evaluate(vectors)
    assert evaluate.hard_auc(rows).first()["auc"] == pytest.approx(theirs, abs=1e-12)


def test_one_class_has_no_area(spark):
    rows = scored(spark, [(0.1, 1), (0.2, 1)])
    assert evaluate.roc_auc(rows).first()["auc"] is None
    assert [r["fpr"] for r in evaluate.roc_curve(rows, origin=False).collect()] == [None, None]
    assert evaluate.hard_auc(rows.withColumn("prediction", F.lit(1.0))).first()["auc"] is None


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_scores_fail(spark, bad):
    rows = spark.createDataFrame([(0.1, 1), (bad, 0)], "score double, label int")
    with pytest.raises(Exception):
        evaluate.roc_auc(rows).collect()


def test_evaluate_agrees_with_its_parts(spark, tied_rows, tmp_path):
    rows = scored(spark, tied_rows).withColumn("prediction", (F.col("score") > 0.25).cast("double"))
    result = evaluate.evaluate(rows, "Model", "test")
    summary = result.summary.first()
    assert (summary["model"], summary["dataset"], summary["rows"]) == ("Model", "test", 600)
    assert summary["positives"] == sum(l for _, l in tied_rows)
    assert summary["auc"] == pytest.approx(evaluate.roc_auc(rows).first()["auc"])
    assert summary["hard_auc"] == pytest.approx(evaluate.hard_auc(rows).first()["auc"])
    assert collected(result.curve) == brute_curve(tied_rows)
    result.write(str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "Model-test" / "roc")).count() == len(brute_curve(tied_rows))


def placements(pairs):
    """Mean and variance of the area by counting all pairs of a positive and a negative."""
    pos = [s for s, l in pairs if l == 1]
    neg = [s for s, l in pairs if l != 1]
    beats = lambda a, b: (a > b) + (a == b) / 2
    return (
        [sum(beats(p, n) for n in neg) / len(neg) for p in pos],
        [sum(beats(p, n) for p in pos) / len(pos) for n in neg],
    )


def variance(values):
    mean = sum(values) / len(values)
    return sum((v - mean) ** 2 for v in values) / (len(values) - 1) / len(values)


@pytest.mark.parametrize("scores_per_task", [1_000_000, 7])
def test_uncertainty_and_difference_equal_pair_counts(spark, scores_per_task):
    rng = random.Random(11)
    rows = []
    for _ in range(300):
        label = int(rng.random() < 0.4)
        rows.append((label, float(rng.randrange(12) + 3 * label), round(rng.random() + label, 1)))
    df = spark.createDataFrame(rows, "label int, a double, b double")
    a_pos, a_neg = placements([(a, l) for l, a, _ in rows])
    b_pos, b_neg = placements([(b, l) for l, _, b in rows])
    (row,) = evaluate.auc_uncertainty(df, "a", scores_per_task=scores_per_task).collect()
    assert row["auc"] == pytest.approx(sum(a_pos) / len(a_pos))
    assert row["variance"] == pytest.approx(variance(a_pos) + variance(a_neg))
    assert row["lower"] < row["auc"] < row["upper"] <= 1.0
    (row,) = evaluate.compare_auc(df, "a", "b", scores_per_task=scores_per_task).collect()
    d_pos = [x - y for x, y in zip(a_pos, b_pos)]
    d_neg = [x - y for x, y in zip(a_neg, b_neg)]
    assert row["difference"] == pytest.approx(sum(d_pos) / len(d_pos))
    assert row["variance"] == pytest.approx(variance(d_pos) + variance(d_neg))
    assert row["z"] == pytest.approx(row["difference"] / row["variance"] ** 0.5)


def test_a_model_does_not_differ_from_itself_and_one_class_has_no_area(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.5), (1, 0.4), (0, 0.1)], "label int, a double")
    (row,) = evaluate.compare_auc(df, "a", "a").collect()
    assert (row["difference"], row["variance"], row["z"]) == (0.0, 0.0, None)
    (row,) = evaluate.auc_uncertainty(df.where("label = 1"), "a").collect()
    assert row["auc"] is None and row["variance"] is None
