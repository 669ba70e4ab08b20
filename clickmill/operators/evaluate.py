"""ROC curves and areas of scored rows, exact and without a single-task sort."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.schema import LABEL
from clickmill.session import materialize

# Distinct scores that one task sorts.
SCORES_PER_TASK = 1_000_000


def _required(name: str) -> Column:
    """The column as double; a null or NaN has no place on a curve and fails the job."""
    value = F.col(name).cast("double")
    wrong = F.raise_error(F.lit(f"null or NaN in column {name}")).cast("double")
    return F.when(value.isNotNull() & ~F.isnan(value), value).otherwise(wrong)


def _positives(label: Column, positive_label: float) -> Column:
    return F.count_if(label == F.lit(float(positive_label))).alias("pos")


def _negatives(label: Column, positive_label: float) -> Column:
    return F.count_if(label != F.lit(float(positive_label))).alias("neg")


def score_counts(
    df: DataFrame, score: str = "score", label: str = LABEL, positive_label: float = 1.0
) -> DataFrame:
    """``(threshold, pos, neg)``: labels per distinct score.

    Rows are counted within each task first, so a score that most rows share costs no
    more than a rare one.
    """
    rows = df.select(_required(score).alias("threshold"), _required(label).alias("_label"))
    return rows.groupBy("threshold").agg(
        _positives(F.col("_label"), positive_label), _negatives(F.col("_label"), positive_label)
    )


def _in_ranges(points: DataFrame, scores_per_task: int) -> DataFrame:
    """Points with ``bucket``: ranges of about equal numbers of distinct scores.

    Spark's range partitioning draws the cuts; the partition number is written with the
    points, so every later step reads the same ranges.
    """
    buckets = math.ceil(points.count() / scores_per_task)
    if buckets <= 1:
        return points.withColumn("bucket", F.lit(0))
    ranged = points.repartitionByRange(buckets, "threshold")
    return materialize(ranged.withColumn("bucket", F.spark_partition_id()), "score-ranges")


def _cumulated(points: DataFrame, scores_per_task: int) -> DataFrame:
    """Points with ``tp``, ``fp`` at or above each score, totals and the next lower point.

    Running sums start within ranges of scores and are shifted by the sums of the ranges
    above. Where the cuts lie changes the distribution of the work, not the result.
    """
    bucketed = _in_ranges(points, scores_per_task)
    # One row per range: as many as there are sort tasks.
    falling = Window.orderBy(F.desc("bucket"))
    above = falling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("bucket")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    ranges = (
        bucketed.groupBy("bucket")
        .agg(
            F.sum("pos").alias("_pos"),
            F.sum("neg").alias("_neg"),
            F.max_by(F.struct("pos", "neg"), "threshold").alias("_first"),
        )
        .select(
            "bucket",
            F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("tp_above"),
            F.coalesce(F.sum("_neg").over(above), F.lit(0)).alias("fp_above"),
            F.sum("_pos").over(everything).alias("positives"),
            F.sum("_neg").over(everything).alias("negatives"),
            F.lead("_first").over(falling).alias("first_below"),
        )
    )
    within = Window.partitionBy("bucket").orderBy(F.desc("threshold"))
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return bucketed.join(F.broadcast(ranges), "bucket").select(
        "threshold",
        "pos",
        "neg",
        (F.sum("pos").over(running) + F.col("tp_above")).alias("tp"),
        (F.sum("neg").over(running) + F.col("fp_above")).alias("fp"),
        "positives",
        "negatives",
        F.coalesce(F.lead(F.struct("pos", "neg")).over(within), "first_below").alias("below"),
    )


def _curve(points: DataFrame, rows: DataFrame, thin: bool, origin: bool) -> DataFrame:
    """Curve from the points and their cumulated form."""
    if thin:
        # A point lies on the line between its neighbours when the step to it and the
        # step from it are the same; the first and the last point always stay.
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        last = F.col("below").isNull()
        bends = (F.col("below.pos") != F.col("pos")) | (F.col("below.neg") != F.col("neg"))
        rows = rows.where(first | last | bends)
    curve = rows.select(
        "threshold",
        F.try_divide("fp", "negatives").alias("fpr"),
        F.try_divide("tp", "positives").alias("tpr"),
    )
    if not origin:
        return curve
    start = points.agg((F.max("threshold") + 1).alias("threshold")).select(
        "threshold", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.where(F.col("threshold").isNotNull()).unionAll(curve)


def _area(rows: DataFrame) -> DataFrame:
    # Trapezoids: each score adds its negatives times the mean height of the curve there.
    height = F.try_divide(F.col("tp") - F.col("pos") / 2, "positives")
    width = F.try_divide("neg", "negatives")
    return rows.agg(F.sum(height * width).alias("auc"))


def roc_curve(
    df: DataFrame,
    score: str = "score",
    label: str = LABEL,
    positive_label: float = 1.0,
    thin: bool = False,
    origin: bool = True,
    scores_per_task: int = SCORES_PER_TASK,
) -> DataFrame:
    """``(threshold, fpr, tpr)``, one row per distinct score.

    ``origin`` adds the point (0, 0) at the highest score plus 1. ``thin`` leaves out
    points on a straight line, which changes neither the drawing nor the area. A rate
    is null when its class does not occur.
    """
    points = materialize(score_counts(df, score, label, positive_label), "score-counts")
    return _curve(points, _cumulated(points, scores_per_task), thin, origin)


def roc_auc(
    df: DataFrame,
    score: str = "score",
    label: str = LABEL,
    positive_label: float = 1.0,
    scores_per_task: int = SCORES_PER_TASK,
) -> DataFrame:
    """One row ``(auc)``; null when only one class occurs."""
    points = materialize(score_counts(df, score, label, positive_label), "score-counts")
    return _area(_cumulated(points, scores_per_task))


def _placements(cumulated: DataFrame) -> DataFrame:
    """``(threshold, pos, neg, of_pos, of_neg)``: where a row of each class stands.

    The share of negatives that a positive row of this score beats, and the share of
    positives that beat a negative one; ties count half.
    """
    beaten = F.col("negatives") - F.col("fp") + F.col("neg") / 2
    beating = F.col("tp") - F.col("pos") / 2
    return cumulated.select(
        "threshold",
        "pos",
        "neg",
        F.try_divide(beaten, "negatives").alias("of_pos"),
        F.try_divide(beating, "positives").alias("of_neg"),
    )


def _spread(weight: str, a: str, b: str) -> Column:
    """Sample covariance of two columns whose rows count ``weight`` times, over the weight."""
    n = F.sum(weight)
    joint = F.sum(F.col(weight) * F.col(a) * F.col(b))
    means = F.sum(F.col(weight) * F.col(a)) * F.sum(F.col(weight) * F.col(b))
    return F.try_divide(F.try_divide(joint - F.try_divide(means, n), n - 1), n)


def _mean_place(weight: str, place: str) -> Column:
    return F.try_divide(F.sum(F.col(weight) * F.col(place)), F.sum(weight))


def auc_uncertainty(
    df: DataFrame,
    score: str = "score",
    label: str = LABEL,
    positive_label: float = 1.0,
    z: float = 1.959964,
    scores_per_task: int = SCORES_PER_TASK,
) -> DataFrame:
    """One row ``(auc, variance, lower, upper)``: the area and how sure it is.

    The variance is that of the mean over positive rows of the share of negatives that they
    beat, plus that over negatives (DeLong's), from sums over distinct scores: no pair of
    rows is formed. Null where a class has fewer than two rows.
    """
    points = materialize(score_counts(df, score, label, positive_label), "score-counts")
    places = _placements(_cumulated(points, scores_per_task))
    row = places.agg(
        _mean_place("pos", "of_pos").alias("auc"),
        (_spread("pos", "of_pos", "of_pos") + _spread("neg", "of_neg", "of_neg")).alias("variance"),
    )
    reach = F.sqrt(F.greatest("variance", F.lit(0.0))) * z
    return row.select(
        "auc",
        "variance",
        F.greatest(F.col("auc") - reach, F.lit(0.0)).alias("lower"),
        F.least(F.col("auc") + reach, F.lit(1.0)).alias("upper"),
    )


def compare_auc(
    df: DataFrame,
    score_a: str,
    score_b: str,
    label: str = LABEL,
    positive_label: float = 1.0,
    scores_per_task: int = SCORES_PER_TASK,
) -> DataFrame:
    """One row ``(auc_a, auc_b, difference, variance, z)`` of two models on the same rows.

    The variance of the difference counts in that both models saw the same rows. Rows are
    counted per pair of scores first; each side then gets the places of its distinct scores.
    """
    rows = df.select(
        _required(score_a).alias("a"), _required(score_b).alias("b"), _required(label).alias("_l")
    )
    both = materialize(
        rows.groupBy("a", "b").agg(
            _positives(F.col("_l"), positive_label), _negatives(F.col("_l"), positive_label)
        ),
        "score-pairs",
    )
    placed = both
    for side in ("a", "b"):
        points = both.groupBy(F.col(side).alias("threshold")).agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
        )
        points = materialize(points, "score-counts")
        places = _placements(_cumulated(points, scores_per_task)).select(
            F.col("threshold").alias(side),
            F.col("of_pos").alias(f"{side}_pos"),
            F.col("of_neg").alias(f"{side}_neg"),
        )
        placed = placed.join(places, side)
    gained = placed.withColumns(
        {
            "d_pos": F.col("a_pos") - F.col("b_pos"),
            "d_neg": F.col("a_neg") - F.col("b_neg"),
        }
    )
    row = gained.agg(
        _mean_place("pos", "a_pos").alias("auc_a"),
        _mean_place("pos", "b_pos").alias("auc_b"),
        (_spread("pos", "d_pos", "d_pos") + _spread("neg", "d_neg", "d_neg")).alias("variance"),
    )
    difference = F.col("auc_a") - F.col("auc_b")
    return row.select(
        "auc_a",
        "auc_b",
        difference.alias("difference"),
        "variance",
        F.try_divide(difference, F.sqrt(F.greatest("variance", F.lit(0.0)))).alias("z"),
    )


def hard_auc(
    df: DataFrame,
    prediction: str = "prediction",
    label: str = LABEL,
    positive_label: float = 1.0,
) -> DataFrame:
    """One row ``(auc)`` of yes/no predictions taken as scores: ``(TPR + TNR) / 2``."""
    rows = df.select(_required(prediction).alias("_said"), _required(label).alias("_label"))
    said = F.col("_said") == F.lit(float(positive_label))
    positive = F.col("_label") == F.lit(float(positive_label))
    return rows.agg(
        (
            (
                F.try_divide(F.count_if(positive & said), F.count_if(positive))
                + F.try_divide(F.count_if(~positive & ~said), F.count_if(~positive))
            )
            / 2
        ).alias("auc")
    )


@dataclass
class Evaluation:
    """Summary row and ROC curve of one model on one dataset."""

    name: str
    summary: DataFrame
    curve: DataFrame

    def write(self, results_path: str, mode: str = "errorifexists") -> None:
        """Write both tables; earlier results of the same name stay unless ``mode`` says so."""
        self.summary.write.mode(mode).parquet(f"{results_path}/{self.name}/summary")
        self.curve.write.mode(mode).parquet(f"{results_path}/{self.name}/roc")


def evaluate(
    predictions: DataFrame,
    model_name: str,
    dataset_name: str = "",
    positive_label: float = 1.0,
    thin: bool = False,
    scores_per_task: int = SCORES_PER_TASK,
) -> Evaluation:
    """Curve, area, area of hard predictions and counts from one pass over the predictions.

    Rows are grouped by score once, with the labels that the predictions said yes to beside
    all labels. That table, and the running sums over it, are computed once.
    """
    positive = F.lit(float(positive_label))
    label = F.col("_label")
    scored = predictions.select(
        _required("score").alias("threshold"),
        (F.col("prediction") == positive).alias("_said"),
        _required(LABEL).alias("_label"),
    )
    counts = materialize(
        scored.groupBy("threshold").agg(
            _positives(label, positive_label),
            _negatives(label, positive_label),
            F.count_if(F.col("_said") & (label == positive)).alias("hits"),
            F.count_if(~F.col("_said") & (label != positive)).alias("rejections"),
        ),
        "score-counts",
    )
    positives, negatives = F.sum("pos"), F.sum("neg")
    hard = counts.agg(
        (positives + negatives).alias("rows"),
        positives.alias("positives"),
        (
            (
                F.try_divide(F.sum("hits"), positives)
                + F.try_divide(F.sum("rejections"), negatives)
            )
            / 2
        ).alias("hard_auc"),
    )
    points = counts.select("threshold", "pos", "neg")
    cumulated = materialize(_cumulated(points, scores_per_task), "score-sums")
    auc = _area(cumulated).scalar()
    name = f"{model_name}-{dataset_name}" if dataset_name else model_name
    summary = hard.select(
        F.lit(model_name).alias("model"),
        F.lit(dataset_name).alias("dataset"),
        "rows",
        "positives",
        auc.alias("auc"),
        "hard_auc",
    )
    return Evaluation(name, summary, _curve(points, cumulated, thin, True))
