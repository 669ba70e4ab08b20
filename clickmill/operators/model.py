"""Click models: logistic regression and random forest on encoded features."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.operators.encode import FEATURES
from clickmill.schema import LABEL

INDEXED = "indexed"
INDEX_ONE = "index_one"

# Training parameters of the two models.
LR_MAX_ITER = 10
LR_REG_PARAM = 0.01
RF_TREES = 3
RF_DEPTH = 2
RF_SEED = 0

# Rows of a training task: about 90 MB as a forest keeps them, with 15 features.
TRAINING_ROWS_PER_TASK = 500_000


def index_labels(df: DataFrame, label: str = LABEL) -> StringIndexerModel:
    """Label index by falling frequency, ties by label; for ``label`` -> ``indexed``."""
    return StringIndexer(inputCol=label, outputCol=INDEXED).fit(df)


def _dealt(features: DataFrame) -> DataFrame:
    """Training rows in tasks that do not grow with them: training keeps its tasks' rows in
    memory and reads them once a pass. Few rows stay as they are, and so do rows that come
    in enough tasks, unless one task has far more than its share."""
    sizes = features.groupBy(F.spark_partition_id()).count()
    # One number per task that has rows.
    found = sizes.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("tasks"),
        F.coalesce(F.max("count"), F.lit(0)).alias("largest"),
    ).first()
    tasks = math.ceil(found["rows"] / TRAINING_ROWS_PER_TASK)
    enough = max(features.sparkSession.sparkContext.defaultParallelism, found["tasks"])
    if tasks <= enough and found["largest"] <= 2 * TRAINING_ROWS_PER_TASK:
        return features
    return features.repartition(tasks)


def train_lr(
    features: DataFrame, max_iter: int = LR_MAX_ITER, reg_param: float = LR_REG_PARAM
) -> PipelineModel:
    estimator = LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=max_iter, regParam=reg_param
    )
    return PipelineModel([estimator.fit(_dealt(features))])


def train_rf(
    features: DataFrame,
    trees: int = RF_TREES,
    depth: int = RF_DEPTH,
    seed: int = RF_SEED,
    bootstrap: bool = True,
) -> PipelineModel:
    """Random forest on two indexed labels, kept together with the index it was trained on.

    The classifier of recent Spark releases merges sibling leaves that predict the same
    label. Clicks are rare, so that is nearly every pair, and the merged leaves lose the
    probabilities that a ROC curve ranks by: a forest of depth 2 shrinks to one constant.
    Trees grown on the 0/1 index as a number split at the same places, because the variance
    of a 0/1 variable is half its Gini impurity, and keep every leaf; the mean of a leaf is
    the probability of index 1.
    """
    # Before the index, which collects every label there is.
    seen = features.select(LABEL).distinct().limit(3).collect()
    if len(seen) > 2:
        raise ValueError(f"expected two labels, found {', '.join(str(row[0]) for row in seen)}")
    indexer = index_labels(features)
    estimator = RandomForestRegressor(
        featuresCol=FEATURES,
        labelCol=INDEXED,
        predictionCol=INDEX_ONE,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        bootstrap=bootstrap,
        featureSubsetStrategy="sqrt" if trees > 1 else "all",
    )
    forest = estimator.fit(indexer.transform(_dealt(features)))
    # Scoring must not fail on or drop a row whose label training never saw.
    return PipelineModel([indexer.setHandleInvalid("keep"), forest])


TRAINERS = {"lr": train_lr, "rf": train_rf}
# The forest is one of regression trees, see train_rf.
MODEL_NAMES = {"lr": "LogisticRegression", "rf": "RandomForestOfRegressionTrees"}


def class_labels(model: PipelineModel) -> list[float]:
    """Label behind every position of the probability vector."""
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            return [float(text) for text in stage.labels]
    return [float(position) for position in range(model.stages[-1].numClasses)]


def score(model: PipelineModel, features: DataFrame, positive_label: float = 1.0) -> DataFrame:
    """Add ``rawPrediction``, ``probability``, ``prediction`` and ``score``.

    ``prediction`` is a label, also where the model works on label indexes, and ``score``
    the probability of the positive label.
    """
    labels = class_labels(model)
    scored = model.transform(features)
    forest = model.stages[-1]
    if isinstance(forest, RandomForestRegressionModel):
        one = F.col(INDEX_ONE)
        trees = F.lit(float(forest.getNumTrees))
        scored = scored.withColumns(
            {
                # Votes of the trees, as a classifying forest reports them.
                "rawPrediction": array_to_vector(F.array((1 - one) * trees, one * trees)),
                "probability": array_to_vector(F.array(1 - one, one)),
                "prediction": (one > 0.5).cast("double"),
            }
        ).drop(INDEXED, INDEX_ONE)
    if positive_label in labels:
        positive = vector_to_array("probability")[labels.index(positive_label)]
    else:
        positive = F.lit(0.0)
    by_index = F.array(*[F.lit(label) for label in labels])
    return scored.withColumns(
        {"score": positive, "prediction": by_index[F.col("prediction").cast("int")]}
    )


def preview(predictions: DataFrame, n: int = 100) -> DataFrame:
    """Some predictions to look at, in no particular order."""
    return predictions.select(FEATURES, LABEL, "prediction", "probability").limit(n)


def save_model(model: Transformer, path: str, overwrite: bool = False) -> None:
    """Save a model; an existing one is replaced only if asked for."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
