"""Train on one dataset, score and evaluate on another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from clickmill.operators.encode import FEATURES, fit_features, to_features
from clickmill.operators.evaluate import Evaluation, evaluate
from clickmill.operators.model import MODEL_NAMES, TRAINERS, score
from clickmill.schema import ENCODED_CAT_COLS, INT_COLS, LABEL
from clickmill.session import materialize
from clickmill.sources.catalog import read_dataset

# Per mode the training set, the test set and the models that are scored.
MODES = {
    "debug": ("debug", "debug", ("lr", "rf")),
    "test": ("train_5m", "test_3m", ("lr", "rf")),
    "validate": ("train_5m", "validation_2m", ("lr", "rf")),
    "production": ("train_5m", "test", ("rf",)),
}


@dataclass
class Run:
    encoding: PipelineModel
    models: dict[str, PipelineModel] = field(default_factory=dict)
    predictions: dict[str, DataFrame] = field(default_factory=dict)
    scores: dict[str, DataFrame] = field(default_factory=dict)
    evaluations: dict[str, Evaluation] = field(default_factory=dict)


def run(
    train: DataFrame,
    test: DataFrame,
    models: Sequence[str] = ("lr", "rf"),
    int_columns: Sequence[str] = INT_COLS,
    cat_columns: Sequence[str] = ENCODED_CAT_COLS,
    impute: str = "truncate",
    dataset_name: str = "",
    evaluated: bool = True,
    scores_kept: bool = False,
) -> Run:
    """Encode, train the named models and evaluate each on ``test``.

    The columns used and the encoded training rows are computed once: the fit and every
    model read them several times. Without
    ``evaluated`` no row of ``test`` is read before its predictions are asked for. With
    ``scores_kept`` labels, predictions and scores of every model are computed once for all
    their readers, the evaluation among them.
    """
    used = [LABEL, *int_columns, *cat_columns]
    train = materialize(train.select(*used), "train")
    encoding = fit_features(train, int_columns, cat_columns, impute)
    train_features = materialize(to_features(encoding, train), "train-features")
    test_features = to_features(encoding, test.select(*used))
    if evaluated and len(models) > 1:
        test_features = materialize(test_features, "test-features")
    result = Run(encoding)
    for short in models:
        model = TRAINERS[short](train_features)
        scored = score(model, test_features)
        result.models[short] = model
        result.predictions[short] = scored.select(
            FEATURES, LABEL, "prediction", "probability", "score"
        )
        result.scores[short] = scored.select(LABEL, "prediction", "score")
        if scores_kept:
            scored = result.scores[short] = materialize(result.scores[short], "scores")
        if evaluated:
            result.evaluations[short] = evaluate(scored, MODEL_NAMES[short], dataset_name)
    return result


def run_mode(
    spark: SparkSession,
    root: str,
    mode: str = "test",
    files: Mapping[str, str] | None = None,
    validate: bool = False,
    int_columns: Sequence[str] = INT_COLS,
    cat_columns: Sequence[str] = ENCODED_CAT_COLS,
    **options,
) -> Run:
    """``run`` on the named datasets of a mode below ``root``.

    The training log is parsed once, into a table of the columns that the passes of the
    fit read. ``files`` names datasets that lie elsewhere, see ``dataset_paths``. Within
    ``session.intermediate_tables`` the tables go when the block ends.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; known: {', '.join(MODES)}")
    train_name, test_name, models = MODES[mode]
    train = read_dataset(spark, root, train_name, files, validate)
    test = read_dataset(spark, root, test_name, files, validate)
    options.setdefault("models", models)
    return run(
        train,
        test,
        int_columns=int_columns,
        cat_columns=cat_columns,
        dataset_name=test_name,
        **options,
    )
