"""Quality classifier: regularised quadratic discriminant over document statistics.

Every document becomes a vector of transformed statistics of its whole text. Each class of
labelled documents has a mean and a covariance, shrunk towards the pooled covariance and a
scaled identity; the score is the difference of the two log densities, made a probability by
a logistic curve fitted on other labelled rows. Means and covariances are sums over all
training rows, added up within tasks first; the driver sees two vectors and two matrices.

Defined results: null and empty texts have the statistics of a text without words and are
scored like any other; documents without a label are scored only; a null label takes no
part in training; a document labelled more than once counts once per label row. Without
training rows of both classes every score is the share of label 1 (0.5 if there is no
label). Very long texts are measured whole; rows that repeat a doc_id are each scored by their
own text; an empty table gives an empty result. Extra columns are passed over or kept as asked,
whatever their names, but for those of the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import (
    array_column,
    bounded_broadcast,
    filter_texts,
    fold,
    free_name,
    store,
    sum_arrays,
)
from clickmill.llm.text import Texts, chunks, mix, run_sums

THRESHOLD = 0.3
PAD_CHARS, PAD_WORDS = 100, 10


def _table(characters: bytes | range) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters)] = True
    return table


_UPPER = _table(range(ord("A"), ord("Z") + 1))
_DIGIT = _table(b"0123456789")
_SYMBOL = _table(b"#*$%&|<>")
_STOP = _table(b".!?")
_COMMA = _table(b",;:")
_BANG = _table(b"!")
_OTHER = _table(b"{}[]()/\\=_+~^@\"'`-")


def statistics(texts: Texts) -> np.ndarray:
    """Transformed statistics of each text: one row per text, bounded and about symmetric."""
    n_words = texts.n_words
    words = np.maximum(n_words, 1)
    # Shares of short texts are drawn towards 0: one number is no sign of a bad text.
    chars = np.diff(texts.offsets) + PAD_CHARS
    padded = n_words + PAD_WORDS
    lengths = texts.ends - texts.starts
    lines, repeated_lines = texts.duplicate_lines()
    per_line = np.maximum(lines, 1)

    text = texts.text_of_word()
    same = np.zeros(len(text), dtype=bool)
    same[1:] = (texts.words[1:] == texts.words[:-1]) & (text[1:] == text[:-1])
    doubled = run_sums(same, texts.first_word)
    _, first = np.unique(texts.words ^ mix(text.astype(np.uint64)), return_index=True)
    distinct = np.bincount(text[first], minlength=texts.n)
    long_word = run_sums(lengths > 20, texts.first_word)
    squares = run_sums(lengths.astype(np.float64) ** 2, texts.first_word)
    mean_length = run_sums(lengths, texts.first_word) / words
    spread = np.sqrt(np.maximum(squares / words - mean_length**2, 0) * n_words / padded)
    marked = run_sums(
        _SYMBOL[texts.data[texts.ends - 1]] | _BANG[texts.data[texts.ends - 1]], texts.first_word
    )

    def share(table: np.ndarray, of: np.ndarray = chars) -> np.ndarray:
        return np.log1p(200 * texts.count(table) / of)

    columns = [
        np.log1p(n_words),
        np.log1p(lines),
        np.log1p(n_words / per_line),
        mean_length,
        spread,
        np.log1p(200 * long_word / padded),
        share(_UPPER),
        share(_DIGIT),
        share(_SYMBOL),
        share(_STOP, padded),
        share(_COMMA, padded),
        share(_BANG),
        share(_OTHER),
        np.log1p(200 * marked / padded),
        np.log1p(200 * texts.repeated_words() / padded),
        np.log1p(200 * repeated_lines / per_line),
        np.log1p(200 * doubled / padded),
        distinct / np.sqrt(words),
    ]
    return np.column_stack(columns).astype(np.float64)


DIMENSION = len(statistics(Texts(np.zeros(0, dtype=np.uint8), np.zeros(2, dtype=np.int64)))[0])

# Log-density differences are cut here before calibration; beyond it a class is certain.
LIMIT = 60.0
# Differences are counted in bins this wide to fit the logistic curve.
BIN = 0.5


@dataclass(frozen=True)
class QualityModel:
    """Class means, inverse Cholesky factors of the class covariances, and the curve."""

    means: np.ndarray
    whitening: np.ndarray
    log_volumes: np.ndarray
    slope: float
    intercept: float
    constant: float | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of label 1 minus that of label 0, from Mahalanobis distances."""
        densities = [
            -0.5 * np.square((x - self.means[k]) @ self.whitening[k].T).sum(axis=1)
            - self.log_volumes[k]
            for k in (0, 1)
        ]
        return np.clip(densities[1] - densities[0], -LIMIT, LIMIT)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-(self.slope * self.difference(x) + self.intercept)))


def features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the statistics of each text as ``features``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for _, t in chunks(batch.column(len(keep)))]
            x = np.concatenate(rows) if rows else np.zeros((0, DIMENSION))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], array_column(x)], [*keep, "features"]
            )

    asked = docs.select(*keep, F.col(text).alias(free_name("_text", keep)))
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    return asked.mapInArrow(compute, f"{schema}, features array<double>")


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Rows, sum and sum of squares of ``features`` by label, added up within tasks."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + DIMENSION + DIMENSION**2))
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSION)
            for k in (0, 1):
                own = x[label == k]
                sums[k, 0] += len(own)
                sums[k, 1 : 1 + DIMENSION] += own.sum(axis=0)
                sums[k, 1 + DIMENSION :] += (own.T @ own).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), array_column(sums)], ["label", "sums"]
        )

    partial = rows.select(F.col("label").cast("int"), "features")
    partial = partial.mapInArrow(compute, "label int, sums array<double>")
    found = {0: None, 1: None}
    for label, values in sum_arrays(partial, "label", "sums").items():
        n = max(values[0], 1.0)
        mean = values[1 : 1 + DIMENSION] / n
        scatter = values[1 + DIMENSION :].reshape(DIMENSION, DIMENSION) / n
        found[label] = (values[0], mean, scatter - np.outer(mean, mean))
    none = (0.0, np.zeros(DIMENSION), np.zeros((DIMENSION, DIMENSION)))
    return {k: v or none for k, v in found.items()}


def _logistic_curve(x: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps, with a weak pull to slope 0.1 and intercept 0."""
    beta = np.array([0.1, 0.0])
    prior, pull = beta.copy(), np.array([1e2, 1.0])
    design = np.column_stack([x, np.ones_like(x)])
    total = ones + zeros
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        gradient = design.T @ (ones - total * p) - pull * (beta - prior)
        hessian = (design * (total * p * (1 - p))[:, None]).T @ design + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit_quality(labelled: DataFrame, shrinkage: float = 0.6, ridge: float = 0.1) -> QualityModel:
    """Model of rows ``label`` (0 or 1), ``features`` and ``calibrate`` (boolean).

    Rows to calibrate fit the logistic curve, all others the densities. A class covariance
    moves towards the pooled one by ``shrinkage`` and more if it has few rows, then towards
    the pooled variances by ``ridge``.
    """
    labelled = labelled.filter(F.col("label").isin(0, 1))
    parts = _moments(labelled.filter(~F.col("calibrate")))
    rows = np.array([parts[0][0], parts[1][0]])
    empty = np.zeros((2, DIMENSION))
    if not rows.all():
        share = (rows[1] + 1) / (rows.sum() + 2) if not rows.any() else rows[1] / rows.sum()
        return QualityModel(empty, np.zeros((2, DIMENSION, DIMENSION)), rows, 0, 0, float(share))
    pooled = sum(n * c for n, _, c in parts.values()) / rows.sum()
    variances = np.diag(np.maximum(np.diag(pooled), 1e-4))
    whitening, volumes = [], []
    for n, _, own in parts.values():
        weight = min(1.0, shrinkage + DIMENSION / (DIMENSION + n))
        mixed = (1 - weight) * own + weight * pooled
        factor = np.linalg.cholesky((1 - ridge) * mixed + ridge * variances)
        whitening.append(np.linalg.inv(factor))
        volumes.append(np.log(np.diag(factor)).sum())
    means = np.array([parts[0][1], parts[1][1]])
    model = QualityModel(means, np.array(whitening), np.array(volumes), 1.0, 0.0)

    binned = _differences(labelled.filter("calibrate"), model)
    counts = binned.groupBy("bin").pivot("label", [0, 1]).count().na.fill(0).collect()
    if not counts:
        return model
    bins, zeros, ones = (np.array(c, dtype=float) for c in zip(*counts, strict=True))
    slope, intercept = _logistic_curve(bins * BIN, ones, zeros)
    return QualityModel(means, model.whitening, model.log_volumes, slope, intercept)


def _differences(rows: DataFrame, model: QualityModel) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSION)
            bins = np.round(model.difference(x) / BIN).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bins)], ["label", "bin"])

    return rows.select(F.col("label").cast("int"), "features").mapInArrow(
        compute, "label int, bin int"
    )


def score_features(rows: DataFrame, model: QualityModel, keep: list[str]) -> DataFrame:
    """``keep`` and ``score`` of rows that have ``features``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(len(keep)).flatten().to_numpy(zero_copy_only=False)
            score = model.score(x.reshape(-1, DIMENSION))
            columns = [*batch.columns[: len(keep)], pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "score"])

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.select(*keep).dtypes)
    return rows.select(*keep, "features").mapInArrow(compute, f"{schema}, score double")


def label_features(statistics_table: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """Training rows: statistics of the labelled documents outside ``held_out``.

    A further fold of the document ids is set aside to calibrate.
    """
    known = labels.select("doc_id", F.col("quality").alias("label")).filter("label is not null")
    rows = statistics_table.select("doc_id", "features").filter(~held_out)
    rows = rows.join(known, "doc_id")
    return rows.select("label", "features", (fold("doc_id", 5) == 4).alias("calibrate"))


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every document.

    Documents whose fold is 0 are held out of training.
    """
    held_out = fold("doc_id", 5) == 0
    table = store(features(docs, ["doc_id"]), "quality-features")
    model = fit_quality(label_features(table, labels, held_out))
    scored = score_features(table, model, ["doc_id"])
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier predicts good, all columns kept."""
    held_out = fold("doc_id", 5) == 0
    known = bounded_broadcast(labels.select("doc_id").distinct(), 8)
    trained = features(docs.join(known, "doc_id", "left_semi"), ["doc_id"])
    trained = store(trained, "quality-features")
    model = fit_quality(label_features(trained, labels, held_out))
    return filter_texts(docs, lambda texts: model.score(statistics(texts)) >= THRESHOLD)
