"""Quality rules: exact counts against fixed limits, then a calibrated n-gram model.

The model is a logistic regression on hashed word and character n-grams, trained on labelled
rows; a logistic curve fitted on other labelled rows makes its margin a probability, which a
fixed threshold turns into the verdict. Texts are scored whole, in Arrow batches.

At most ``max_rows`` labelled rows train the model (about; they are drawn by a hash of the
document id), so training costs the same at any size. Everything else covers all rows.

Defined results: null and empty texts have no words, so they fail the base rules. Very long
texts are counted and scored whole. Rows that repeat a doc_id are each judged by their own
text; in training each of them counts, with the larger label where labels differ. Without
training rows of both labels the model has no say and the base rules alone decide. An empty
table gives an empty result. Extra columns are passed over or kept as asked, whatever their
names, but for the names of the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clickmill.llm.common import (
    bounded_broadcast,
    filter_texts,
    fold,
    free_name,
    list_column,
    store,
)
from clickmill.llm.text import Texts, chunks, run_sums

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_PROBABILITY = 0.5
MAX_TRAINING_ROWS = 10_000

# Hash buckets of word n-grams (one and two words) and of character n-grams (three).
WORD_BUCKETS = 1 << 13
CHAR_BUCKETS = 1 << 13
BUCKETS = WORD_BUCKETS + CHAR_BUCKETS
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CHAR_CODE = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def word_buckets(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the word n-grams in text order, and the border of each text in them."""
    found = []
    for size in (1, 2):
        values, whole = texts.windows(size)
        at = np.flatnonzero(whole)
        borders = np.searchsorted(at, texts.first_word)
        found.append(((values[at] % np.uint64(WORD_BUCKETS)).astype(np.int32), borders))
    return found


def char_buckets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams in text order, and the border of each text in them.

    An n-gram belongs to the text it starts in; the last two of a text reach no further.
    """
    points, borders = texts.code_points()
    value = points * _CHAR_CODE[0]
    for i in (1, 2):
        value[:-i] += points[i:] * _CHAR_CODE[i]
    value ^= value >> np.uint32(15)
    inside = np.zeros(len(points), dtype=bool)
    inside[: max(len(points) - 2, 0)] = True
    last = borders[1:]
    for i in (1, 2):
        inside[last[last >= i] - i] = False
    at = np.flatnonzero(inside)
    buckets = (value[at] % np.uint32(CHAR_BUCKETS)).astype(np.int32) + WORD_BUCKETS
    return buckets, np.searchsorted(at, borders)


def _scale(borders: np.ndarray) -> np.ndarray:
    return 1 / np.maximum(np.diff(borders), 1)


def sparse_features(texts: Texts) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Bucket numbers and shares of each text; the shares of each kind of n-gram add to 1."""
    kinds = [*word_buckets(texts), char_buckets(texts)]
    indices, values = [], []
    for i in range(texts.n):
        parts = [b[x[i] : x[i + 1]] for b, x in kinds]
        weights = [np.full(len(p), 1 / max(len(p), 1)) for p in parts]
        dense = np.bincount(np.concatenate(parts), np.concatenate(weights), BUCKETS)
        at = np.flatnonzero(dense)
        indices.append(at.astype(np.int32))
        values.append(dense[at])
    return indices, values


@dataclass(frozen=True)
class RuleModel:
    """Weights by bucket, and the logistic curve over the margin; no weights: no say."""

    weights: np.ndarray | None
    intercept: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, texts: Texts) -> np.ndarray:
        total = np.full(texts.n, self.intercept)
        for buckets, borders in [*word_buckets(texts), char_buckets(texts)]:
            total += run_sums(self.weights[buckets], borders) * _scale(borders)
        return total

    def probability(self, texts: Texts) -> np.ndarray:
        if self.weights is None:
            return np.ones(texts.n)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(texts) + self.offset, -40, 40)))


def _sparse_vectors(indices: list[np.ndarray], values: list[np.ndarray]) -> pa.Array:
    """Sparse vectors of all buckets, as Spark ML stores them (kind 0)."""
    n = len(indices)
    columns = [
        pa.array(np.zeros(n, dtype=np.int8)),
        pa.array(np.full(n, BUCKETS, dtype=np.int32)),
        list_column(indices, pa.int32()),
        list_column(values, pa.float64()),
    ]
    return pa.StructArray.from_arrays(columns, ["type", "size", "indices", "values"])


def _training_rows(docs: DataFrame, labels: DataFrame, held_out: Column, max_rows: int):
    """``doc_id``, ``label`` and hashed ``features`` of the labelled rows drawn for training."""
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out)
    known = known.groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    share = min(1.0, max_rows / max(known.count(), 1))
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(9)), F.lit(1 << 20)) < int(share * (1 << 20))
    drawn = bounded_broadcast(known.filter(drawn), 16)
    rows = docs.select("doc_id", "text").join(drawn, "doc_id").select("doc_id", "label", "text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch.column(2)):
                columns = [batch.column(i)[rows] for i in (0, 1)]
                columns.append(_sparse_vectors(*sparse_features(texts)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "features"])

    names = {"doc_id": docs.schema["doc_id"].dataType, "label": DoubleType()}
    names["features"] = VectorUDT()
    return rows.mapInArrow(compute, StructType([StructField(*x) for x in names.items()]))


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column | None = None,
    max_rows: int = MAX_TRAINING_ROWS,
) -> RuleModel:
    """Train on the labelled documents outside ``held_out``; one fold calibrates."""
    held_out = F.lit(False) if held_out is None else held_out
    rows = store(_training_rows(docs, labels, held_out, max_rows), "rule-features")
    part = fold("doc_id", 5) == 4
    classes = {r["label"] for r in rows.filter(~part).select("label").distinct().collect()}
    if len(classes) < 2:
        return RuleModel(None)
    regression = LogisticRegression(maxIter=40, regParam=1e-3, standardization=False)
    model = regression.fit(rows.filter(~part))
    margin = F.array(vector_to_array("rawPrediction")[1])
    margins = model.transform(rows.filter(part)).select(
        "label", array_to_vector(margin).alias("features")
    )
    margins = margins.persist()
    try:
        if len(margins.select("label").distinct().collect()) < 2:
            return RuleModel(model.coefficients.toArray(), model.intercept)
        curve = LogisticRegression(maxIter=40, regParam=1e-3).fit(margins)
    finally:
        margins.unpersist()
    slope = max(float(curve.coefficients[0]), 1e-3)
    return RuleModel(model.coefficients.toArray(), model.intercept, slope, curve.intercept)


def rule_counts(texts: Texts) -> dict[str, np.ndarray]:
    """The exact counts that the base rules look at."""
    return {
        "n_words": texts.n_words,
        "word_chars": texts.word_chars(),
        "n_symbols": texts.count(_SYMBOL),
        "n_dup_lines": texts.duplicate_lines()[1],
        "n_repeat_words": texts.repeated_words(),
    }


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    repeated = 100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
    return (counts["n_words"] < MIN_WORDS) | repeated


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def apply_rules(docs: DataFrame, model: RuleModel, keep: list[str]) -> DataFrame:
    """``keep``, the counts, ``base_failed``, ``kept`` and ``probability`` of every document."""
    n_keep = len(keep)
    inner = free_name("text", keep)
    names = [*keep, *COUNTS, "base_failed", "kept", "probability"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch.column(n_keep)):
                counts = rule_counts(texts)
                failed = base_failed(counts)
                probability = model.probability(texts)
                kept = ~failed & (probability >= MIN_PROBABILITY)
                columns = [batch.column(i)[rows] for i in range(n_keep)]
                columns += [pa.array(counts[c].astype(np.int64)) for c in COUNTS]
                columns += [pa.array(failed), pa.array(kept), pa.array(probability)]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    schema += "".join(f", {c} long" for c in COUNTS)
    schema = f"{schema}, base_failed boolean, kept boolean, probability double".lstrip(", ")
    return docs.select(*keep, F.col("text").alias(inner)).mapInArrow(compute, schema)


def keep_passed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass base rules and model, all columns kept."""
    model = fit_rules(docs, labels, fold("doc_id", 5) == 0)

    def passes(texts: Texts) -> np.ndarray:
        failed = base_failed(rule_counts(texts))
        return ~failed & (model.probability(texts) >= MIN_PROBABILITY)

    return filter_texts(docs, passes)
