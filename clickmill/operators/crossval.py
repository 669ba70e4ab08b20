"""Cross-validation by subtraction: statistics per fold once, every training set by difference.

The encoding that fold k is scored with is learned on all other folds. Counts and sums of a
union of folds are those of all rows less those of the fold left out, and bounds are the
bounds of the remaining folds, so one pass over the log gives the statistics per fold and with
them the encodings of all k training sets: k folds cost the scans of one, and no row's own
fold has a part in its encoding.

Per category value there is one row with an array of its counts in every fold. A row that is
looked up gets the array of its k rates, from which the features under any of the k encodings
are taken.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.functions import md5_uniform, rate_column
from clickmill.operators.encode import FEATURES
from clickmill.operators.evaluate import roc_auc
from clickmill.operators.lookup import ENTRY_BYTES, free_name, lookup_values
from clickmill.operators.model import TRAINING_ROWS_PER_TASK, score, train_lr
from clickmill.operators.profile import _groups, _name_at, _stacked
from clickmill.operators.split import row_key
from clickmill.schema import ENCODED_CAT_COLS, INT_COLS, LABEL
from clickmill.session import files_per_task, materialize, write_parts

FOLD = "fold"

# Encoded rows of one fold in a file, and files that a training task reads.
ROWS_PER_FILE = 100_000
FILES_PER_TASK = TRAINING_ROWS_PER_TASK // ROWS_PER_FILE


def with_folds(
    df: DataFrame, folds: int = 5, key: Column | None = None, salt: str = ""
) -> DataFrame:
    """Add ``fold``, 0 to ``folds - 1``, by a hash of the row or of ``key``.

    The same on any cluster; equal keys are in one fold, so no copy of a row is in the
    training set of the fold it is scored in.
    """
    text = key if key is not None else row_key(df)
    if salt:
        text = F.concat(text, F.lit(salt))
    return df.withColumn(FOLD, F.floor(md5_uniform(text) * folds).cast("int"))


def fold_sizes(df: DataFrame, folds: int) -> list[int]:
    """Rows of every fold."""
    found = dict(df.groupBy(FOLD).agg(F.count(F.lit(1))).collect())
    return [found.get(fold, 0) for fold in range(folds)]


def fold_counts(df: DataFrame, columns: Sequence[str], folds: int) -> DataFrame:
    """``(column, value, counts)``: rows per fold of every value; null is a value.

    One shuffle for all columns and folds, of as many rows as a count of all rows needs.
    """
    stacked = _stacked(df, columns, FOLD)
    per_fold = [
        F.count_if(F.col(FOLD) == fold).alias(f"n{fold}") for fold in range(folds)
    ]
    counts = stacked.groupBy("position", "value").agg(*per_fold)
    return counts.select(
        _name_at(list(columns)),
        "value",
        F.array(*[F.col(f"n{fold}") for fold in range(folds)]).alias("counts"),
    )


def _others(values: Column, total: Column, fold: int) -> Column:
    return total - values[fold]


def held_out_rates(counts: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``(column, value, rates)``: per fold, the share of the value in all other folds.

    0.0 where the other folds have no rows.
    """
    rows = sum(sizes)
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    rates = [
        _others(F.col("counts"), total, fold).cast("double") / F.lit(float(rows - size))
        if rows > size
        else F.lit(0.0)
        for fold, size in enumerate(sizes)
    ]
    return counts.select("column", "value", F.array(*rates).alias("rates"))


@dataclass
class NumberStats:
    """Mean and bounds of an integer column in the training set of every fold."""

    means: list[float | None]
    lows: list[int | None]
    highs: list[int | None]
    has_null: list[bool]


def number_stats(
    df: DataFrame, columns: Sequence[str], folds: int
) -> dict[str, NumberStats]:
    """Statistics of all training sets from sums, counts and bounds per fold."""
    found: dict[str, list] = {}
    for group in _groups(columns, 19):
        rows = df.groupBy(FOLD).agg(
            F.count(F.lit(1)).alias("rows"),
            *[
                F.struct(
                    F.sum(F.col(name).cast("double")).alias("sum"),
                    F.count(name).alias("values"),
                    F.min(name).alias("lo"),
                    F.max(name).alias("hi"),
                ).alias(name)
                for name in group
            ],
        )
        by_fold = {row[FOLD]: row for row in rows.collect()}
        for name in group:
            found[name] = [
                (by_fold[fold]["rows"], *by_fold[fold][name]) if fold in by_fold else
                (0, None, 0, None, None)
                for fold in range(folds)
            ]
    return {name: _subtracted(parts) for name, parts in found.items()}


def _subtracted(parts: list) -> NumberStats:
    stats = NumberStats([], [], [], [])
    rows = sum(part[0] for part in parts)
    total = sum(part[1] or 0.0 for part in parts)
    values = sum(part[2] for part in parts)
    for fold, (own_rows, own_sum, own_values, _, _) in enumerate(parts):
        left = values - own_values
        others = [part for at, part in enumerate(parts) if at != fold and part[2]]
        stats.means.append((total - (own_sum or 0.0)) / left if left else None)
        stats.lows.append(min((part[3] for part in others), default=None))
        stats.highs.append(max((part[4] for part in others), default=None))
        stats.has_null.append(left < rows - own_rows)
    return stats


def rates_column(name: str) -> str:
    return f"{rate_column(name)}s"


def _rate_in_array(name: str, fold: int) -> Column:
    return F.col(rates_column(name))[fold]


@dataclass
class FoldEncoding:
    """The encodings of all training sets."""

    folds: int
    sizes: list[int]
    rates: DataFrame
    rate_bounds: dict[str, list[tuple[float, float]]]
    numbers: dict[str, NumberStats]
    int_columns: list[str]
    cat_columns: list[str]

    def encode(self, df: DataFrame, **options) -> DataFrame:
        """Add ``<column>_rates``, the array of a value's rates under every encoding."""
        return lookup_values(
            df,
            self.cat_columns,
            self.rates,
            "rates",
            rates_column,
            F.array(*[F.lit(0.0)] * self.folds),
            entry_bytes=ENTRY_BYTES + 8 * self.folds,
            **options,
        )

    def features(
        self, fold: int, rate: Callable[[str, int], Column] = _rate_in_array
    ) -> Column:
        """Scaled features of an encoded row under the encoding without ``fold``.

        Nulls of integers become the mean cut to an integer; all features are scaled by the
        bounds of the training set, constant ones to 0.5. ``rate`` finds the rate of a
        column under an encoding.
        """
        scaled = []
        for name in self.int_columns:
            stats = self.numbers[name]
            mean, low, high = (x[fold] for x in (stats.means, stats.lows, stats.highs))
            fill = 0 if mean is None else int(mean)
            if low is None:
                low = high = fill
            elif stats.has_null[fold]:
                low, high = min(low, fill), max(high, fill)
            value = F.coalesce(F.col(name), F.lit(fill)).cast("double")
            scaled.append(_min_max(value, float(low), float(high)))
        for name in self.cat_columns:
            value = rate(name, fold)
            scaled.append(_min_max(value, *self.rate_bounds[name][fold]))
        return array_to_vector(F.array(*scaled))


def _min_max(value: Column, low: float, high: float) -> Column:
    return (value - low) / (high - low) if high > low else F.lit(0.5)


def fit_folds(
    df: DataFrame,
    folds: int,
    int_columns: Sequence[str] = INT_COLS,
    cat_columns: Sequence[str] = ENCODED_CAT_COLS,
) -> FoldEncoding:
    """Encodings without each fold, in one pass over the categories and one over the integers."""
    sizes = fold_sizes(df, folds)
    counts = materialize(fold_counts(df, cat_columns, folds), "fold-counts")
    rates = held_out_rates(counts, sizes)
    # Values that the training set has, so that none of a fold's own is a bound.
    bounds = rates.groupBy("column").agg(
        *[F.min(F.when(F.col("rates")[f] > 0, F.col("rates")[f])).alias(f"lo{f}")
          for f in range(folds)],
        *[F.max(F.col("rates")[f]).alias(f"hi{f}") for f in range(folds)],
    )
    rate_bounds = {
        row["column"]: [(row[f"lo{f}"] or 0.0, row[f"hi{f}"] or 0.0) for f in range(folds)]
        for row in bounds.collect()
    }
    for name in cat_columns:
        rate_bounds.setdefault(name, [(0.0, 0.0)] * folds)
    numbers = number_stats(df, int_columns, folds) if int_columns else {}
    return FoldEncoding(
        folds, sizes, rates, rate_bounds, numbers, list(int_columns), list(cat_columns)
    )


def cross_validate(
    df: DataFrame,
    folds: int = 5,
    train: Callable[[DataFrame], PipelineModel] = train_lr,
    int_columns: Sequence[str] = INT_COLS,
    cat_columns: Sequence[str] = ENCODED_CAT_COLS,
    label: str = LABEL,
    key: Column | None = None,
    salt: str = "",
) -> DataFrame:
    """Every row scored by the model of the other folds: ``df`` with ``fold`` and ``score``.

    Rows are encoded once for all folds, into files by fold with a column per rate: a
    model's passes read the numbers of its own encoding, and a row is read for its score
    once. A fold whose training set is empty fails, as no model can be fitted.
    """
    spark = df.sparkSession
    marked = materialize(with_folds(df, folds, key, salt), "folds")
    encoding = fit_folds(marked, folds, int_columns, cat_columns)
    prefix = free_name(marked, "_rate")

    def rate(name: str, fold: int) -> Column:
        return F.col(f"{prefix}_{fold}_{name}")

    rates = [
        _rate_in_array(name, fold).alias(f"{prefix}_{fold}_{name}")
        for fold in range(folds)
        for name in cat_columns
    ]
    encoded = write_parts(
        encoding.encode(marked).select(*marked.columns, *rates),
        "fold-rates", FOLD, folds, ROWS_PER_FILE,
    )
    scored = []
    for fold in range(folds):
        if not encoding.sizes[fold]:
            continue
        features = encoded.withColumn(FEATURES, encoding.features(fold, rate)).withColumn(
            LABEL, F.col(label).cast("double")
        )
        with files_per_task(spark, FILES_PER_TASK):
            fitted = train(features.where(F.col(FOLD) != fold).select(LABEL, FEATURES))
        held_out = features.where(F.col(FOLD) == fold)
        scored.append(score(fitted, held_out).select(*marked.columns, "score"))
    result = scored[0]
    for part in scored[1:]:
        result = result.unionAll(part)
    return result


def fold_areas(scored: DataFrame, folds: int, label: str = LABEL) -> DataFrame:
    """``(fold, rows, auc)`` of scored rows; folds without rows are left out."""
    parts = []
    for fold, rows in enumerate(fold_sizes(scored, folds)):
        if rows:
            area = roc_auc(scored.where(F.col(FOLD) == fold), "score", label)
            parts.append(area.select(F.lit(fold).alias(FOLD), F.lit(rows).alias("rows"), "auc"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result
