"""Profiles that grow with the log: mergeable states per part, written once and united.

A day of the log is scanned when it comes, its states are written beside those of earlier
days, and the profile of all days is put together from the states without reading any log
line again. States of numbers are counts, means, the sums of the second to fourth powers of
the distances from the mean, and bounds; those of categories are value counts, or sketches of
their distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.operators.profile import MOMENT_GROUP, _groups, _name_at, _stacked, category_counts
from clickmill.schema import CAT_COLS, INT_COLS

PART = "part"
# Sketches of 2^15 registers err by 0.6 % of the distinct values.
SKETCH_BITS = 15


def number_states(df: DataFrame, columns: Sequence[str] = INT_COLS) -> DataFrame:
    """``(column, n, mean, m2, m3, m4, lo, hi)`` of one part, nulls skipped.

    ``m2`` to ``m4`` are sums of powers of the distances from the mean.
    """
    states = None
    for group in _groups(columns, MOMENT_GROUP):
        row = df.agg(*[_number_state(name).alias(name) for name in group])
        rows = F.array(*[F.struct(F.lit(name).alias("column"), f"{name}.*") for name in group])
        found = row.select(F.inline(rows))
        states = found if states is None else states.unionAll(found)
    n, m2 = F.col("n"), F.coalesce(F.col("variance") * F.col("n"), F.lit(0.0))
    # Skewness and kurtosis of a constant column are NaN or null; its powers are 0.
    third = F.when(m2 > 0, F.col("skewness") * F.pow(m2, 1.5) / F.sqrt(n)).otherwise(0.0)
    fourth = F.when(m2 > 0, (F.col("kurtosis") + 3) * m2 * m2 / n).otherwise(0.0)
    return states.select(
        "column", "n", "mean", m2.alias("m2"), third.alias("m3"), fourth.alias("m4"), "lo", "hi"
    )


def _number_state(name: str) -> Column:
    return F.struct(
        F.count(name).alias("n"),
        F.avg(name).alias("mean"),
        F.var_pop(name).alias("variance"),
        F.skewness(name).alias("skewness"),
        F.kurtosis(name).alias("kurtosis"),
        F.min(name).cast("double").alias("lo"),
        F.max(name).cast("double").alias("hi"),
    )


def merge_numbers(states: DataFrame) -> DataFrame:
    """One state per column from those of any parts.

    Each part is moved from its own mean to the common one; a column without values keeps a
    state of count 0.
    """
    totals = states.groupBy("column").agg(
        F.sum("n").alias("total"),
        F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("common"),
    )
    # One row per column.
    moved = states.join(F.broadcast(totals), "column")
    n, m2, m3, m4 = (F.col(name) for name in ("n", "m2", "m3", "m4"))
    d = F.coalesce(F.col("mean") - F.col("common"), F.lit(0.0))
    return moved.groupBy("column").agg(
        F.max("total").alias("n"),
        F.max("common").alias("mean"),
        F.sum(m2 + n * d * d).alias("m2"),
        F.sum(m3 + 3 * d * m2 + n * d * d * d).alias("m3"),
        F.sum(m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d).alias("m4"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )


def stats_of_states(states: DataFrame) -> DataFrame:
    """``(column, mean, stddev, skewness, kurtosis)`` as ``numeric_stats`` gives them."""
    merged = merge_numbers(states)
    n, m2 = F.col("n"), F.col("m2")
    return merged.select(
        "column",
        "mean",
        F.when(n > 0, F.sqrt(F.try_divide(m2, n - 1))).alias("stddev"),
        F.try_divide(F.sqrt(n) * F.col("m3"), F.pow(m2, 1.5)).alias("skewness"),
        (F.try_divide(n * F.col("m4"), m2 * m2) - 3).alias("kurtosis"),
    )


def merge_counts(counts: DataFrame) -> DataFrame:
    """``(column, value, count)`` from the category counts of any parts."""
    return counts.groupBy("column", "value").agg(F.sum("count").alias("count"))


def distinct_sketches(
    df: DataFrame, columns: Sequence[str] = CAT_COLS, bits: int = SKETCH_BITS
) -> DataFrame:
    """``(column, sketch, has_null)``: what is needed to estimate distinct values.

    A sketch takes at most 2^bits bytes, whatever it has seen. Null counts as a value, as in
    ``distinct_counts``, and is kept beside the sketch.
    """
    found = _stacked(df, columns).groupBy("position").agg(
        F.hll_sketch_agg("value", bits).alias("sketch"),
        F.max(F.col("value").isNull()).alias("has_null"),
    )
    return found.select(_name_at(list(columns)), "sketch", "has_null")


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch per column from those of any parts."""
    return sketches.groupBy("column").agg(
        F.hll_union_agg("sketch").alias("sketch"), F.max("has_null").alias("has_null")
    )


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``(column, estimate)`` of the distinct values of all parts, null included."""
    merged = merge_sketches(sketches)
    return merged.select(
        "column",
        (F.hll_sketch_estimate("sketch") + F.col("has_null").cast("long")).alias("estimate"),
    )


class ProfileStore:
    """States of the parts of a log below one folder; a part that is added again replaces
    its earlier states.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(
        self,
        part: str,
        df: DataFrame,
        int_columns: Sequence[str] = INT_COLS,
        cat_columns: Sequence[str] = CAT_COLS,
    ) -> None:
        """Scan one part of the log and write its states."""
        if int_columns:
            self._write(number_states(df, int_columns), "numbers", part)
        if cat_columns:
            self._write(category_counts(df, cat_columns), "counts", part)
            self._write(distinct_sketches(df, cat_columns), "sketches", part)

    def _write(self, states: DataFrame, kind: str, part: str) -> None:
        states.write.mode("overwrite").parquet(f"{self.path}/{kind}/{PART}={part}")

    def _read(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{kind}").drop(PART)

    def numeric_stats(self) -> DataFrame:
        return stats_of_states(self._read("numbers"))

    def category_counts(self) -> DataFrame:
        return merge_counts(self._read("counts"))

    def distinct_estimates(self) -> DataFrame:
        return distinct_estimates(self._read("sketches"))
