"""Counts, moments and histograms of wide tables in as few passes as possible.

Per-column questions are answered for all columns at once: columns are stacked below
each other (``unpivot``) and grouped together, or aggregated side by side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.functions import (
    equal_width_bin,
    text_value,
    value_rate,
)
from clickmill.schema import CAT_COLS, INT_COLS, LABEL
from clickmill.session import materialize

# An aggregate over more than spark.sql.codegen.maxFields (default 100) buffers runs
# without generated code, about ten times slower. The four moments of a column take 14
# buffers, its bounds 2, so wide requests are cut into groups that stay below 100.
# Each group scans its own columns only: a columnar source reads every byte once.
MOMENT_GROUP = 7
BOUNDS_GROUP = 45
# Parts of a column that its most frequent values are first ranked in.
TOP_PARTS = 64
# Parts of a column whose largest counts bound the counts that are ranked.
BOUND_PARTS = 1024


def _groups(columns: Sequence[str], size: int) -> list[list[str]]:
    return [list(columns[start : start + size]) for start in range(0, len(columns), size)]


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionAll(frame)
    return result


def column_at(df: DataFrame, position: int) -> DataFrame:
    """The column at a 0-based position."""
    return df.select(df.columns[position])


def integer_columns(df: DataFrame) -> DataFrame:
    return df.select(*[name for name in df.columns if name in INT_COLS])


def categorical_columns(df: DataFrame) -> DataFrame:
    return df.select(*[name for name in df.columns if name in CAT_COLS])


def non_null(df: DataFrame, column: str) -> DataFrame:
    """Values of one column without nulls."""
    return df.select(column).where(F.col(column).isNotNull())


def row_count(df: DataFrame) -> DataFrame:
    """One row ``(row_count)``; nulls count."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def _stacked(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """Rows ``(position, value)`` with the values as text, behind the columns to ``keep``.

    Columns go by their number, which is shorter in every row and key than their name.
    """
    texts = F.array(*[text_value(df, name) for name in columns])
    return df.select(*keep, F.posexplode(texts).alias("position", "value"))


def _name_at(columns: Sequence[str]) -> Column:
    return F.array(*map(F.lit, columns))[F.col("position")].alias("column")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_distinct)``; null counts as one value.

    Every task first reduces its rows to distinct pairs, so a value that fills the
    table still crosses the shuffle once per task.
    """
    columns = list(columns or df.columns)
    pairs = _stacked(df, columns).distinct()
    counts = pairs.groupBy("position").agg(F.count(F.lit(1)).alias("n_distinct"))
    return counts.select(_name_at(columns), "n_distinct")


def category_counts(
    df: DataFrame, columns: Sequence[str] = CAT_COLS, ordered: bool = False
) -> DataFrame:
    """``(column, value, count)`` for all columns in one shuffle; null is a value."""
    stacked = _stacked(df, columns)
    kind = stacked.schema["value"].dataType
    if kind == T.StringType():
        # Equal texts have equal bytes, and most values are new to a task: as bytes they skip
        # the small table for few groups that Spark tries before the large one.
        stacked = stacked.withColumn("value", F.col("value").cast("binary"))
    counts = (
        stacked.groupBy("position", "value")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(_name_at(list(columns)), F.col("value").cast(kind).alias("value"), "count")
    )
    if ordered:
        return counts.orderBy("column", F.desc("count"), F.asc_nulls_last("value"))
    return counts


def number_in_order(ordered: DataFrame, column: str = "column") -> DataFrame:
    """Add ``rank``: the place of a row among those of its ``column`` as they come.

    No task numbers a whole column: a row's place in its own task is in its id, and the
    rows that the tasks before have of the column are added, from one count per task and
    column.
    """
    # The high bits of the id are the task, the low 33 the row in it. Written once, so
    # that the counts and the rows have the same ids.
    come = materialize(
        ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered-rows"
    )
    task, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    rows = come.withColumns({"_task": task, "_place": place})
    runs = rows.groupBy(column, "_task").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per task and column.
    before = Window.partitionBy(column).orderBy("_task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = runs.select(
        F.col(column).alias("_column"),
        F.col("_task").alias("_of"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = rows[column].eqNullSafe(shifts["_column"]) & (rows["_task"] == shifts["_of"])
    rank = (F.col("_place") + F.col("_shift")).cast("int").alias("rank")
    return rows.join(F.broadcast(shifts), same).select(*ordered.columns, rank)


def value_rates(df: DataFrame, columns: Sequence[str] = CAT_COLS) -> DataFrame:
    """``(column, value, count, rate)``; the rate is a share of all rows."""
    # The counts of any one column add up to the rows, so the rows are not counted again.
    counts = materialize(category_counts(df, columns), "category-counts")
    rows = counts.where(F.col("column") == list(columns)[0]).agg(F.sum("count")).scalar()
    return counts.withColumn("rate", value_rate(F.col("count"), rows))


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values per column and one row for all others.

    Input is ``category_counts``. Output is ``(column, rank, value, count, is_other)``;
    the rest has rank ``n + 1``, value null and ``is_other`` true, so neither a null
    category nor one called "Other" can be mistaken for it. Ties go by value, null last.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    # Most values of a column with many are out before anything is sorted.
    bounded = counts.join(F.broadcast(_bounds(counts, n)), "column")
    promising = bounded.where(F.col("count") >= F.col("least")).drop("least")
    # Ties can be many. Ranked in parts of a column first, so that no task sorts all its
    # values; the final rank sees n values of each part. For small n, Spark cuts every task
    # to n rows of a part before the shuffle.
    part = F.pmod(F.xxhash64("value"), F.lit(TOP_PARTS)).cast("int")
    best = _ranked(promising.withColumn("part", part), n, "column", "part").drop("part", "rank")
    return _with_rest(_ranked(best, n, "column"), n)


def _bounds(counts: DataFrame, n: int) -> DataFrame:
    """``(column, total, least)``: one row per column with a count that ``n`` values reach.

    The largest count of each of many parts of a column belongs to another value, so the
    n-th largest of them is reached by n values, and only those can be among the first n.
    It is 0 where fewer parts have values.
    """
    part = F.pmod(F.xxhash64("value"), F.lit(max(BOUND_PARTS, 4 * n))).alias("part")
    parts = counts.groupBy("column", part).agg(
        F.max("count").alias("best"), F.sum("count").alias("total")
    )
    nth = F.get(F.sort_array(F.collect_list("best"), asc=False), F.lit(n - 1))
    return parts.groupBy("column").agg(
        F.sum("total").alias("total"), F.coalesce(nth, F.lit(0)).alias("least")
    )


def _ranked(counts: DataFrame, n: int, *keys: str) -> DataFrame:
    """The ``n`` most frequent values of each key with their rank."""
    by_count = Window.partitionBy(*keys).orderBy(F.desc("count"), F.asc_nulls_last("value"))
    return counts.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= n)


def _with_rest(top: DataFrame, n: int) -> DataFrame:
    """Ranked values with the ``total`` of their column, and a row for the rest."""
    top = top.withColumn("top_count", F.sum("count").over(Window.partitionBy("column")))
    kept = F.struct("rank", "value", "count", F.lit(False).alias("is_other"))
    rest = F.struct(
        F.lit(n + 1).alias("rank"),
        F.lit(None).cast("string").alias("value"),
        (F.col("total") - F.col("top_count")).alias("count"),
        F.lit(True).alias("is_other"),
    )
    rows = F.when(F.col("rank") == 1, F.array(kept, rest)).otherwise(F.array(kept))
    return top.select("column", F.inline(rows))


def numeric_means(
    df: DataFrame, columns: Sequence[str] = INT_COLS, rounded: bool = False
) -> DataFrame:
    """``(column, mean)``; ``rounded`` rounds half away from zero."""

    def mean(name: str):
        average = F.avg(name)
        return F.round(average) if rounded else average

    parts = []
    for group in _groups(columns, BOUNDS_GROUP):
        means = df.agg(*[mean(name).alias(name) for name in group])
        parts.append(means.unpivot([], group, "column", "mean"))
    return _union(parts)


def numeric_stats(df: DataFrame, columns: Sequence[str] = INT_COLS) -> DataFrame:
    """``(column, mean, stddev, skewness, kurtosis)``, nulls skipped.

    Sample standard deviation, population skewness, population excess kurtosis.
    """
    moments = {"mean": F.avg, "stddev": F.stddev, "skewness": F.skewness, "kurtosis": F.kurtosis}
    parts = []
    for group in _groups(columns, MOMENT_GROUP):
        one_row = df.agg(
            *[
                F.struct(*[moment(column).alias(name) for name, moment in moments.items()])
                .alias(column)
                for column in group
            ]
        )
        rows = F.array(
            *[F.struct(F.lit(column).alias("column"), f"{column}.*") for column in group]
        )
        parts.append(one_row.select(F.inline(rows)))
    return _union(parts)


def _is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def _without_nan(df: DataFrame, name: str):
    column = F.col(name)
    return F.when(~F.isnan(column), column) if _is_float(df, name) else column


# Text of a bin by its edges, short for axes or with thousands grouped.
BIN_LABELS = {
    "scientific": "{lower:.1E}---{upper:.2E}",
    "grouped": "{lower:,.3f} - {upper:,.0f}",
}


def histograms(
    df: DataFrame,
    columns: Sequence[str] = INT_COLS,
    bins: int = 10,
    labels: str | None = None,
) -> DataFrame:
    """Equal-width histograms ``(column, bin, lower, upper, count, total)``.

    Bins span the range of each column, are half-open with a closed last one, and appear
    even when empty. Nulls and NaN are skipped; a constant column has one bin and a
    column without values none. ``labels`` names a form of ``BIN_LABELS`` for one more
    column ``bin_label``.
    """
    if bins < 1:
        raise ValueError("bins must be at least 1")
    return _union([_histograms(df, group, bins, labels) for group in _groups(columns, BOUNDS_GROUP)])


def _histograms(
    df: DataFrame, columns: list[str], bins: int, labels: str | None
) -> DataFrame:
    values = df.select(*[_without_nan(df, name).alias(name) for name in columns])
    # Two numbers per column, whatever the number of rows.
    row = values.agg(
        *[
            F.struct(F.min(name).alias("lo"), F.max(name).alias("hi")).alias(name)
            for name in columns
        ]
    ).first()
    bounds = {name: (row[name]["lo"], row[name]["hi"]) for name in columns}
    filled = [name for name in columns if bounds[name][0] is not None]
    for name in filled:
        if not all(math.isfinite(bound) for bound in bounds[name]):
            raise ValueError(f"column {name!r} has infinite values: its range has no bins")

    def index_of(name: str):
        numbers = [F.col(name), F.lit(bounds[name][0]), F.lit(bounds[name][1])]
        if not _is_float(df, name) and bounds[name][1] - bounds[name][0] >= 2**63:
            # The difference of two such integers is none.
            numbers = [number.cast("decimal(20,0)") for number in numbers]
        return equal_width_bin(*numbers, bins).alias(name)

    # 13 columns x 10 bins are 130 groups, reduced to as many rows within each task.
    indexes = values.select(*[index_of(name) for name in filled])
    text = BIN_LABELS[labels] if labels else ""
    edges = "column string, bin int, lower double, upper double, bin_label string"
    grid = df.sparkSession.createDataFrame(
        [
            (name, index, float(lower), float(upper), text.format(lower=lower, upper=upper))
            for name in filled
            for index, (lower, upper) in enumerate(
                pairwise(histogram_edges(*bounds[name], bins))
            )
        ],
        edges,
    )
    if filled:
        found = (
            indexes.select(
                F.posexplode(F.array(*map(F.col, filled))).alias("position", "bin")
            )
            .where(F.col("bin").isNotNull())
            .groupBy("position", "bin")
            .agg(F.count(F.lit(1)).alias("count"))
            .select(_name_at(filled), "bin", "count")
        )
        # At most one row per column and bin on either side.
        joined = grid.join(found, ["column", "bin"], "left")
    else:
        joined = grid.withColumn("count", F.lit(0).cast("bigint"))
    count = F.coalesce("count", F.lit(0))
    return joined.select(
        "column",
        "bin",
        "lower",
        "upper",
        count.alias("count"),
        F.sum(count).over(Window.partitionBy("column")).alias("total"),
        *(["bin_label"] if labels else []),
    )


def histogram_edges(lo: float, hi: float, bins: int = 10) -> list[float]:
    """Edges of an equal-width histogram; the last one is exactly ``hi``."""
    if lo == hi:
        return [lo, hi]
    width = (hi - lo) / bins
    return [index * width + lo for index in range(bins)] + [hi]


def fixed_histogram(
    df: DataFrame, column: str = LABEL, edges: Sequence[float] = (0, 1, 2)
) -> DataFrame:
    """Histogram over given edges: ``(bin, lower, upper, count)``, last bin closed.

    Values outside the edges, nulls and NaN are not counted.
    """
    edges = list(edges)
    if len(edges) < 2 or any(low >= high for low, high in zip(edges, edges[1:])):
        raise ValueError("edges must be two or more increasing numbers")
    value = F.col(column)
    last = len(edges) - 2
    # Largest bin whose lower edge is not above the value.
    inside = (value >= edges[0]) & (value <= edges[-1])
    index = F.lit(0)
    for position in range(1, last + 1):
        index = index + (value >= edges[position]).cast("int")
    found = (
        df.select(F.when(inside, index).alias("bin"))
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    grid = df.sparkSession.range(last + 1).select(F.col("id").cast("int").alias("bin"))
    literal = F.array(*[F.lit(float(edge)) for edge in edges])
    return grid.join(found, "bin", "left").select(
        "bin",
        literal[F.col("bin")].alias("lower"),
        literal[F.col("bin") + 1].alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )
