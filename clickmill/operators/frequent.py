"""Frequent values of many columns by mergeable summaries, proven by an exact recount.

Counting all values of a hashed column sends every distinct value over the network to keep
ten of them. Here every task reduces a column to a frequent-items summary of fixed size, and
the summaries are merged. A summary over N rows that tracks t values errs by at most
e = 3.5 * 0.75 * N / t; it names every value whose count is above 2 e, and none of the others
can be more frequent than that. So few candidates are counted exactly in a second pass, which
shuffles no more than the candidates of each task, and the n-th of them is compared with what
any other value can have at most. Columns for which that is no proof, because no value stands
out, are counted in full.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.functions import text_value
from clickmill.operators.profile import (
    _name_at,
    _ranked,
    _stacked,
    _with_rest,
    category_counts,
    top_categories,
)
from clickmill.schema import CAT_COLS
from clickmill.session import materialize

# Values that a summary tracks: three quarters of a table of 8192 entries.
TRACKED = 6144
# Largest error as a share of the rows, times the tracked values.
_ERROR_TIMES_TRACKED = 3.5 * 0.75
# Summaries of a column that are merged before the last merge.
MERGE_PARTS = 32


def most_missed(rows: int, tracked: int = TRACKED) -> int:
    """The most rows that a value can hold which a summary does not name."""
    return math.floor(2 * _ERROR_TIMES_TRACKED * rows / tracked)


def _hash(value: Column) -> Column:
    """Number of a text; null stays null."""
    return F.when(value.isNotNull(), F.xxhash64(value))


def summaries(
    df: DataFrame, columns: Sequence[str], tracked: int = TRACKED, hashed: bool = False
) -> DataFrame:
    """``(position, rows, state)``: one summary per column, null being a value.

    Of the texts, or of their hashes, which are cheaper to track.

    Summaries have a bounded number of values, however many there are. They are merged in
    two steps, so that no task reads those of all tasks. The columns are reduced side by side:
    stacked below each other, every value would be a row that looks for its summary.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)).alias("part")
    texts = [text_value(df, name) for name in columns]
    values = df.select(
        *[(_hash(text) if hashed else text).alias(f"v{at}") for at, text in enumerate(texts)]
    )
    states = [
        F.expr(f"approx_top_k_accumulate({name}, {int(tracked)})").alias(name)
        for name in values.columns
    ]
    parts = values.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), *states)
    stacked = parts.select("rows", F.posexplode(F.array(*values.columns)).alias("position", "state"))
    return stacked.groupBy("position").agg(
        F.sum("rows").alias("rows"),
        F.expr("approx_top_k_combine(state)").alias("state"),
    )


def named_values(merged: DataFrame, most: int) -> DataFrame:
    """``(position, rows, value, estimate)``: up to ``most`` named values per column.

    An estimate is never below the count and above it by at most the error.
    """
    named = F.expr(f"approx_top_k_estimate(state, {int(most)})")
    return merged.select("position", "rows", F.inline(named).alias("value", "estimate"))


def _promising(named: DataFrame, n: int, most: int, tracked: int) -> dict[int, int]:
    """Per column that a recount may prove: what a value left out can have at most."""
    ranked = named.withColumn(
        "place", F.row_number().over(Window.partitionBy("position").orderBy(F.desc("estimate")))
    )
    # One row per column.
    columns = ranked.groupBy("position").agg(
        F.max("rows").alias("rows"),
        F.count(F.lit(1)).alias("named"),
        F.sum("estimate").alias("covered"),
        F.min("estimate").alias("least"),
        F.max(F.when(F.col("place") == n, F.col("estimate"))).alias("nth"),
    )
    found = {}
    for row in columns.collect():
        left_out = most_missed(row["rows"], tracked)
        if row["named"] >= most:
            left_out = max(left_out, row["least"])
        if row["covered"] >= row["rows"] or (row["nth"] or 0) > left_out:
            found[row["position"]] = left_out
    return found


def _recounted(
    df: DataFrame, columns: Sequence[str], named: DataFrame, positions: list[int]
) -> DataFrame:
    """``(position, value, named, count)``: exact counts of named values, and of all others.

    Values are named by their text or their ``hash``; all texts of a named hash are named.
    Named values are few: at most a fixed number per column is sent to every task. Only the
    columns at ``positions`` are read.
    """
    if "hash" not in named.columns:
        named = named.withColumn("hash", _hash(F.col("value")))
    at = F.array(*map(F.lit, positions))
    kept = named.where(F.col("position").isin(positions)).select(
        (F.array_position(at, F.col("position")) - 1).cast("int").alias("_position"),
        F.col("hash").alias("_hash"),
    )
    # Looked up by one number for position and hash, and both compared where it is found; as
    # conditions that are no keys, or the lookup would be by three columns.
    kept = kept.withColumn("_key", F.xxhash64("_position", "_hash"))
    rows = _stacked(df, [columns[position] for position in positions])
    rows = rows.withColumn("hash", _hash(F.col("value")))
    same = F.col("_hash") == F.col("hash")
    same = F.coalesce(same, F.col("_hash").isNull() & F.col("hash").isNull())
    same &= F.col("position").between(F.col("_position"), F.col("_position"))
    same &= F.xxhash64("position", "hash") == F.col("_key")
    found = rows.join(F.broadcast(kept), same, "left")
    found = found.withColumn("named", F.col("_key").isNotNull()).select(
        "position", F.when(F.col("named"), F.col("value")).alias("value"), "named"
    )
    counts = found.groupBy("position", "value", "named").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("position", at[F.col("position")])


def frequent_categories(
    df: DataFrame,
    columns: Sequence[str] = CAT_COLS,
    n: int = 10,
    tracked: int = TRACKED,
) -> DataFrame:
    """``top_categories`` of all columns without shuffling all their values.

    The same rows, exactly: ``(column, rank, value, count, is_other)``, ties by value, null
    last. A column is proven if its n-th candidate is more frequent than any value that is
    no candidate can be, or if the candidates cover all its rows; the others are counted in
    full, all in one pass.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    columns = list(columns)
    most = 4 * n
    tracked = max(tracked, most)
    # A value can have no more rows than its hash, so what is left out has the same bound.
    merged = summaries(df, columns, tracked, hashed=True)
    named = named_values(merged, most).withColumnRenamed("value", "hash")
    named = materialize(named, "named-values")
    promising = _promising(named, n, most, tracked)
    proven: list[int] = []
    if promising:
        counts = materialize(
            _recounted(df, columns, named, list(promising)), "candidate-counts"
        )
        proven = _proven(counts, n, promising)
    parts = []
    if proven:
        own = counts.where(F.col("position").isin(proven)).withColumn("column", _name_at(columns))
        totals = own.groupBy("column").agg(F.sum("count").alias("total"))
        candidates = own.where("named").select("column", "value", "count")
        candidates = candidates.join(F.broadcast(totals), "column")
        parts.append(_with_rest(_ranked(candidates, n, "column"), n))
    rest = [name for at, name in enumerate(columns) if at not in proven]
    if rest:
        parts.append(top_categories(category_counts(df, rest), n))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _proven(counts: DataFrame, n: int, left_out: dict[int, int]) -> list[int]:
    """Columns whose n-th candidate beats every value that is none, from one row each."""
    place = F.row_number().over(
        Window.partitionBy("position", "named").orderBy(F.desc("count"))
    )
    columns = counts.withColumn("place", place).groupBy("position").agg(
        F.coalesce(F.sum(F.when(~F.col("named"), F.col("count"))), F.lit(0)).alias("others"),
        F.max(F.when(F.col("named") & (F.col("place") == n), F.col("count"))).alias("nth"),
    )
    return [
        row["position"]
        for row in columns.collect()
        if row["others"] == 0
        or (row["nth"] or 0) > min(left_out[row["position"]], row["others"])
    ]


def frequent_share(
    df: DataFrame, columns: Sequence[str], share: float, tracked: int = TRACKED
) -> DataFrame:
    """``(position, value, estimate)``: every value with at least ``share`` of the rows.

    A summary that errs by less than half the share names all of them, and at most as many
    others as its error allows. Null is left out.
    """
    tracked = max(tracked, math.ceil(2 * _ERROR_TIMES_TRACKED / share) if share > 0 else tracked)
    most = min(tracked, 1_000_000)
    named = named_values(summaries(df, columns, most), most)
    # Estimates are not below counts, so none with the share is cut off.
    hot = (F.col("estimate") >= share * F.col("rows")) & F.col("value").isNotNull()
    return named.where(hot).select("position", "value", "estimate")
