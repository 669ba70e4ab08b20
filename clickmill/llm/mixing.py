"""Mixing sources to target weights by hash-threshold histograms.

Sources share a budget by weight, none above a fixed number of times its own size; the excess
goes to the others. A source takes all its documents as often as its target allows whole
rounds, and once more those whose hash lies below a threshold. The threshold is found without
sorting documents: sizes are summed by source and hash bucket, the bucket in which the rest
of the budget ends is split into finer buckets, and so on until it holds one document. Each
round reads the boundary buckets only, and sums within tasks before it shuffles.

The hash depends on the document id alone, so a smaller budget takes a subset, and reruns
agree. The boundary document is taken if that comes nearer to the target.

Defined results: null and empty texts have size 0 and take nothing; the null source is a
source like any other, last in order; documents with equal ids share a hash and are taken
together; sources without words have target 0; a source of which one very long document holds
most can miss its target by up to half that document; an empty table gives no rows; other
columns are passed over or kept whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import WORD, bounded_broadcast, store

HASH_BITS = 60
LEVEL_BITS = 12
MAX_ROUNDS = 3
WEIGHTS = (1, 2, 3)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _hash(column: str) -> Column:
    digits = F.substring(F.md5(F.coalesce(F.col(column).cast("string"), F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size``, ``target``, whole ``rounds`` and the ``rest`` of the budget.

    A source with the i-th smallest ratio of limit to weight is at its limit exactly if the
    level that all sources from it on could have is not below that ratio.
    """
    everything = Window.partitionBy()
    limit = F.lit(MAX_ROUNDS) * F.col("source_size")
    weighed = sizes.withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("place") % 3 + 1))
    by_ratio = Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum(limit).over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    leveled = (
        weighed.withColumn("ratio", limit.cast("double") / F.col("weight"))
        .withColumn("level", left.cast("double") / weights)
        .withColumn("limited", F.col("ratio") <= F.col("level"))
    )
    common = F.min(
        F.when(~F.col("limited"), F.struct("ratio", "place", "level"))
    ).over(everything)["level"]
    target = F.when(F.col("limited"), limit.cast("double")).otherwise(common * F.col("weight"))
    sized = leveled.withColumn("target", target)
    rounds = F.floor(F.col("target") / F.col("source_size")).cast("long")
    rounds = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(rounds)
    return sized.withColumn("rounds", rounds).select(
        "source",
        "source_size",
        "target",
        "rounds",
        (F.col("target") - F.col("rounds") * F.col("source_size")).alias("rest"),
    )


def _thresholds(rows: DataFrame, budgets: DataFrame) -> tuple[DataFrame, int]:
    """Boundary bucket of each source, whether it is taken, and the bits that number it."""
    state = budgets.select(F.col("source").alias("of"), F.lit(0).cast("long").alias("cut"), "rest")
    for bits in range(0, HASH_BITS, LEVEL_BITS):
        shift = HASH_BITS - bits - LEVEL_BITS
        open_ = bounded_broadcast(state.select("of", "cut", "rest"), 64)
        inside = rows.join(
            open_,
            rows["source"].eqNullSafe(open_["of"])
            & (F.shiftright(rows["hash"], HASH_BITS - bits) == open_["cut"]),
        )
        buckets = inside.groupBy("of", "rest", F.shiftright("hash", shift).alias("cut")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("documents")
        )
        upto = Window.partitionBy("of").orderBy("cut").rowsBetween(Window.unboundedPreceding, 0)
        filled = buckets.withColumn("filled", F.sum("size").over(upto))
        over = filled.filter(F.col("filled") > F.col("rest"))
        first = over.groupBy("of").agg(
            F.min_by(F.struct("cut", "rest", "filled", "size", "documents"), "cut").alias("at")
        )
        state = store(
            first.select(
                "of",
                "at.cut",
                (F.col("at.rest") - (F.col("at.filled") - F.col("at.size"))).alias("rest"),
                "at.size",
                "at.documents",
            ),
            "mix-thresholds",
        )
        if not state.filter("documents > 1").limit(1).collect():
            break
    # The boundary goes over the budget by less than it would be missed without it.
    return state.select("of", "cut", (F.col("size") < 2 * F.col("rest")).alias("edge")), shift


def _sized(docs: DataFrame, *columns: str | Column) -> DataFrame:
    return docs.select(
        *columns, word_count("text").alias("_size"), _hash("doc_id").alias("_hash")
    )


def _mixed(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``rows`` with source size, target and number of copies; ``stored`` has all sizes."""
    parts = stored.select("source", F.col("_size").alias("size"), F.col("_hash").alias("hash"))
    sizes = parts.groupBy("source").agg(F.sum("size").alias("source_size"))
    budgets = store(targets(sizes), "mix-targets")
    cuts, shift = _thresholds(parts, budgets)
    plan = budgets.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(
        F.col("source").alias("_source"),
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
        F.col("rounds").alias("_rounds"),
        F.col("cut").alias("_cut"),
        F.col("edge").alias("_edge"),
    )
    plan = bounded_broadcast(store(plan, "mix-plan"), 128)
    bucket = F.shiftright("_hash", shift)
    extra = (bucket < F.col("_cut")) | ((bucket == F.col("_cut")) & F.col("_edge"))
    copies = F.col("_rounds") + F.coalesce(extra.cast("long"), F.lit(0))
    return rows.join(plan, rows["source"].eqNullSafe(plan["_source"])).withColumn("_copies", copies)


def mix_sources(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` and ``copies`` of every row."""
    stored = store(_sized(docs, "doc_id", "source"), "mix-sizes")
    return _mixed(stored, stored).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
        F.col("_copies").alias("copies"),
    )


def repeat_mixed(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, all columns kept, whatever their names.

    Documents without words add nothing to a mix and go.
    """
    stored = store(_sized(docs, "source"), "mix-sizes")
    rows = _sized(docs, F.struct("*").alias("_row"), "source")
    mixed = _mixed(rows, stored).filter("_size > 0 and _copies > 0")
    again = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return mixed.select("_row", again.alias("_copy")).select("_row.*")


SQL = r"""
with d as (
  select doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as hash
  from documents),
s as (
  select source, sum(size)::bigint as source_size,
    row_number() over (order by source nulls last) - 1 as place
  from d group by source),
w as (
  select *, place % 3 + 1 as weight, (3 * source_size)::double / (place % 3 + 1) as ratio from s),
l as (
  select *, (sum(source_size) over () - coalesce(sum(3 * source_size) over o, 0))::double
    / (sum(weight) over () - coalesce(sum(weight) over o, 0)) as level
  from w window o as (order by ratio, place rows between unbounded preceding and 1 preceding)),
t as (
  select source, source_size, case when ratio <= level then (3 * source_size)::double
    else (arg_min(level, (ratio, place)) filter (ratio > level) over ()) * weight end as target
  from l),
r as (
  select *, case when source_size = 0 then 0 else floor(target / source_size)::bigint end as rounds
  from t),
c as (
  select d.*, r.source_size, r.target, r.rounds,
    r.target - r.rounds * r.source_size as rest,
    sum(d.size) over (partition by d.source order by d.hash) as upto,
    sum(d.size) over (partition by d.source, d.hash) as tied
  from d join r on d.source is not distinct from r.source)
select doc_id, size, source_size, target,
  (size * (rounds + case when upto <= rest or (upto - tied < rest and upto - rest < rest - (upto - tied))
    then 1 else 0 end))::bigint as taken
from c
"""
