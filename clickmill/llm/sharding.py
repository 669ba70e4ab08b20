"""Shards of near equal bytes by sampled splitters.

Records are ordered by a hash of their text, then by document id. Keys are drawn with a
chance in proportion to their size; quantiles of the draw cut the order into ranges of about
equal bytes. A key that spans a quantile, or has a cell's rows, is heavy and gets a range of its own. Ranges are
then measured, and those overfull in bytes or rows are subdivided: heavy keys by a hash of the document id,
others by another hash of the key. Only within these small cells are records ordered; sums of
whole cells tell where each cell starts, and so every record knows the bytes before it. Shard
k takes the records of the k-th equal part of all bytes.

The law is ``bytes``. Equal texts are neighbours and stay in one shard unless they hold more
than a fiftieth of a fair share; larger groups are cut where the shard is full.

Defined results: null texts have no bytes, so size 16, and the checksum of the empty text;
records with equal ids and texts are told apart by nothing and take consecutive slots; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import bounded_broadcast, store

OVERHEAD = 16
# Records of a cell, about, beyond the least number of cells for each shard.
CELL_ROWS = 200_000
CELLS_PER_SHARD = 12
DRAWS_PER_CELL = 20
# Groups of equal texts up to this part of a fair share are not cut.
WHOLE_GROUP = 50


def _splitters(rows: DataFrame, cells: int, total: int) -> DataFrame:
    """``upper`` key of each range, whether it is ``heavy``, from a size-weighted sample.

    A row counts for at least its part of a cell's rows, so many small rows are heavy too.
    """
    rate = DRAWS_PER_CELL * cells / total
    chance = F.pmod("id_hash", F.lit(1 << 20)) / F.lit(float(1 << 20))
    draws = F.floor(F.greatest(F.col("size") * F.lit(rate), F.lit(DRAWS_PER_CELL / CELL_ROWS)) + chance)
    drawn = rows.select("key", draws.alias("draws")).filter("draws > 0")
    keys = drawn.groupBy("key").agg(F.sum("draws").alias("draws"))
    upto = F.sum("draws").over(Window.orderBy("key"))
    cut = F.floor(F.col("upto") / DRAWS_PER_CELL)
    started = F.floor((F.col("upto") - F.col("draws")) / DRAWS_PER_CELL)
    return keys.withColumn("upto", upto).filter(cut > started).select(
        F.col("key").alias("upper"), (F.col("draws") >= DRAWS_PER_CELL).alias("heavy")
    )


def _range_table(splitters: DataFrame, bits: int) -> DataFrame:
    """Splitters by the first ``bits`` of the key, with the number of all before them."""
    first = F.shiftright("upper", 64 - bits)
    own = splitters.groupBy(first.alias("first")).agg(
        F.sort_array(F.collect_list("upper")).alias("uppers"),
        F.collect_list(F.when(F.col("heavy"), F.col("upper"))).alias("heavies"),
    )
    half = 1 << (bits - 1)
    every = splitters.sparkSession.range(-half, half).withColumnRenamed("id", "bucket")
    none = F.array().cast("array<bigint>")
    table = every.join(own, F.col("bucket") == F.col("first"), "left").select(
        "bucket",
        F.coalesce("uppers", none).alias("uppers"),
        F.coalesce("heavies", none).alias("heavies"),
    )
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum(F.size("uppers")).over(before), F.lit(0))
    return table.withColumn("base", base)


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = store(
        docs.select(
            "doc_id",
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.xxhash64("doc_id").alias("id_hash"),
        ),
        "shard-rows",
    )
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    total = max(total, 1)
    cells = max(CELLS_PER_SHARD * shards, -(-n // CELL_ROWS))
    splitters = store(_splitters(rows, cells, total), "splitters")
    bits = max(8, cells.bit_length())
    table = bounded_broadcast(store(_range_table(splitters, bits), "ranges"), 64)
    found = rows.join(table, F.shiftright("key", 64 - bits) == F.col("bucket"))
    lower = F.size(F.filter("uppers", lambda upper: upper < F.col("key")))
    heavy = F.array_contains("heavies", F.col("key"))
    # A heavy key ends its range, so its own range follows directly.
    numbered = found.select(
        *rows.columns, (2 * (F.col("base") + lower) + heavy.cast("int")).alias("range")
    )
    numbered = store(numbered, "shard-ranges")

    full = F.lit(2 * total // cells + 1)
    parts = numbered.groupBy("range").agg(
        F.greatest(F.ceil(F.sum("size") / full), F.ceil(F.count(F.lit(1)) / CELL_ROWS)).alias("parts")
    )
    parts = bounded_broadcast(store(parts, "range-parts"), 24)
    by_id = F.pmod("id_hash", F.col("parts"))
    by_key = F.pmod(F.xxhash64("key"), F.col("parts"))
    placed = numbered.join(parts, "range").withColumn(
        "part", F.when(F.col("range") % 2 == 1, by_id).otherwise(by_key)
    )
    cell = ["range", "part"]
    placed = placed.drop("parts", "id_hash")
    sums = placed.groupBy(*cell).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *cell,
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("byte_start"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("row_start"),
    )
    ranges = sums.groupBy("range").agg(F.sum("bytes").alias("range_bytes"))
    starts = starts.join(ranges, "range").withColumn(
        "range_start", F.min("byte_start").over(Window.partitionBy("range"))
    )
    starts = bounded_broadcast(store(starts, "cell-starts"), 56)
    in_order = Window.partitionBy(*cell).orderBy("key", "doc_id", "text_crc32")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    same = Window.partitionBy(*cell, "key")
    ended = (
        placed.withColumn("upto", F.sum("size").over(so_far))
        .withColumn("row", F.row_number().over(in_order))
        .withColumn("group_bytes", F.sum("size").over(same))
        .withColumn("group_upto", F.max("upto").over(same))
    )
    whole = (F.col("group_bytes") * (WHOLE_GROUP * shards) <= total) & (F.col("range") % 2 == 0)
    middle = F.when(whole, 2 * F.col("group_upto") - F.col("group_bytes")).otherwise(
        2 * F.col("upto") - F.col("size")
    )
    # A heavy key has its range for itself, so the range's bytes are the group's.
    few = (F.col("range_bytes") * (WHOLE_GROUP * shards) <= total) & (F.col("range") % 2 == 1)
    middle = F.when(few, 2 * F.col("range_start") + F.col("range_bytes")).otherwise(
        2 * F.col("byte_start") + middle
    )
    share = F.floor(middle * shards / (2 * total))
    ended = ended.join(starts, cell).select(
        "doc_id",
        "size",
        "text_crc32",
        F.least(share, F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("row_start") + F.col("row")).alias("at"),
    )
    ended = store(ended, "shard-places")
    firsts = F.broadcast(ended.groupBy("shard").agg(F.min("at").alias("first")))
    return ended.join(firsts, "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("at") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
