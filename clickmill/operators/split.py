"""Random and reproducible splits of a click log."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.functions import md5_uniform
from clickmill.session import materialize
from clickmill.sources.catalog import SPLIT_COLUMN
from clickmill.sources.clicks import write_lines

# Shares of the source log for training and for the final test, and
# shares of the training part for its own train, validation and test sets.
TRAIN_TEST_WEIGHTS = {"train": 0.2083333, "test": 0.7916667}
TRAIN_PART_WEIGHTS = {"train_5m": 0.5, "validation_2m": 0.2, "test_3m": 0.3}

# Rows of the three parts that the training log is cut into.
NOMINAL_SIZES = {"train_5m": 5_000_000, "validation_2m": 2_000_000, "test_3m": 3_000_000}

# Bits of the hash that orders rows, and of one refinement of its histogram.
ORDER_BITS = 60
STEP_BITS = 12

# Both levels at once, as shares of the source log.
ALL_WEIGHTS = {
    **{name: TRAIN_TEST_WEIGHTS["train"] * w for name, w in TRAIN_PART_WEIGHTS.items()},
    "test": TRAIN_TEST_WEIGHTS["test"],
}


def mark_random(
    df: DataFrame,
    weights: Mapping[str, float] = TRAIN_TEST_WEIGHTS,
    seed: int = 0,
    column: str = "split",
) -> DataFrame:
    """Add the name of a random part to each row: one number drawn per row, no sort.

    Which rows a part gets depends on the partitioning of ``df``.
    """
    # As a column first: every mention of rand in an expression draws numbers of its own.
    drawn = df.withColumn("_drawn", F.rand(seed))
    return drawn.withColumn(column, pick_by_weight(F.col("_drawn"), weights)).drop("_drawn")


def random_split(
    df: DataFrame, weights: Mapping[str, float] = TRAIN_TEST_WEIGHTS, seed: int = 0
) -> dict[str, DataFrame]:
    """Named random parts. Rows are marked in one pass, and every part reads its own."""
    column = "_part"
    marked = materialize(mark_random(df, weights, seed, column), "random-parts")
    return {name: marked.where(F.col(column) == name).drop(column) for name in weights}


def split_all(df: DataFrame, seed: int = 0) -> dict[str, DataFrame]:
    """Both levels: final test, and train / validation / test of the training part."""
    return random_split(df, ALL_WEIGHTS, seed)


def pick_by_weight(uniform: Column, weights: Mapping[str, float]) -> Column:
    """Name of the part that a number in [0, 1) falls in; parts follow in given order."""
    names = list(weights)
    total = float(sum(weights.values()))
    picked, reached = None, 0.0
    for name in names[:-1]:
        reached += weights[name]
        below = uniform < F.lit(reached / total)
        picked = F.when(below, name) if picked is None else picked.when(below, name)
    return F.lit(names[-1]) if picked is None else picked.otherwise(names[-1])


def row_key(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Text that identifies a row by the given columns; null differs from empty."""
    texts = [
        F.coalesce(F.col(name).cast("string"), F.lit("\x00")) for name in columns or df.columns
    ]
    return texts[0] if len(texts) == 1 else F.concat_ws("\t", *texts)


def hash_split(
    df: DataFrame,
    weights: Mapping[str, float] = ALL_WEIGHTS,
    key: Column | None = None,
    salt: str = "",
    column: str = "split",
) -> DataFrame:
    """Add the name of each row's part, derived from its key alone: no shuffle, no sort.

    The same rows land in the same part on any cluster. ``key`` defaults to the whole
    row. Equal keys stay together, which keeps copies of a record out of the other parts;
    use ``random_split`` or ``write_splits(assign="random")`` where copies shall spread.
    """
    text = key if key is not None else row_key(df)
    if salt:
        text = F.concat(text, F.lit(salt))
    return df.withColumn(column, pick_by_weight(md5_uniform(text), weights))


def order_hash(key: Column) -> Column:
    """Number of 60 bits that depends on the text of ``key`` alone."""
    return F.conv(F.substring(F.md5(key), 1, ORDER_BITS // 4), 16, 10).cast("bigint")


def rank_thresholds(
    numbers: DataFrame, column: str, ranks: Iterable[int], bits: int = ORDER_BITS
) -> dict[int, tuple[int, int]]:
    """Per rank r a pair (t, e): r - e rows have a number below t, and e of those equal to t
    make up the rest.

    Order statistics without sorting: rows are counted by the highest bits of their number,
    and only the buckets in which ranks end are counted again by the next bits, until a rank
    ends between buckets or no bits are left. A round reads one column, reduces it within
    every task and sends at most 4096 counts a rank to the driver.
    """
    open_ranks = {rank: (0, rank) for rank in ranks}
    found: dict[int, tuple[int, int]] = {}
    shift = bits
    while open_ranks and shift > 0:
        # Ranks of one bucket share its counts.
        inside = F.shiftright(F.col(column), shift).isin(
            *{prefix for prefix, _ in open_ranks.values()}
        )
        before, shift = shift, max(shift - STEP_BITS, 0)
        counts = dict(
            numbers.where(inside)
            .groupBy(F.shiftright(F.col(column), shift).alias("bucket"))
            .agg(F.count(F.lit(1)))
            .collect()
        )
        for rank, (prefix, left) in list(open_ranks.items()):
            own = sorted(b for b in counts if b >> (before - shift) == prefix)
            for bucket in own:
                if left < counts[bucket]:
                    break
                left -= counts[bucket]
            else:
                # All rows of the bucket lie below the rank.
                found[rank] = ((prefix + 1) << before, left)
                del open_ranks[rank]
                continue
            if left == 0 or shift == 0:
                found[rank] = (bucket << shift, left)
                del open_ranks[rank]
            else:
                open_ranks[rank] = (bucket, left)
    return found


def exact_split(
    df: DataFrame,
    sizes: Mapping[str, int] = NOMINAL_SIZES,
    key: Column | None = None,
    salt: str = "",
    column: str = "split",
    rest: str | None = "test",
) -> DataFrame:
    """Add the name of each row's part, with exactly the asked number of rows in each.

    Rows are taken in the order of a 60-bit hash of their key: the first ``sizes`` rows for
    the first part and so on, all others for ``rest``. Nothing is sorted: the hashes at which
    parts end are found by refined histograms, then each row compares its own. The same rows
    get the same part on any cluster. Rows of equal key, copies if the key is the whole row,
    are cut by their number in a written table where a part ends among them. More rows asked
    for than there are fail.
    """
    if any(size < 0 for size in sizes.values()):
        raise ValueError("sizes must not be negative")
    text = key if key is not None else row_key(df)
    if salt:
        text = F.concat(text, F.lit(salt))
    order, number = "_order", "_number"
    marked = df.withColumn(order, order_hash(text))
    hashes = materialize(marked.select(order), "row-order")
    ends, total = [], 0
    for size in sizes.values():
        total += size
        ends.append(total)
    rows = hashes.count()
    if total > rows:
        raise ValueError(f"{total} rows asked for, {rows} there are")
    thresholds = rank_thresholds(hashes, order, set(ends))
    below = {end: F.col(order) < F.lit(at) for end, (at, _) in thresholds.items()}
    cut = {end: (at, left) for end, (at, left) in thresholds.items() if left}
    if cut:
        # Only where a part ends among rows of one hash, rows need numbers that stay.
        marked = materialize(
            marked.withColumn(number, F.monotonically_increasing_id()), "numbered-rows"
        )
        for at in {at for at, _ in cut.values()}:
            same = marked.where(F.col(order) == F.lit(at)).select(number)
            own = {end: left for end, (t, left) in cut.items() if t == at}
            numbers = rank_thresholds(same, number, set(own.values()), 63)
            for end, left in own.items():
                among = (F.col(order) == F.lit(at)) & (F.col(number) < F.lit(numbers[left][0]))
                below[end] = below[end] | among
    picked = F.lit(rest)
    for name, end in reversed(list(zip(sizes, ends, strict=True))):
        picked = F.when(below[end], name).otherwise(picked)
    return marked.withColumn(column, picked).drop(order, number)


def write_splits(
    lines: DataFrame,
    path: str,
    weights: Mapping[str, float] = ALL_WEIGHTS,
    assign: str = "hash",
    seed: int = 0,
    mode: str = "errorifexists",
) -> None:
    """Write every part of a log in one pass: ``path/part=<name>/*.txt.gz``.

    ``assign="hash"`` is reproducible, ``assign="random"`` spreads equal lines. Each task
    writes its rows of all parts itself, so no part is shuffled to a few tasks.
    """
    if assign == "hash":
        marked = hash_split(lines, weights, salt=str(seed) if seed else "", column=SPLIT_COLUMN)
    elif assign == "random":
        marked = mark_random(lines, weights, seed, SPLIT_COLUMN)
    else:
        raise ValueError(f"assign must be 'hash' or 'random', not {assign!r}")
    write_lines(marked, path, partition_by=SPLIT_COLUMN, mode=mode)
