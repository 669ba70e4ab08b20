"""Lookups of several columns' values in tables of what was learned about them.

A table has one row per column and value. Small ones are sent to every executor, the smallest
first, as long as all of them together stay below a limit. The columns of the others are
looked up together: of each row, one narrow row ``(row, column, value)`` per column looks for
its entry, and the entries come back to their rows by one aggregate, so the wide rows are
shuffled once, however many columns there are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.functions import text_value
from clickmill.operators.frequent import frequent_share
from clickmill.session import materialize

# Hash-table entry of a broadcast row beside its text.
ENTRY_BYTES = 96
BROADCAST_BYTES = 64 * 1024 * 1024
# Values with at least this share of the rows are looked up without a shuffle, as far as
# their text fits into so many bytes.
HOT_SHARE = 0.001
HOT_BYTES = 64 * 1024 * 1024


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column begins with it."""
    while any(column.lower().startswith(name) for column in df.columns):
        name = f"_{name}"
    return name


def fitting(sizes: Mapping[str, int], limit: int) -> list[str]:
    """Names whose bytes together stay below the limit, the smallest first."""
    sent, chosen = 0, []
    for name in sorted(sizes, key=sizes.__getitem__):
        sent += sizes[name]
        if sent <= limit:
            chosen.append(name)
    return chosen


def hot_values(
    dataset: DataFrame,
    names: Sequence[str],
    share: float = HOT_SHARE,
    most_bytes: int = HOT_BYTES,
    entry_bytes: int = ENTRY_BYTES,
) -> DataFrame:
    """``(position, value)`` of all columns that hold the share of ``dataset`` each.

    They are found in the rows to be looked up, so that a value that was rare or unseen
    before is found too, by one summary per column of bounded size. The most frequent are
    taken while their text fits.
    """
    size = F.octet_length("value") + entry_bytes
    # A few hundred to a few thousand rows a column.
    most_first = Window.orderBy(F.desc("estimate"), "position", "value")
    found = frequent_share(dataset, names, share)
    return (
        found.withColumn("upto", F.sum(size).over(most_first))
        .where(F.col("upto") <= most_bytes)
        .select("position", "value")
    )


def broadcast_lookup(
    dataset: DataFrame,
    name: str,
    entries: DataFrame,
    entry: str,
    target: str,
    missing: Column,
) -> DataFrame:
    """``dataset`` with ``target``, from entries that are sent to every executor."""
    table = F.broadcast(entries.select(F.col("value").alias("_value"), F.col(entry).alias("_entry")))
    columns = [column for column in dataset.columns if column != target]
    matches = text_value(dataset, name).eqNullSafe(table["_value"])
    return dataset.join(table, matches, "left").select(
        *[dataset[column] for column in columns], F.coalesce("_entry", missing).alias(target)
    )


def shuffled_lookup(
    dataset: DataFrame,
    name: str,
    table: DataFrame,
    entry: str,
    target: str,
    missing: Column,
    of_null: Column,
    hot: DataFrame,
) -> DataFrame:
    """``dataset`` with ``target``, from a table of one column too large to broadcast.

    Rows meet their entry in one shuffle, and nothing else is shuffled or written: null has
    a constant, hot values find theirs in a broadcast table, and neither is a key of it.
    """
    value, found = free_name(dataset, "_value"), free_name(dataset, "_found")
    columns = [column for column in dataset.columns if column != target]
    entries = table.where((F.col("column") == name) & F.col("value").isNotNull()).select(
        F.col("value").alias(value), F.col(entry).alias(found)
    )
    known = materialize(
        hot.select(F.col("value").alias(value))
        .where(F.col(value).isNotNull())
        .join(entries, value, "left")
        .withColumn(found, F.coalesce(found, missing)),
        "hot-entries",
    )
    rows = dataset.select(*columns, text_value(dataset, name).alias(value))
    marked = rows.join(F.broadcast(known), value, "left")
    warm = marked.where(F.col(value).isNull() | F.col(found).isNotNull())
    cold = marked.where(F.col(value).isNotNull() & F.col(found).isNull()).drop(found)
    entry_of = F.when(F.col(value).isNull(), of_null).otherwise(F.coalesce(found, missing))
    answers = [*columns, entry_of.alias(target)]
    return warm.select(*answers).unionAll(cold.join(entries, value, "left").select(*answers))


def split_lookup(
    dataset: DataFrame,
    names: Sequence[str],
    table: DataFrame,
    entry: str,
    target: Callable[[str], str],
    missing: Column,
    of_null: Mapping[str, Column],
    hot: DataFrame,
) -> DataFrame:
    """``dataset`` with the targets of ``names``, from a table too large to broadcast.

    Rows are numbered and written. Hot values find their entry in a broadcast table, null
    has a constant, all others of all columns are joined by one shuffle in which no key is
    hot. Values that the table does not have come back with no entry.
    """
    row, found_entry = free_name(dataset, "_row"), free_name(dataset, "_entry")
    numbered = materialize(
        dataset.withColumn(row, F.monotonically_increasing_id()), "numbered-rows"
    )
    places = F.create_map(*[F.lit(x) for at, name in enumerate(names) for x in (name, at)])
    entries = table.where(F.col("column").isin(*names) & F.col("value").isNotNull()).select(
        places[F.col("column")].alias("position"), "value", F.col(entry).alias("entry")
    )
    texts = F.array(*[text_value(numbered, name) for name in names])
    asked = numbered.select(
        F.col(row).alias("row"), F.posexplode(texts).alias("position", "value")
    ).where(F.col("value").isNotNull())
    known = materialize(
        hot.join(entries, ["position", "value"], "left").select(
            "position", "value", F.coalesce("entry", missing).alias("hot_entry")
        ),
        "hot-entries",
    )
    marked = asked.join(F.broadcast(known), ["position", "value"], "left")
    warm = marked.where("hot_entry is not null").select(
        "row", "position", F.col("hot_entry").alias("entry")
    )
    cold = marked.where("hot_entry is null").join(entries, ["position", "value"])
    found = (
        warm.unionAll(cold.select("row", "position", "entry"))
        .groupBy(F.col("row").alias(row))
        .agg(
            *[
                F.max(F.when(F.col("position") == at, F.col("entry"))).alias(f"{found_entry}{at}")
                for at in range(len(names))
            ]
        )
    )
    targets = {target(name) for name in names}
    kept = [name for name in dataset.columns if name not in targets]
    return numbered.join(found, row, "left").select(
        *[numbered[name] for name in kept],
        *[
            F.when(numbered[name].isNull(), of_null.get(name, missing))
            .otherwise(F.coalesce(f"{found_entry}{at}", missing))
            .alias(target(name))
            for at, name in enumerate(names)
        ],
    )


def lookup_values(
    dataset: DataFrame,
    names: Sequence[str],
    table: DataFrame,
    entry: str,
    target: Callable[[str], str],
    missing: Column,
    broadcast_bytes: int = BROADCAST_BYTES,
    entry_bytes: int = ENTRY_BYTES,
) -> DataFrame:
    """``dataset`` with ``target(name)`` for every name, from ``table`` by column and value."""
    # One row per column.
    sizes = table.groupBy("column").agg(
        (F.count(F.lit(1)) * entry_bytes).alias("entries"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"),
        F.max(F.when(F.col("value").isNull(), F.col(entry))).alias("of_null"),
    )
    found = {row["column"]: row for row in sizes.collect()}
    total = {n: found[n]["entries"] + found[n]["bytes"] if n in found else 0 for n in names}
    whole = fitting(total, broadcast_bytes)
    for name in whole:
        entries = table.where(F.col("column") == name)
        dataset = broadcast_lookup(dataset, name, entries, entry, target(name), missing)
    split = [name for name in names if name not in whole]
    if split:
        of_null = {
            name: F.lit(found[name]["of_null"])
            for name in split
            if name in found and found[name]["of_null"] is not None
        }
        hot = hot_values(dataset, split, entry_bytes=entry_bytes)
        if len(split) == 1:
            (name,) = split
            null_entry = of_null.get(name, missing)
            dataset = shuffled_lookup(
                dataset, name, table, entry, target(name), missing, null_entry, hot
            )
        else:
            dataset = split_lookup(dataset, split, table, entry, target, missing, of_null, hot)
    targets = [target(name) for name in names]
    kept = [name for name in dataset.columns if name not in targets]
    return dataset.select(*[dataset[name] for name in kept], *targets)
