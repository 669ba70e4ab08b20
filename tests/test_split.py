import hashlib

import pytest
from pyspark.sql import functions as F

from clickmill.operators import split
from clickmill.sources import read_lines


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(20000).select(F.col("id").cast("string").alias("value"))


def test_hash_split_equals_brute_force(rows):
    weights = {"a": 0.5, "b": 0.2, "c": 0.3}
    found = {r["value"]: r["split"] for r in split.hash_split(rows, weights).collect()}
    for value in map(str, range(0, 20000, 97)):
        u = int(hashlib.md5(value.encode()).hexdigest()[:8], 16) / 2**32
        assert found[value] == ("a" if u < 0.5 else "b" if u < 0.7 else "c")


def test_hash_split_ignores_partitioning_and_follows_the_salt(rows):
    one = split.hash_split(rows).collect()
    other = split.hash_split(rows.repartition(7)).collect()
    assert sorted(one) == sorted(other)
    assert sorted(split.hash_split(rows, salt="x").collect()) != sorted(one)


def test_hash_split_sizes(rows):
    sizes = {r["split"]: r["count"] for r in split.hash_split(rows).groupBy("split").count().collect()}
    assert sum(sizes.values()) == 20000
    for name, weight in split.ALL_WEIGHTS.items():
        assert sizes[name] / 20000 == pytest.approx(weight, abs=0.01)


def test_row_key_tells_null_from_empty(spark):
    frame = spark.createDataFrame([(None, "a"), ("", "a")], "x string, y string")
    assert frame.select(split.row_key(frame).alias("k")).distinct().count() == 2


def test_random_splits_are_disjoint_and_complete(rows):
    parts = split.split_all(rows)
    assert list(parts) == ["train_5m", "validation_2m", "test_3m", "test"]
    values = [r["value"] for part in parts.values() for r in part.collect()]
    assert len(values) == 20000 and len(set(values)) == 20000
    assert parts["test"].count() / 20000 == pytest.approx(0.79, abs=0.02)


@pytest.mark.parametrize("assign", ["hash", "random"])
def test_write_splits(spark, rows, tmp_path, assign):
    path = str(tmp_path / "split")
    copies = rows.withColumn("value", F.when(F.col("value") < "3", "copy").otherwise(F.col("value")))
    split.write_splits(copies, path, assign=assign)
    back = read_lines(spark, path)
    assert sorted(r["value"] for r in back.select("value").collect()) == sorted(
        r["value"] for r in copies.collect()
    )
    parts = back.where("value = 'copy'").select("part").distinct().count()
    assert parts == (1 if assign == "hash" else 4)
    with pytest.raises(ValueError):
        split.write_splits(rows, path, assign="other")


def order_of(value):
    return int(hashlib.md5(value.encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize(
    "sizes", [{"a": 1}, {"a": 7000, "b": 1, "c": 4999}, {"a": 0, "b": 20000}, {"a": 19999}, {}]
)
def test_exact_split_takes_the_first_by_hash(rows, sizes):
    found = {r["value"]: r["part"] for r in
             split.exact_split(rows.repartition(5), sizes, column="part").collect()}
    places = sorted(found, key=order_of)
    at = 0
    for name, size in sizes.items():
        assert {found[value] for value in places[at : at + size]} <= {name}
        at += size
    assert {found[value] for value in places[at:]} <= {"test"}


def test_exact_split_cuts_copies_where_a_part_ends(spark):
    """A third of all rows are copies of one row."""
    value = F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string"))
    rows = spark.range(3000).select(value.alias("value")).repartition(6)
    values = sorted((r["value"] for r in rows.collect()), key=order_of)
    first = values.index("same")
    sizes = {"a": first + 300, "b": 200, "c": 700}
    marked = split.exact_split(rows, sizes, rest=None)
    assert marked.columns == ["value", "split"]
    counts = dict(marked.groupBy("split").count().collect())
    assert {k: counts[k] for k in sizes} == sizes and counts[None] == 3000 - sum(sizes.values())
    same = dict(marked.where("value = 'same'").groupBy("split").count().collect())
    assert same["a"] == 300 and same["b"] == 200 and same["c"] >= 500
    for name in sizes:
        got = sorted(r["value"] for r in marked.where(F.col("split") == name).collect())
        at = sum(list(sizes.values())[: list(sizes).index(name)])
        assert got == sorted(values[at : at + sizes[name]])


def test_exact_split_refuses_what_it_cannot_give(spark, rows):
    with pytest.raises(ValueError, match="20001"):
        split.exact_split(rows, {"a": 20000, "b": 1})
    with pytest.raises(ValueError):
        split.exact_split(rows, {"a": -1})
    empty = spark.createDataFrame([], "value string")
    assert split.exact_split(empty, {"a": 0}).collect() == []


def test_rank_thresholds_on_few_bits(spark):
    numbers = [0, 0, 1, 5, 5, 5, 6, 4095, 4096, 4096, 1 << 40, (1 << 60) - 1]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    found = split.rank_thresholds(df, "n", range(len(numbers) + 1))
    for rank, (at, left) in found.items():
        below = sum(n < at for n in numbers)
        assert below + left == rank and (left == 0 or left < numbers.count(at))
