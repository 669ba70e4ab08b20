import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickmill.operators import frequent, profile


def table(spark, columns):
    names = [f"C{i + 1}" for i in range(len(columns))]
    schema = ", ".join(f"{name} string" for name in names)
    return spark.createDataFrame(list(zip(*columns)), schema).repartition(5), names


def zipf(rng, rows, values):
    return [f"v{min(int(rng.paretovariate(0.8)), values)}" for _ in range(rows)]


def both(df, names, n, **options):
    full = profile.top_categories(profile.category_counts(df, names), n)
    got = frequent.frequent_categories(df, names, n, **options)
    assert got.columns == full.columns
    return sorted(map(tuple, got.collect()), key=str), sorted(map(tuple, full.collect()), key=str)


@pytest.mark.parametrize("tracked", [64, 384, frequent.TRACKED])
def test_equals_the_full_count(spark, tracked):
    rng = random.Random(tracked)
    rows = 6000
    columns = [
        zipf(rng, rows, 5000),
        [rng.choice(["hot", rng.choice([None, "", "x"]), f"v{rng.randrange(900)}"])
         for _ in range(rows)],
        [f"u{i}" for i in range(rows)],
        [rng.choice("abc") for _ in range(rows)],
        [None] * rows,
        # Ties at the last place that is reported.
        [f"t{i % 40}" for i in range(rows)],
    ]
    df, names = table(spark, columns)
    got, full = both(df, names, 5, tracked=tracked)
    assert got == full


def test_proof_needs_more_than_a_value_left_out_can_have(spark):
    """Forty values of 30 rows each and 3000 of one: the tail outweighs what is named."""
    values = [f"a{i % 40}" for i in range(1200)] + [f"b{i}" for i in range(3000)]
    df, names = table(spark, [values])
    for tracked in (16, 48, 192):
        got, full = both(df, names, 10, tracked=tracked)
        assert got == full


def test_what_is_missed_stays_below_its_bound(spark):
    rng = random.Random(3)
    values = zipf(rng, 20_000, 10_000)
    df, names = table(spark, [values])
    counts = Counter(values)
    for tracked in (96, 768):
        merged = frequent.summaries(df, names, tracked)
        (row,) = merged.collect()
        assert row["rows"] == 20_000
        named = {r["value"]: r["estimate"]
                 for r in frequent.named_values(merged, tracked).collect()}
        most = frequent.most_missed(20_000, tracked)
        assert max([c for v, c in counts.items() if v not in named], default=0) <= most
        assert all(0 <= named[v] - counts[v] <= most / 2 for v in named)


def test_only_candidates_cross_the_network(spark):
    """Rows after the summaries and the recount do not grow with the distinct values."""
    sizes = []
    for distinct in (1000, 20_000):
        value = F.when(F.col("id") % 2 == 0, F.col("id") % 6).otherwise(F.col("id") % distinct + 10)
        df = spark.range(40_000).select(value.cast("string").alias("C1"))
        named = frequent.named_values(frequent.summaries(df, ["C1"], 384), 12)
        counts = frequent._recounted(df, ["C1"], named, [0])
        sizes.append(counts.count())
        got = frequent.frequent_categories(df, ["C1"], 3, tracked=384).collect()
        assert {r["value"] for r in got} == {"0", "2", "4", None}
    assert max(sizes) <= 13


def test_frequent_share_names_every_value_with_the_share(spark):
    rng = random.Random(9)
    values = zipf(rng, 10_000, 3000) + [None] * 5000
    df, names = table(spark, [values])
    counts = Counter(v for v in values if v is not None)
    for share in (0.001, 0.01, 0.2):
        found = {r["value"] for r in frequent.frequent_share(df, names, share, 96).collect()}
        assert {v for v, c in counts.items() if c >= share * 15_000} <= found
        assert None not in found and len(found) <= 2 / share


def test_empty_table(spark):
    df = spark.createDataFrame([], "C1 string")
    assert frequent.frequent_categories(df, ["C1"], 3).collect() == []
    with pytest.raises(ValueError):
        frequent.frequent_categories(df, ["C1"], 0)


def test_summaries_take_a_row_at_a_time(spark):
    """Values of many columns are not stacked below each other before they are reduced."""
    df, names = table(spark, [["a", None, "b"], ["c", "c", None]])
    plan = frequent.summaries(df, names, 16)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("approx_top_k_accumulate", 1)
    assert "Generate" in above and "Generate" not in below


def test_recount_reads_only_its_columns(spark):
    df, names = table(spark, [["a", "a", "b"], ["c", None, "d"], [None, None, "e"]])
    named = spark.createDataFrame(
        [(1, "c"), (2, None), (0, "a")], "position int, value string"
    )
    counts = frequent._recounted(df, names, named, [2, 1])
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(array(C3" in plan and "array(C1" not in plan
    assert {tuple(row) for row in counts.collect()} == {
        (2, None, True, 2), (2, None, False, 1), (1, "c", True, 1), (1, None, False, 2),
    }


def test_values_that_share_a_hash_are_counted_apart(spark, monkeypatch):
    monkeypatch.setattr(frequent, "_hash", lambda value: frequent.F.length(value).cast("bigint"))
    rng = random.Random(11)
    df, names = table(spark, [[rng.choice(["a", "b", "cc", "dd", None]) for _ in range(900)],
                              zipf(rng, 900, 400)])
    for n in (1, 2, 7):
        got, full = both(df, names, n, tracked=64)
        assert got == full
