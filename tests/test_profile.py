import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickmill.operators import profile

# Known result: range of every integer column of a training log, 10 bins each.
RANGES = [
    (0, 2344), (-3, 257675), (0, 65535), (0, 700), (0, 2557264), (0, 263348), (0, 26297),
    (0, 4897), (0, 29019), (0, 9), (0, 155), (0, 1807), (0, 4634),
]


def column(spark, values, kind="bigint", name="x"):
    return spark.createDataFrame([(value,) for value in values], f"{name} {kind}")


def counts_of(frame):
    return [row["count"] for row in frame.orderBy("bin").collect()]


def test_edges_are_bit_exact():
    assert profile.histogram_edges(0, 700) == list(range(0, 701, 70))
    assert profile.histogram_edges(0, 26297) == [
        0.0, 2629.7, 5259.4, 7889.099999999999, 10518.8, 13148.5, 15778.199999999999,
        18407.899999999998, 21037.6, 23667.3, 26297,
    ]
    assert profile.histogram_edges(-3, 257675)[-2:] == [231907.19999999998, 257675]
    for lo, hi in RANGES:
        edges = profile.histogram_edges(lo, hi)
        assert len(edges) == 11 and edges[0] == lo and edges[-1] == hi
    assert profile.histogram_edges(5, 5) == [5, 5]


def reference_histogram(values, bins):
    values = [v for v in values if v is not None]
    lo, hi = min(values), max(values)
    if lo == hi:
        return [len(values)]
    found = Counter(min(math.floor((v - lo) / ((hi - lo) / bins)), bins - 1) for v in values)
    return [found[index] for index in range(bins)]


@pytest.mark.parametrize("bins", [1, 3, 10])
def test_histogram_equals_brute_force(spark, bins):
    rng = random.Random(bins)
    values = [rng.choice([None, 0, 29019, rng.randrange(29020)]) for _ in range(2000)]
    result = profile.histograms(column(spark, values), ["x"], bins, labels="grouped")
    assert counts_of(result) == reference_histogram(values, bins)
    totals = {row["total"] for row in result.collect()}
    assert totals == {sum(v is not None for v in values)}


def test_every_edge_of_a_wide_range_falls_in_its_bin(spark):
    values = list(range(29020))
    assert counts_of(profile.histograms(column(spark, values), ["x"])) == reference_histogram(
        values, 10
    )


def test_histogram_special_columns(spark):
    assert counts_of(profile.histograms(column(spark, [1, None, 2, 3, 11]), ["x"])) == [
        1, 1, 1, 0, 0, 0, 0, 0, 0, 1,
    ]
    constant = profile.histograms(column(spark, [5, 5, 5]), ["x"]).collect()
    assert [(r["lower"], r["upper"], r["count"]) for r in constant] == [(5.0, 5.0, 3)]
    assert profile.histograms(column(spark, [None, None]), ["x"]).count() == 0
    doubles = column(spark, [0.0, 1.0, float("nan"), None], "double")
    assert counts_of(profile.histograms(doubles, ["x"], 2)) == [1, 1]
    with pytest.raises(ValueError):
        profile.histograms(column(spark, [0.0, float("inf")], "double"), ["x"])


def test_histogram_of_a_range_beyond_64_bits(spark):
    ends = [-(2**63), -(2**62), 0, 2**63 - 1]
    assert counts_of(profile.histograms(column(spark, ends), ["x"], 2)) == [2, 2]
    wide = column(spark, [-1e300, 0.0, 1e300], "double")
    assert counts_of(profile.histograms(wide, ["x"], 2)) == [1, 2]


def test_histogram_labels(spark):
    def labels(values, form):
        bins = profile.histograms(column(spark, values), ["x"], labels=form)
        return [row["bin_label"] for row in bins.orderBy("bin").collect()]

    assert labels([0, 2344], "scientific")[:2] == ["0.0E+00---2.34E+02", "2.3E+02---4.69E+02"]
    # Halves go to the even digit: 1250 is 1.2E+03.
    assert labels([0, 12500], "scientific")[1] == "1.2E+03---2.50E+03"
    assert labels([0, 12345], "grouped")[1] == "1,234.500 - 2,469"
    with pytest.raises(KeyError):
        labels([0, 1], "other")


def test_histograms_of_many_columns(spark):
    names = [f"x{n}" for n in range(50)]
    frame = spark.range(100).select(*[(F.col("id") * n).alias(x) for n, x in enumerate(names)])
    result = profile.histograms(frame, names)
    assert result.count() == 1 + 49 * 10
    assert result.agg(F.sum("count")).first()[0] == 5000


def test_fixed_histogram(spark):
    labels = column(spark, [0, 1, 1, 2, 3, -1, None])
    assert counts_of(profile.fixed_histogram(labels, "x")) == [1, 3]
    assert counts_of(profile.fixed_histogram(labels, "x", [0, 1, 2, 3, 4])) == [1, 2, 1, 1]
    with pytest.raises(ValueError):
        profile.fixed_histogram(labels, "x", [1, 1])


def stats(spark, values, kind="bigint"):
    return profile.numeric_stats(column(spark, values, kind), ["x"]).first()


def test_moments(spark):
    rng = random.Random(1)
    values = [rng.expovariate(1.0) for _ in range(500)]
    n, mean = len(values), sum(values) / len(values)
    m2, m3, m4 = (sum((v - mean) ** k for v in values) / n for k in (2, 3, 4))
    row = stats(spark, [*values, None], "double")
    assert row["mean"] == pytest.approx(mean)
    assert row["stddev"] == pytest.approx(math.sqrt(m2 * n / (n - 1)))
    assert row["skewness"] == pytest.approx(m3 / m2**1.5)
    assert row["kurtosis"] == pytest.approx(m4 / m2**2 - 3)


def test_moments_of_special_columns(spark):
    assert tuple(stats(spark, [5, 5, 5])) == ("x", 5.0, 0.0, None, None)
    assert stats(spark, [5])["stddev"] is None
    assert tuple(stats(spark, [None, None])) == ("x", None, None, None, None)


def test_moments_of_many_columns_in_small_groups(spark):
    names = [f"x{n}" for n in range(20)]
    frame = spark.range(10).select(*[(F.col("id") + n).alias(x) for n, x in enumerate(names)])
    means = {row["column"]: row["mean"] for row in profile.numeric_stats(frame, names).collect()}
    assert means == {x: 4.5 + n for n, x in enumerate(names)}


def test_distinct_counts_take_null_as_a_value(spark):
    frame = spark.createDataFrame(
        [(1, "a", 0.0), (1, None, -0.0), (2, "a", None), (2, None, 1.5)], "i int, s string, d double"
    )
    found = {row["column"]: row["n_distinct"] for row in profile.distinct_counts(frame).collect()}
    assert found == {"i": 2, "s": 2, "d": 3}


def test_category_counts_and_rates(spark):
    frame = column(spark, ["a", "a", None, "b", ""], "string", "C1")
    ordered = profile.category_counts(frame, ["C1"], ordered=True).collect()
    assert [(r["value"], r["count"]) for r in ordered] == [("a", 2), ("", 1), ("b", 1), (None, 1)]
    rates = {r["value"]: r["rate"] for r in profile.value_rates(frame, ["C1"]).collect()}
    assert rates == {"a": 0.4, None: 0.2, "b": 0.2, "": 0.2}


def test_top_categories_equal_brute_force(spark):
    rng = random.Random(3)
    # A third of all rows share one value, another part has none.
    values = [rng.choice(["hot", rng.choice([None, "Other"]), f"v{rng.randrange(60)}"]) for _ in range(3000)]
    counts = profile.category_counts(column(spark, values, "string", "C1"), ["C1"])
    top = profile.top_categories(counts, 10).orderBy("rank").collect()
    ranked = sorted(Counter(values).items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))
    assert [(r["value"], r["count"]) for r in top[:10]] == ranked[:10]
    assert not any(r["is_other"] for r in top[:10])
    assert top[10]["is_other"] and top[10]["count"] == sum(c for _, c in ranked[10:])


def test_top_categories_with_few_values(spark):
    counts = profile.category_counts(column(spark, ["a", None], "string", "C1"), ["C1"])
    top = profile.top_categories(counts, 10).orderBy("rank").collect()
    assert [(r["value"], r["count"], r["is_other"]) for r in top] == [
        ("a", 1, False), (None, 1, False), (None, 0, True),
    ]


def test_top_categories_are_cut_before_the_shuffle(spark):
    counts = profile.category_counts(column(spark, ["a"], "string", "C1"), ["C1"])
    plan = profile.top_categories(counts, 10)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_few_values_are_ranked(spark):
    """Rows that cannot be among the first are out before the sort, ties are not."""
    rng = random.Random(8)
    rows = [("C1", f"v{i}", rng.randrange(1, 10_000)) for i in range(20_000)]
    rows += [("C2", f"v{i}", 1) for i in range(3000)] + [("C3", None, 4), ("C3", "x", 2)]
    counts = spark.createDataFrame(rows, "column string, value string, count bigint")
    found = {r["column"]: r for r in profile._bounds(counts, 10).collect()}
    ranked = sorted((count for name, _, count in rows if name == "C1"), reverse=True)
    assert found["C1"]["least"] <= ranked[9] and found["C1"]["least"] >= ranked[30]
    assert [found[c]["least"] for c in ("C2", "C3")] == [1, 0]
    assert found["C1"]["total"] == sum(ranked) and found["C3"]["total"] == 6
    top = profile.top_categories(counts, 10).collect()
    of = {c: sorted((r for r in top if r["column"] == c), key=lambda r: r["rank"]) for c in found}
    assert [r["count"] for r in of["C1"][:10]] == ranked[:10]
    assert [r["value"] for r in of["C2"][:10]] == sorted(f"v{i}" for i in range(3000))[:10]
    assert [r["value"] for r in of["C3"]] == [None, "x", None]


def test_counts_tell_texts_apart_by_their_bytes(spark):
    frame = spark.createDataFrame([("a", 1), ("A", 1), ("", 2), (None, None)], "C1 string, C2 int")
    counts = profile.category_counts(frame, ["C1", "C2"])
    assert dict(counts.dtypes)["value"] == "string"
    assert {tuple(row) for row in counts.collect()} == {
        ("C1", "a", 1), ("C1", "A", 1), ("C1", "", 1), ("C1", None, 1),
        ("C2", "1", 2), ("C2", "2", 1), ("C2", None, 1),
    }


def test_projections(spark):
    frame = spark.createDataFrame([(1, 2, "a"), (0, None, None)], "label int, I1 bigint, C1 string")
    assert profile.column_at(frame, 2).columns == ["C1"]
    assert profile.integer_columns(frame).columns == ["I1"]
    assert profile.categorical_columns(frame).columns == ["C1"]
    assert profile.non_null(frame, "C1").collect() == [("a",)]
    assert profile.row_count(frame).first()[0] == 2


def test_rounded_means(spark):
    frame = spark.createDataFrame([(1, -1), (2, -2)], "a int, b int")
    means = {r["column"]: r["mean"] for r in profile.numeric_means(frame, ["a", "b"], True).collect()}
    assert means == {"a": 2.0, "b": -2.0}


def test_rows_are_numbered_without_a_task_for_each_column(spark):
    rng = random.Random(5)
    rows = [(c, f"v{n}", rng.randrange(9)) for c in ("C1", "C2", "C3") for n in range(200)]
    frame = spark.createDataFrame(rows, "column string, value string, count bigint")
    ordered = frame.repartitionByRange(7, "column", F.desc("count"), "value")
    ordered = ordered.sortWithinPartitions("column", F.desc("count"), "value")
    numbered = profile.number_in_order(ordered)
    found = {(r["column"], r["value"]): r["rank"] for r in numbered.collect()}
    for column_name in ("C1", "C2", "C3"):
        own = sorted((-n, v) for c, v, n in rows if c == column_name)
        assert [found[column_name, v] for _, v in own] == list(range(1, 201))
    windows = [
        line
        for line in numbered._jdf.queryExecution().optimizedPlan().toString().splitlines()
        if "Window" in line
    ]
    assert not any("value" in line for line in windows)
