import math
import random
from collections import Counter

import pytest

from clickmill.operators import profile, states


def near(value, other):
    missing = [x is None or math.isnan(x) for x in (value, other)]
    return missing == [True, True] or value == pytest.approx(other, rel=1e-8, abs=1e-9)


def parts_of(rng, rows):
    parts = [[], [], [], []]
    for row in rows:
        parts[rng.choice([0, 0, 0, 1, 2])].append(row)
    return parts


def test_merged_moments_equal_one_pass(spark):
    rng = random.Random(8)
    rows = [
        (rng.randrange(100), rng.choice([None, int(rng.paretovariate(0.7))]), 7, None,
         10**6 + rng.randrange(5))
        for _ in range(800)
    ]
    schema = "a bigint, b bigint, constant bigint, empty bigint, far bigint"
    names = ["a", "b", "constant", "empty", "far"]
    merged = None
    for part in parts_of(rng, rows):
        found = states.number_states(spark.createDataFrame(part, schema), names)
        merged = found if merged is None else merged.unionAll(found)
    got = {r["column"]: r for r in states.stats_of_states(merged).collect()}
    whole = profile.numeric_stats(spark.createDataFrame(rows, schema), names)
    for want in whole.collect():
        row = got[want["column"]]
        for name in ("mean", "stddev"):
            assert near(row[name], want[name]), (want["column"], name)
        if want["column"] in "ab":
            for name in ("skewness", "kurtosis"):
                assert near(row[name], want[name]), (want["column"], name)
    state = {r["column"]: r for r in states.merge_numbers(merged).collect()}
    assert (state["a"]["n"], state["a"]["lo"], state["a"]["hi"]) == (
        800, min(r[0] for r in rows), max(r[0] for r in rows)
    )
    assert state["empty"]["n"] == 0 and state["empty"]["mean"] is None


def test_store_unites_parts_and_replaces_one_that_comes_again(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.randrange(9), rng.choice([None, "x", f"v{rng.randrange(300)}"]))
            for _ in range(900)]
    schema = "n bigint, c string"
    store = states.ProfileStore(spark, str(tmp_path / "profile"))
    store.add("b", spark.createDataFrame([(99, "wrong")], schema), ["n"], ["c"])
    store.add("a", spark.createDataFrame(rows[:500], schema), ["n"], ["c"])
    store.add("b", spark.createDataFrame(rows[500:], schema), ["n"], ["c"])
    counts = {(r["column"], r["value"]): r["count"] for r in store.category_counts().collect()}
    assert counts == {("c", v): c for v, c in Counter(r[1] for r in rows).items()}
    (row,) = store.numeric_stats().collect()
    assert row["mean"] == pytest.approx(sum(r[0] for r in rows) / 900)
    (row,) = store.distinct_estimates().collect()
    distinct = len({r[1] for r in rows})
    assert abs(row["estimate"] - distinct) <= 0.02 * distinct


def test_sketches_of_nothing_and_of_nulls(spark):
    empty = states.distinct_sketches(spark.createDataFrame([], "c string"), ["c"])
    assert empty.collect() == []
    nulls = states.distinct_sketches(spark.createDataFrame([(None,)] * 3, "c string"), ["c"])
    assert [r["estimate"] for r in states.distinct_estimates(nulls.unionAll(nulls)).collect()] == [1]
