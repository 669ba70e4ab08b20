import hashlib
import math

import numpy as np
import pytest

from clickmill.llm import bitplanes

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute_force(rows, count=16, rounds=3):
    kept = [
        (i, [math.floor(64 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    token = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: (r[0] is None, token(r[0])))[:count]
    centroids = [list(v) for _, v in first]

    def nearest(v):
        away = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[0], []).append(v)
        for c, members in groups.items():
            centroids[c] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found]


def clustered(spark, rows, kind="float", **options):
    frame = spark.createDataFrame(
        [(i, v, 3, "x") for i, v in rows],
        f"vec_id long, embedding array<{kind}>, cluster int, planes string",
    )
    got = bitplanes.cluster_vectors(frame.repartition(3), **options)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


def test_packing_is_exact():
    rng = np.random.default_rng(1)
    for most in (1, 2, 64, 1000, 1 << 27):
        values = rng.integers(-most, most, (50, 64))
        planes = bitplanes.pack_planes(values)
        assert (bitplanes.unpack_planes(planes) == values).all()
        others = rng.integers(-100, 100, (7, 64))
        dots = bitplanes.dot_products(planes, bitplanes.pack_planes(others))
        assert (dots == values @ others.T).all()


@pytest.mark.parametrize("scale", [0.02, 0.5, 30.0])
def test_equals_brute_force(spark, scale):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(0, scale, 64).tolist()) for i in range(300)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert clustered(spark, rows) == sorted(brute_force(rows), key=str)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(0, 0.3, 64).tolist()) for i in range(40)]
    same = [(100 + i, good[0][1]) for i in range(30)]
    zeros = [(200, [0.0] * 64), (201, [-0.0] * 64), (202, [1e5] * 64)]
    bad = [
        (300, None),
        (301, []),
        (302, [0.1] * 63),
        (303, [0.1] * 65),
        (304, [None] + [0.1] * 63),
        (305, [float("nan")] + [0.1] * 63),
        (306, [float("inf")] + [0.1] * 63),
    ]
    rows = good + same + zeros
    assert clustered(spark, rows + bad, "double") == sorted(brute_force(rows), key=str)


def test_null_and_repeated_ids(spark):
    v = [[float(i % 5) / 3] * 64 for i in range(40)]
    rows = [(i // 2, v[i - i % 2]) for i in range(36)] + [(None, v[36]), (None, v[37])]
    assert clustered(spark, rows, "double") == sorted(brute_force(rows), key=str)


def test_few_and_no_vectors(spark):
    rows = [(1, [0.5] * 64), (2, [0.25] * 64)]
    assert clustered(spark, rows) == sorted(brute_force(rows), key=str)
    assert clustered(spark, []) == []
    assert clustered(spark, [(1, None)]) == []


def test_other_counts_and_rounds(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 64)]) for i in range(120)]
    assert clustered(spark, rows, count=3, rounds=6) == sorted(brute_force(rows, 3, 6), key=str)


def test_components_beyond_the_bound_stop_the_job(spark):
    with pytest.raises(Exception, match=r"beyond 2\^27"):
        clustered(spark, [(1, [1e30] * 64)], "double")
