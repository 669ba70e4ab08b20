import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmill.llm import neighbours
from clickmill.llm.common import store

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    ok = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if any(v):
            ok.setdefault(len(v), []).append((i, np.array(v, dtype=np.float64)))
    most = max(ok, key=lambda n: (len(ok[n]), -n)) if ok else None
    own = sorted(ok.get(most, []), key=lambda x: x[0])
    found = {}
    for q, v in own:
        if q % every == 0:
            scored = sorted((-float((v * w).sum()), i) for i, w in own if i != q)
            found[q] = [(i, -s) for s, i in scored[:k]]
    return found


def collect(df, k=20, every=20):
    found: dict = {}
    got = neighbours.nearest(df, F.col("id") % every == 0, k).collect()
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        own = found.setdefault(r.query_id, [])
        assert r.rank == len(own) + 1
        own.append((r.vec_id, r.score))
    return found


def test_recall_and_exact_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    expected = brute([(r.vec_id, r.embedding) for r in df.collect()])
    got = collect(df)
    assert got.keys() == expected.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.98 * 20 * len(expected)
    assert all(len(got[q]) == 20 for q in got)


def test_clustered_vectors_in_many_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "VECTORS_PER_LIST", 40)
    monkeypatch.setattr(neighbours, "PART_BYTES", 8 * 48 * 16)
    monkeypatch.setattr(neighbours, "VECTOR_BLOCK", 5)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 48)) * 3
    data = [centres[k % 12] + rng.standard_normal(48) for k in range(900)]
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(data)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute([(r.vec_id, r.embedding) for r in df.collect()])
    got = collect(df)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * 20 * len(expected)


def recall(got, expected):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    return hits / sum(len(v) for v in expected.values())


@pytest.mark.parametrize("kind", ["even", "clustered", "norms"])
def test_recall_in_tables_beyond_the_sample(spark, monkeypatch, kind):
    """The sample holds a small part of the table, and the lists decide."""
    monkeypatch.setattr(neighbours, "SAMPLE", 600)
    monkeypatch.setattr(neighbours, "VECTORS_PER_LIST", 200)
    monkeypatch.setattr(neighbours, "PART_BYTES", 8 * 64 * 100)
    rng = np.random.default_rng(9)
    data = rng.standard_normal((4000, 64))
    if kind == "clustered":
        data = data * 0.7 + 2 * rng.standard_normal((30, 64))[rng.integers(0, 30, 4000)]
    if kind == "norms":
        data *= rng.lognormal(0, 0.5, 4000)[:, None]
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(data)]
    df = store(spark.createDataFrame(rows, SCHEMA), "vectors")
    x = np.array(df.orderBy("vec_id").toArrow()["embedding"].to_pylist())
    expected = {}
    for q in range(0, 4000, 20):
        scores = x @ x[q]
        scores[q] = -np.inf
        expected[q] = [(int(i), float(scores[i])) for i in np.argsort(-scores)[:20]]
    got = collect(df)
    assert {q: len(v) for q, v in got.items()} == dict.fromkeys(expected, 20)
    assert recall(got, expected) >= 0.95


def test_small_clusters_get_all_their_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "VECTORS_PER_LIST", 100)
    monkeypatch.setattr(neighbours, "SAMPLE", 400)
    rng = np.random.default_rng(5)
    data = []
    for c in range(11):
        centre = rng.standard_normal(16) * 3
        data += [centre + 0.2 * rng.standard_normal(16) for _ in range(100 if c < 8 else 5)]
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(data)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute([(r.vec_id, r.embedding) for r in df.collect()], every=1)
    got = collect(df, every=1)
    assert {q: len(v) for q, v in got.items()} == dict.fromkeys(range(len(data)), 20)
    few = range(800, len(data))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in few)
    assert hits >= 0.9 * 20 * len(few)
    for q in got:
        scores = [float(np.float32(data[q]).astype(float) @ np.float32(data[i])) for i, _ in got[q]]
        assert [s for _, s in got[q]] == pytest.approx(scores)


def test_copies_ties_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(6)
    base = [float(x) for x in rng.standard_normal(8)]
    rows = [(k, base, 0) for k in range(0, 200)]
    rows += [(k, [float(x) for x in rng.standard_normal(8)], 0) for k in range(200, 260)]
    rows += [
        (300, None, 0),
        (320, [0.0] * 8, 0),
        (340, [1.0] * 7 + [None], 0),
        (360, [1.0] * 7 + [float("nan")], 0),
        (380, [1.0] * 7 + [float("inf")], 0),
        (400, [1.0] * 5, 0),
        (420, [], 0),
        (None, base, 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rep", F.lit("clash"))
    expected = brute([(r.vec_id, r.embedding) for r in df.collect()])
    got = collect(df)
    assert got.keys() == expected.keys()
    for q in expected:
        assert [i for i, _ in got[q]] == [i for i, _ in expected[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in expected[q]], abs=1e-12)


def test_fewer_candidates_than_asked(spark):
    rows = [(20 * k, [float(k + 1), 1.0], 0) for k in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {q: len(v) for q, v in collect(df).items()} == {0: 2, 20: 2, 40: 2}
    assert collect(spark.createDataFrame(rows[:1], SCHEMA)) == {}


def test_empty_table(spark):
    assert collect(spark.createDataFrame([], SCHEMA)) == {}


def test_scan_keeps_every_pair_above_the_threshold_nearly_always():
    rng = np.random.default_rng(7)
    q, x = rng.standard_normal((50, 64)), rng.standard_normal((500, 64))
    exact = q @ x.T
    least = np.sort(exact, axis=1)[:, -20]
    rotation = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    at_q, at_x, scores = neighbours.scan(q, x, least, rotation)
    assert np.allclose(scores, exact[at_q, at_x])
    assert (scores >= least[at_q] - 1e-6).all()
    assert len(at_q) >= 0.97 * 20 * 50


def test_scan_that_is_sure_loses_no_pair():
    rng = np.random.default_rng(8)
    q, x = rng.standard_normal((50, 64)), rng.standard_normal((500, 64))
    exact = q @ x.T
    least = np.sort(exact, axis=1)[:, -20]
    rotation = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    at_q, at_x, _ = neighbours.scan(q, x, least - 1e-9, rotation, sure=True)
    assert len(at_q) == 20 * 50
    at, rep, score = neighbours.best_of_part(q, x, np.arange(500), least - 9, rotation, 20, True)
    assert (np.sort(exact, axis=1)[:, :-21:-1].ravel() == pytest.approx(score))
    assert (at == np.repeat(np.arange(50), 20)).all() and len(rep) == 1000
