import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import crc_fold

from clickmill.llm import quality


def test_held_out_rows_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.classify_quality(docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (crc_fold(r.doc_id) == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    right = [r.predicted == r.quality for r in held]
    assert len(held) > 50 and sum(right) / len(right) > 0.95


def test_labels_of_held_out_rows_have_no_say(sample, sample_labels):
    from pyspark.sql import functions as F

    from clickmill.llm.common import fold

    turned = sample_labels.withColumn(
        "quality",
        F.when(fold("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")),
    )
    one = {r.doc_id: r.score for r in quality.classify_quality(sample, sample_labels).collect()}
    two = {r.doc_id: r.score for r in quality.classify_quality(sample, turned).collect()}
    assert all(abs(one[k] - two[k]) < 1e-6 for k in one)


def brute_scores(docs, labels, shrinkage=0.6, ridge=0.1):
    """Scores by log densities of two normal laws, written with inverses and determinants."""
    x = {}
    for r in docs:
        (_, texts), *more = quality.chunks(pa.array([r.text]))
        assert not more
        x[r.doc_id] = quality.statistics(texts)[0]
    train = [(r.doc_id, r.quality) for r in labels if r.doc_id in x and crc_fold(r.doc_id) != 0]
    fitted = [(x[i], y) for i, y in train if crc_fold(i) != 4]
    of = [np.array([v for v, y in fitted if y == k]) for k in (0, 1)]
    d = len(of[0][0])
    covariances = [np.cov(rows.T, bias=True) for rows in of]
    pooled = sum(len(r) * c for r, c in zip(of, covariances)) / len(fitted)
    variances = np.diag(np.maximum(np.diag(pooled), 1e-4))

    def difference(v):
        logs = []
        for rows, own in zip(of, covariances):
            weight = min(1.0, shrinkage + d / (d + len(rows)))
            c = (1 - ridge) * ((1 - weight) * own + weight * pooled) + ridge * variances
            z = v - rows.mean(axis=0)
            logs.append(-0.5 * z @ np.linalg.solve(c, z) - 0.5 * np.linalg.slogdet(c)[1])
        return np.clip(logs[1] - logs[0], -quality.LIMIT, quality.LIMIT)

    # The curve: penalised likelihood over binned differences, by plain gradient steps.
    bins = np.array([np.round(difference(x[i]) / quality.BIN) for i, _ in train if crc_fold(i) == 4])
    y = np.array([y for i, y in train if crc_fold(i) == 4])
    z = bins * quality.BIN
    a, b = 0.1, 0.0
    steps = 1 / (0.5 * z @ z + 100), 1 / (0.5 * len(z) + 1)
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-(a * z + b)))
        a += steps[0] * (z @ (y - p) - 100 * (a - 0.1))
        b += steps[1] * ((y - p).sum() - b)
    return {i: 1 / (1 + np.exp(-(a * difference(v) + b))) for i, v in x.items()}


def test_scores_equal_brute_force(sample, sample_labels):
    got = {r.doc_id: r.score for r in quality.classify_quality(sample, sample_labels).collect()}
    expected = brute_scores(sample.collect(), sample_labels.collect())
    assert got.keys() == expected.keys()
    for i, score in expected.items():
        assert got[i] == pytest.approx(score, abs=1e-4), i


def test_rows_that_repeat_an_id_are_scored_by_their_own_text(sample, sample_labels):
    two = sample.limit(2).selectExpr("7L as doc_id", "text")
    model_rows = sample.select("doc_id", "text").filter("doc_id <> 7")
    both = quality.classify_quality(model_rows.union(two), sample_labels.filter("doc_id <> 7"))
    scores = sorted(r.score for r in both.filter("doc_id = 7").collect())
    alone = quality.classify_quality(sample, sample_labels.filter("doc_id <> 7"))
    ids = [r.doc_id for r in sample.limit(2).collect()]
    expected = sorted(r.score for r in alone.collect() if r.doc_id in ids)
    assert len(scores) == 2 and scores == pytest.approx(expected, abs=1e-6)


def test_kept_columns_named_like_inner_ones(sample):
    kept = sample.selectExpr("doc_id", "text", "'a' as _text")
    got = quality.features(kept, ["doc_id", "_text"]).collect()
    assert len(got) == sample.count() and {r._text for r in got} == {"a"}


def test_awkward_texts_have_scores(awkward, sample_labels):
    got = quality.classify_quality(awkward, sample_labels).collect()
    assert len(got) == awkward.count()
    assert all(0 <= r.score <= 1 for r in got)


def test_without_labels_scores_are_one_half(sample, sample_labels):
    got = quality.classify_quality(sample, sample_labels.limit(0)).collect()
    assert {r.score for r in got} == {0.5}


def test_one_label_only_gives_its_share(sample, sample_labels):
    got = quality.classify_quality(sample, sample_labels.filter("quality = 1")).collect()
    assert {r.score for r in got} == {1.0}


def test_empty_table(no_docs, sample_labels):
    assert quality.classify_quality(no_docs, sample_labels).collect() == []


def test_stage_keeps_columns(awkward, sample_labels):
    assert quality.keep_good(awkward, sample_labels).columns == awkward.columns
