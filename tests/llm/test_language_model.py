import math
from collections import Counter

import numpy as np
import pytest
from llm_helpers import AWKWARD, crc_fold, words
from pyspark.sql import functions as F

from clickmill.llm import language_model as lm
from clickmill.llm.common import fold, prepare_session

END = object()
COLUMNS = [
    "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_force(rows):
    """Exact base score, and the model's from exact counts in the filter's levels."""
    single, pairs = Counter(), Counter()
    said = []
    for doc_id, text in rows:
        tokens = [*words(lower(text)), END]
        held_out = crc_fold("" if doc_id is None else doc_id, 7) == 2
        said.append((doc_id, held_out, tokens))
        if not held_out:
            single.update(tokens)
            pairs.update(zip([END, *tokens], tokens))
    total, distinct = sum(single.values()), len(single)

    def count(c):
        return (2 ** (c.bit_length() - 1) * 3 - 1) / 2 if c else 0

    found = []
    for doc_id, held_out, tokens in said:
        base = sum(math.log10((single[t] + 1) / (total + distinct + 1)) for t in tokens)
        score = 0
        for before, token in zip([END, *tokens], tokens):
            alone = (min(count(single[token]), total) + 1) / (total + distinct + 1)
            # A pair's level is that of the rarer word at most, which exact counts keep.
            score += math.log10(
                (count(pairs[before, token]) + lm.PRIOR * alone)
                / (count(single[before]) + lm.PRIOR)
            )
        known = sum(single[t] > 0 for t in tokens)
        found.append((doc_id, held_out, len(tokens), known, total, base, score))
    return found


def scored(docs, **limits):
    prepare_session(docs.sparkSession)
    got = lm.score_documents(docs, fold("doc_id", 7) == 2, **limits)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


def assert_alike(got, want, spare):
    want = sorted(want, key=str)
    exact = sorted((r[:5] for r in got), key=str)
    assert exact == sorted((r[:5] for r in want), key=str)
    far = []
    by_base = sorted(got, key=lambda r: (str(r[:5]), r[5]))
    for g, w in zip(by_base, sorted(want, key=lambda r: (str(r[:5]), r[5])), strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        # A false positive raises a level by one, seldom more, at every place of its n-gram:
        # few texts are far off, and none by more than a level at each of their tokens.
        assert g[6] == pytest.approx(w[6], abs=0.45 * w[2] + 0.7)
        far.append(g[6] != pytest.approx(w[6], rel=spare, abs=0.7))
    assert sum(far) <= 0.1 * len(far)


def test_documents_equal_brute_force(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert_alike(scored(sample), brute_force(rows), spare=0.03)


def test_awkward_texts(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert_alike(scored(awkward), brute_force(rows), spare=0.05)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b"), (None, None), (7, "a b"), (7, "a b"), (8, "B c"), (2, "a a a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert_alike(scored(docs), brute_force(rows), spare=0.05)


def test_cold_words_and_many_scans_give_the_same(sample):
    once = scored(sample)
    cold = scored(sample, hot_words=20)
    bytes_of_one = 40_000
    cut = scored(sample, hot_words=20, filter_bytes=bytes_of_one)
    for other in (cold, cut):
        assert [r[:5] for r in sorted(other)] == [r[:5] for r in sorted(once)]
        for a, b in zip(sorted(once), sorted(other), strict=True):
            assert a[5] == pytest.approx(b[5], rel=1e-9)
            assert a[6] == pytest.approx(b[6], rel=1e-9)


def test_too_small_a_limit_stops_the_job(sample):
    with pytest.raises(ValueError, match="FILTER_BYTES"):
        lm.score_documents(sample, fold("doc_id", 7) == 2, filter_bytes=10)


def test_the_model_knows_held_out_texts_better_than_shuffled_ones(sample):
    shuffled = sample.select(
        "doc_id",
        F.when(
            fold("doc_id", 7) == 2, F.array_join(F.reverse(F.split("text", r"\s+")), " ")
        ).otherwise(F.col("text")).alias("text"),
    )
    a = {r[0]: r[6] for r in scored(sample) if r[1]}
    b = {r[0]: r[6] for r in scored(shuffled) if r[1]}
    assert sum(a.values()) > sum(b.values())


def test_nothing_to_train_on(spark, no_docs):
    assert scored(no_docs) == []
    only = next(i for i in range(100) if crc_fold(i, 7) == 2)
    docs = spark.createDataFrame([(only, "a b")], "doc_id long, text string")
    (row,) = scored(docs)
    assert row[:6] == (only, True, 3, 0, 0, 0.0)


def test_filter_never_loses_a_level_and_seldom_adds_one():
    rng = np.random.default_rng(3)
    items = rng.integers(0, 1 << 63, 40_000, dtype=np.uint64) & ~np.uint64(lm.GROUPS - 1)
    levels = rng.integers(1, 12, len(items))
    piece = lm.build_piece(items[:20_000], levels[:20_000])
    found = lm.Filter([(0, 0, piece.tobytes())], 1)
    got = found.levels(items, np.zeros(len(items), dtype=np.int64), None)
    assert (got[:20_000] >= levels[:20_000]).all()
    assert (got[:20_000] > levels[:20_000]).mean() < 0.06
    assert (got[20_000:] > 0).mean() < 0.06
    assert lm.levels_of(np.array([1, 2, 3, 4, 7, 8])).tolist() == [1, 2, 2, 3, 3, 4]
