from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import crc_fold, words

from clickmill.llm import rules
from clickmill.llm.common import fold


def brute(text):
    found = words(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    counts = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n = len(found)
    failed = n < 50 or 100 * len(covered) > 50 * n
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return n, sum(map(len, found)), symbols, dup, len(covered), failed


def check_counts(rows):
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(r.text), r.doc_id
        assert not (r.base_failed and r.kept)


def test_counts_equal_brute_force_on_awkward_texts(awkward):
    got = rules.apply_rules(awkward, rules.RuleModel(None), ["doc_id", "text"]).collect()
    assert len(got) == awkward.count()
    check_counts(got)


def test_counts_equal_brute_force_on_documents(sample):
    check_counts(rules.apply_rules(sample, rules.RuleModel(None), ["doc_id", "text"]).collect())


def test_model_tells_bad_from_good_on_held_out_rows(spark, sample, sample_labels):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = rules.fit_rules(docs, labels, fold("doc_id", 5) == 0)
    got = rules.apply_rules(docs, model, ["doc_id"]).join(labels, "doc_id").collect()
    held = [r for r in got if crc_fold(r.doc_id) == 0]
    right = [(r.kept or r.n_words < 50) == (r.quality == 1) for r in held]
    assert len(held) > 50 and sum(right) / len(right) > 0.95


def brute_margin(model, text):
    """Weighted shares of the n-grams of one text, each n-gram hashed on its own."""
    found = words(text)
    total = model.intercept
    one = [rules.word_buckets(texts_of(" ".join(found[i : i + 1])))[0][0] for i in range(len(found))]
    two = [
        rules.word_buckets(texts_of(" ".join(found[i : i + 2])))[1][0]
        for i in range(len(found) - 1)
    ]
    three = [rules.char_buckets(texts_of(text[i : i + 3]))[0] for i in range(len(text or "") - 2)]
    for grams in (one, two, three):
        if grams:
            total += sum(model.weights[int(g[0])] for g in grams) / len(grams)
    return total


def texts_of(text):
    return next(t for _, t in rules.chunks(pa.array([text])))


def test_verdict_equals_brute_force(sample, sample_labels):
    """The verdict of a trained model on whole texts, n-gram by n-gram."""
    model = rules.fit_rules(sample, sample_labels, fold("doc_id", 5) == 0)
    assert model.weights is not None
    rows = rules.apply_rules(sample, model, ["doc_id", "text"]).collect()
    rows = [r for r in rows if r.n_words < 400][:80]
    assert {r.kept for r in rows} == {True, False}
    for r in rows:
        margin = model.slope * brute_margin(model, r.text) + model.offset
        expected = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        assert r.probability == pytest.approx(expected, abs=1e-9)
        assert r.kept == (not r.base_failed and expected >= rules.MIN_PROBABILITY)


def test_kept_columns_named_like_inner_ones(sample):
    kept = sample.selectExpr("doc_id", "text", "'a' as _text", "'b' as __text")
    got = rules.apply_rules(kept, rules.RuleModel(None), kept.columns).collect()
    check_counts(got)
    assert {(r["_text"], r["__text"]) for r in got} == {("a", "b")}


def test_rows_that_repeat_an_id_are_judged_by_their_own_text(spark, sample_labels):
    texts = ["one two", " ".join(f"w{i}" for i in range(80)), "one two", None]
    df = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string")
    got = rules.apply_rules(df, rules.RuleModel(None), ["doc_id", "text"]).collect()
    assert sorted(r.n_words for r in got) == [0, 2, 2, 80]
    assert rules.fit_rules(df, sample_labels.limit(0)).weights is None


def test_training_features_are_sparse_vectors_of_all_buckets(sample, sample_labels):
    from pyspark.sql import functions as F

    rows = rules._training_rows(sample, sample_labels, F.lit(False), 10**6).collect()
    texts = {r.doc_id: r.text for r in sample.collect()}
    assert len(rows) == sample_labels.filter("quality in (0, 1)").select("doc_id").distinct().count()
    for r in rows[:50]:
        (at,), (share,) = rules.sparse_features(texts_of(texts[r.doc_id]))
        assert r.features.size == rules.BUCKETS
        assert r.features.indices.tolist() == at.tolist()
        assert r.features.values.tolist() == share.tolist()


def test_no_labels_leave_the_base_rules(sample, sample_labels):
    model = rules.fit_rules(sample, sample_labels.limit(0))
    got = rules.apply_rules(sample, model, ["doc_id"]).collect()
    assert all(r.kept == (not r.base_failed) for r in got)


def test_stage_keeps_columns_and_rows_that_pass(awkward, sample_labels):
    got = rules.keep_passed(awkward, sample_labels)
    assert got.columns == awkward.columns
    assert all(len(words(r.text)) >= 50 for r in got.collect())


def test_empty_table(no_docs, sample_labels):
    model = rules.fit_rules(no_docs, sample_labels)
    assert rules.apply_rules(no_docs, model, ["doc_id"]).collect() == []


def test_chunks_do_not_change_counts():
    from clickmill.llm.text import chunks

    column = pa.array(["a b a b a b", None, "c", "a\na\na"] * 5)
    whole = [rules.rule_counts(t) for _, t in chunks(column)]
    small = [rules.rule_counts(t) for _, t in chunks(column, 3)]
    assert len(whole) == 1 and len(small) > 5
    for name in rules.COUNTS:
        parts = [int(x) for c in small for x in c[name]]
        assert parts == [int(x) for x in whole[0][name]]
