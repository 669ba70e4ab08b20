from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from llm_helpers import words

from clickmill.llm import packing


@pytest.mark.parametrize("seed", range(4))
def test_bins_are_the_tightest_compatible_ones(seed):
    rng = np.random.default_rng(seed)
    items = [
        (int(rng.integers(1, 101)), int(rng.integers(3)), int(rng.integers(60)) if k % 2 else 0)
        for k in range(300)
    ]
    items.sort(key=lambda x: -x[0])
    bins = packing.Bins(100, 2)
    opened = []
    for size, source, cluster in items:
        fits = [
            b["left"]
            for b in opened
            if b["left"] >= size
            and cluster not in b["clusters"]
            and b["sources"].count(source) < 2
        ]
        at, start = bins.put(size, source, cluster)
        # The residual chosen is the least of all open bins that can take the document.
        assert 100 - start == min(fits, default=100)
        if at == len(opened):
            assert not fits
            opened.append({"left": 100, "clusters": set(), "sources": []})
        own = opened[at]
        assert own["left"] == 100 - start and cluster not in own["clusters"]
        assert own["sources"].count(source) < 2
        own["left"] -= size
        own["clusters"].add(cluster)
        own["sources"].append(source)


def check(df, capacity=64, per_source=2):
    docs = df.collect()
    got = packing.pack_documents(df, capacity=capacity, per_source=per_source).collect()
    total = defaultdict(int)
    for r in docs:
        total[r.doc_id] += len(words(r.text))
    found, bins = defaultdict(int), defaultdict(list)
    for r in got:
        found[r.doc_id] += r.n_words
        assert (r.bin is None) == (r.n_words == 0)
        if r.bin is not None:
            bins[r.bin].append(r)
    assert found == total
    text = {r.doc_id: " ".join(words(r.text)).lower() for r in docs}
    source = {r.doc_id: r.source for r in docs}
    for own in bins.values():
        own.sort(key=lambda r: r.start)
        ends = [0] + [r.start + r.n_words for r in own]
        assert [r.start for r in own] == ends[:-1] and ends[-1] <= capacity
        assert len({text[r.doc_id] for r in own}) == len(own)
        sources = [source[r.doc_id] for r in own]
        assert all(sources.count(s) <= per_source for s in sources)
    return got, bins


def test_documents(sample):
    got, bins = check(sample, 512, 4)
    used = sum(r.n_words for r in got)
    assert used / (512 * len(bins)) > 0.9


def test_awkward_rows(awkward):
    from pyspark.sql import functions as F

    df = awkward.withColumn("source", F.when(F.col("doc_id") > 5, "s")).withColumn("bin", F.lit("x"))
    got, _ = check(df)
    assert {r.doc_id for r in got if r.n_words == 0} == {0, 1, 2}


def test_a_third_of_all_rows_are_copies(spark):
    rows = [(i, "a b c d e f" if i % 3 == 0 else f"{i} x y z", "s" if i % 2 else None) for i in range(600)]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string"), 40, 9)


def test_null_and_large_ids(spark):
    big = 2**60 + 1
    df = spark.createDataFrame([(None, "a b", "s"), (big, "c", "s")], "doc_id long, text string, source string")
    got = packing.pack_documents(df, capacity=4).collect()
    assert {r.doc_id for r in got} == {None, big}


def test_repeated_rows_do_not_share_a_bin(spark):
    df = spark.createDataFrame([(1, "a b", "s")] * 3, "doc_id long, text string, source string")
    got = packing.pack_documents(df).collect()
    assert len({r.bin for r in got}) == 3


def test_empty_table(no_docs):
    assert packing.pack_documents(no_docs).collect() == []


def test_group_with_long_and_empty_documents():
    rows = pd.DataFrame(
        {"doc_id": ["1", "2"], "source": [None, "s"], "size": [25, 0], "cluster": [1, 2]}
    ).assign(piece=0, group=7)
    got = packing.pack_group(rows, 10, 1)
    assert got.n_words.tolist() == [10, 10, 5, 0] and got.piece.tolist() == [0, 1, 2, 0]
    assert got.bin.isna().tolist() == [False, False, False, True]
    assert got.held.tolist() == [10, 10, 5, 10]


def test_groups_lose_few_bins(spark, monkeypatch):
    """Groups of 100 rows need hardly more bins than one group of all rows."""
    rng = np.random.default_rng(3)
    rows = [
        (i, " ".join(f"{i}.{j}" for j in range(int(rng.integers(1, 120)))), f"s{i % 9}")
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    _, one = check(df, 256, 4)
    monkeypatch.setattr(packing, "GROUP_ROWS", 100)
    _, many = check(df, 256, 4)
    assert len(many) <= 1.01 * len(one)


def test_one_id_of_many_rows_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 50)
    monkeypatch.setattr(packing, "REPEATS", 10)
    seen = []
    rows = [(None, f"a{i} b", "s") for i in range(300)] + [(7, "same text", "t")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack_documents(df, capacity=8, per_source=8).collect()
    for r in got:
        seen.append((r.doc_id, r.n_words))
    assert sorted(seen, key=str) == sorted([(None, 2)] * 300 + [(7, 2)] * 300, key=str)
    groups = {r.bin >> 32 for r in got if r.doc_id == 7 and r.bin >> 58 == 0}
    assert len({r.bin for r in got if r.doc_id == 7}) == 300 and len(groups) > 4
