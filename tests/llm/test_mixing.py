import hashlib
import math
from collections import defaultdict

import duckdb
import pytest
from llm_helpers import words

from clickmill.llm import mixing


def brute(rows):
    """Taken words per row by sorting, with resharing as the rule is worded."""
    sizes = [len(words(t)) for _, t, _ in rows]
    totals = defaultdict(int)
    for (_, _, s), n in zip(rows, sizes, strict=True):
        totals[s] += n
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    limited: set = set()
    while True:
        left = sum(totals.values()) - sum(3 * totals[s] for s in limited)
        shares = sum(weight[s] for s in order if s not in limited)
        target = {
            s: 3.0 * totals[s] if s in limited else left * weight[s] / shares for s in order
        }
        over = {s for s in order if s not in limited and target[s] >= 3 * totals[s]}
        if not over:
            break
        limited |= over
    taken = [0] * len(rows)
    for s in order:
        own = [i for i, r in enumerate(rows) if r[2] == s]
        code = {i: hashlib.md5(str("" if rows[i][0] is None else rows[i][0]).encode()).hexdigest()[:15] for i in own}
        rounds = math.floor(target[s] / totals[s]) if totals[s] else 0
        rest = target[s] - rounds * totals[s]
        groups = defaultdict(list)
        for i in own:
            groups[code[i]].append(i)
        filled, done = 0, False
        for key in sorted(groups):
            n = sum(sizes[i] for i in groups[key])
            within = filled + n <= rest
            nearer = not within and filled < rest and filled + n - rest < rest - filled
            extra = not done and (within or nearer)
            done = done or not within
            for i in groups[key]:
                taken[i] = sizes[i] * (rounds + extra)
            filled += n
    return sizes, [target[r[2]] for r in rows], taken


def check(df):
    rows = [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]
    sizes, target, taken = brute(rows)
    got = mixing.mix_sources(df).collect()
    assert sorted((str(r.doc_id), r.size, r.taken) for r in got) == sorted(
        (str(rows[i][0]), sizes[i], taken[i]) for i in range(len(rows))
    )
    expected = sorted(zip([str(r[0]) for r in rows], target, strict=True))
    for (i, x), (j, y) in zip(sorted((str(r.doc_id), r.target) for r in got), expected, strict=True):
        assert i == j and x == pytest.approx(y)


def test_documents_equal_brute_force(sample):
    check(sample)


def test_awkward_rows_small_sources_and_null_source(spark, awkward):
    from pyspark.sql import functions as F

    source = F.when(F.col("doc_id") < 8, "tiny").when(F.col("doc_id") < 13, "ä").otherwise(None)
    df = awkward.withColumn("source", source).withColumn("size", F.lit("clash"))
    check(df.unionByName(df.filter("doc_id in (9, 14)")))


def test_equal_ids_and_one_source(spark):
    df = spark.createDataFrame([(1, "a b c", "s")] * 3 + [(None, "a", "s")], "doc_id long, text string, source string")
    check(df)


def test_sql_twin(sample):
    con = duckdb.connect()
    con.sql("create view documents as from '/root/testdata/sf0.001/documents.parquet'")
    expected = con.sql(mixing.SQL).fetchall()
    got = mixing.mix_sources(sample).drop("copies").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_stage_repeats_rows_as_taken(sample):
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix_sources(sample).collect() if r.size}
    got = mixing.repeat_mixed(sample)
    assert got.columns == sample.columns
    counts = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counts == {k: n for k, n in taken.items() if n}


def test_stage_keeps_columns_named_like_inner_ones(sample):
    from pyspark.sql import functions as F

    names = ["_size", "_hash", "_copies", "_copy", "_source", "_row", "_target", "_cut", "size"]
    clashing = sample.select("*", *(F.lit(n).alias(n) for n in names))
    got = mixing.repeat_mixed(clashing)
    assert got.columns == clashing.columns
    assert {tuple(r[n] for n in names) for r in got.collect()} == {tuple(names)}
    plain = mixing.repeat_mixed(sample)
    assert got.drop(*names).exceptAll(plain).count() == 0 == plain.exceptAll(got.drop(*names)).count()


def test_empty_table(no_docs):
    assert mixing.mix_sources(no_docs).collect() == []
    assert mixing.repeat_mixed(no_docs).collect() == []
