import zlib
from collections import defaultdict

from clickmill.llm import sharding


def check(df, shards):
    got = sharding.shard_documents(df, shards).collect()
    rows = [(r.doc_id, (r.text or "").encode()) for r in df.collect()]
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len(t) + 16, zlib.crc32(t)) for i, t in rows
    )
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    fair = sum(r.size for r in got) / shards
    largest = max(r.size for r in got)
    for s in range(shards):
        # Half a record over at either end, or half a group of equal texts.
        assert abs(sizes[s] - fair) <= largest + fair / sharding.WHOLE_GROUP
    return got


def test_documents(sample):
    check(sample, 10)
    check(sample, 40)


def test_half_of_all_rows_are_copies(spark):
    rows = [(i, "the same text " * 5 if i % 2 else f"text {i} " * (i % 40)) for i in range(4000)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), 8)
    copies = {r.shard for r in got if r.doc_id % 2}
    assert len(copies) >= 2
    assert sorted(copies) == list(range(min(copies), max(copies) + 1))


def test_small_groups_of_equal_texts_stay_together(spark):
    rows = [(i, f"text {i // 3} " * 20) for i in range(3000)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), 5)
    shards = defaultdict(set)
    for r in got:
        shards[r.doc_id // 3].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_awkward_rows_and_clashing_columns(awkward):
    from pyspark.sql import functions as F

    df = awkward.withColumn("key", F.lit(1)).withColumn("shard", F.lit("x"))
    assert sharding.shard_documents(df.union(df), 3).count() == 2 * df.count()


def test_null_ids_and_fewer_rows_than_shards(spark):
    df = spark.createDataFrame([(None, None), (None, None), (1, "a")], "doc_id long, text string")
    check(df, 40)


def test_empty_table(no_docs):
    assert sharding.shard_documents(no_docs).collect() == []


def test_reruns_agree(sample):
    one = sharding.shard_documents(sample, 7).collect()
    two = sharding.shard_documents(sample.repartition(5), 7).collect()
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, two), key=str)


def test_many_small_rows_of_one_key_are_split_but_stay_together(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 50)
    kept = {}
    monkeypatch.setattr(
        sharding, "store", lambda df, name, f=sharding.store: kept.setdefault(name, f(df, name))
    )
    for long in (2_000, 80_000):
        kept.clear()
        rows = [(i, None if i % 3 == 0 else f"{i} " + "x" * long) for i in range(900)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = sharding.shard_documents(df, 10).collect()
        starts = sorted(r.row_start for r in kept["cell-starts"].collect())
        assert max(b - a for a, b in zip(starts, [*starts[1:], 900], strict=True)) <= 120
        assert sorted(r.doc_id for r in got) == list(range(900))
        for shard in {r.shard for r in got}:
            slots = sorted(r.slot for r in got if r.shard == shard)
            assert slots == list(range(len(slots)))
        # 4800 bytes: at 80 KB a text less than a fiftieth of a fair share.
        if long == 80_000:
            assert len({r.shard for r in got if r.size == 16}) == 1
