"""Results do not depend on whether bounded sets of rows are broadcast or shuffled."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickmill.llm import common, queries
from clickmill.session import intermediate_tables, shared_folder

SF_DIR = "/root/testdata/sf0.001"
NAMES = [
    "op1_quality_classifier",
    "op2_prefix_tree_chat",
    "op3_sampled_splitters",
    "op4_source_mixing",
    "op5_adaptive_neighbours",
    "op7_jaccard_join",
    "op10_best_fit_packing",
    "pipeline",
]


def rows(spark, name):
    query = corpus_pipeline.run if name == "pipeline" else queries.queries()[name]
    with intermediate_tables(spark):
        got = query(spark, SF_DIR)
        # Sums of floating-point numbers differ by the order in which tasks end.
        for column, kind in got.dtypes:
            if kind == "double":
                got = got.withColumn(column, F.round(column, 6))
        return sorted(map(tuple, got.collect()), key=str)


@pytest.fixture
def shuffled(spark, monkeypatch):
    """A session in which every set of rows is too large to be broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    yield
    spark.conf.set(key, before)


@pytest.fixture(scope="module")
def by_broadcast(spark):
    return {name: rows(spark, name) for name in NAMES}


@pytest.mark.parametrize("name", NAMES)
def test_shuffled_rows_give_the_same_result(spark, by_broadcast, shuffled, name):
    got = rows(spark, name)
    assert len(got) == len(by_broadcast[name]) > 0
    assert got == by_broadcast[name]


def test_a_block_leaves_no_tables_behind(spark):
    folder = os.path.join(shared_folder(spark), "clickmill")
    before = set(glob.glob(f"{folder}/*"))
    rows(spark, "pipeline")
    assert set(glob.glob(f"{folder}/*")) == before


def test_the_pipeline_keeps_only_stage_results_and_the_last_stage_tables(spark):
    folder = os.path.join(shared_folder(spark), "clickmill")
    before = set(glob.glob(f"{folder}/*"))
    rows_out = corpus_pipeline.run(spark, SF_DIR).count()
    made = {os.path.basename(p) for p in set(glob.glob(f"{folder}/*")) - before}
    kept = {name for name, _ in corpus_pipeline.STAGES[:-1]}
    assert {m.split("-")[1] for m in made if m.startswith("pipeline-")} == kept
    assert all(m.startswith(("pipeline-", "packing")) for m in made)
    assert rows_out > 0


AWKWARD_NAMES = ["_size", "_hash", "_text", "rep", "component", "node", "n", "features", "_row"]


def test_stages_handle_nulls_repeats_and_clashing_names(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    fields = docs.columns
    odd = docs.limit(3).union(docs.limit(3))
    odd = odd.union(docs.limit(2).withColumn("text", F.lit(None).cast("string")).select(fields))
    odd = odd.union(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")).select(fields))
    odd = odd.union(docs.limit(2).withColumn("source", F.lit(None).cast("string")).select(fields))
    long_text = F.concat_ws(" ", F.expr("transform(sequence(1, 60000), i -> concat('w', i))"))
    odd = odd.union(docs.limit(1).withColumn("text", long_text).select(fields))
    rows_in = docs.union(odd).select("*", *(F.lit(x).alias(x) for x in AWKWARD_NAMES))
    kept = rows_in
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.store(stage(spark, kept, SF_DIR), f"odd-{name}")
        assert kept.columns == rows_in.columns
        assert kept.filter("text is null or text = ''").count() == 0
        got = kept.select(*AWKWARD_NAMES).distinct().collect()
        assert [tuple(r) for r in got] == [tuple(AWKWARD_NAMES)]
    assert corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR).count() > 0
