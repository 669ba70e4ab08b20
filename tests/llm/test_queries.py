import duckdb
import pytest
from llm_helpers import words

import corpus_pipeline
from clickmill.llm import queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")

COLUMNS = {
    "op1_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op2_prefix_tree_chat": [
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
    ],
    "op3_sampled_splitters": [
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard",
    ],
    "op4_source_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op5_adaptive_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op6_tag_path_ratios": ["page_id", "url", "text", "n_chars"],
    "op7_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op8_licence_scan": [
        "doc_id", "n_windows", "n_hits", "family", "probability", "families",
    ],
    "op9_quality_rules": [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "probability",
    ],
    "op10_best_fit_packing": ["doc_id", "piece", "n_words", "bin", "start"],
    "op11_bit_plane_clusters": [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256",
    ],
    "op12_log_frequency_filter": [
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
    ],
    "op13_spelling_variants": ["word", "form", "root", "n", "n_near", "form_n"],
}


def test_one_query_for_every_operator():
    assert sorted(queries.queries()) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_covers_its_table(spark, name):
    got = queries.queries()[name](spark, SF_DIR)
    assert got.columns == COLUMNS[name]
    rows = got.collect()
    if "doc_id" in got.columns:
        ids = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
        assert {r.doc_id for r in rows} == ids
        assert name == "op10_best_fit_packing" or len(rows) == len(ids)
    if name == "op2_prefix_tree_chat":
        made = [r for r in rows if r.conv_id == -7]
        assert len(made) == 1 and made[0].n_turns == 2
        assert made[0].loss_chars == len(queries.CONTROL_TEXT)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as from '{SF_DIR}/{table}.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    got = queries.queries()[name](spark, SF_DIR).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(found.fetchall())


def test_stages_return_documents_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "jaccard_join", "source_mixing", "best_fit_packing",
    ]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, before, SF_DIR)
        assert kept.columns == docs.columns
        assert kept.exceptAll(before).count() == 0 or name == "source_mixing"
        assert kept.join(before, "doc_id", "left_anti").count() == 0
        kept = kept.cache()
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR).collect()
    total = sum(len(words(r.text)) for r in kept.collect())
    assert sum(r.n_words for r in packed) == total > 0
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept.collect()}


def test_pipeline_keeps_clean_documents_and_drops_copies(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    passed = stages["quality_rules"](spark, docs, SF_DIR)
    passed = stages["quality_classifier"](spark, passed, SF_DIR)
    good = docs.join(labels.filter("quality = 1"), "doc_id").filter(
        "size(split(trim(text), '\\\\s+')) >= 60"
    )
    lost = good.join(passed, "doc_id", "left_anti").count()
    assert lost <= 0.03 * good.count()
    one = stages["jaccard_join"](spark, docs, SF_DIR)
    texts = [r.text for r in one.collect() if words(r.text)]
    assert len({t.lower() for t in texts}) == len(texts)


def test_pipeline_runs_on_an_empty_table(spark, no_docs):
    kept = no_docs.selectExpr("*", "0L as n_chars")
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SF_DIR)
    assert kept.count() == 0
