"""Registered queries of this subpackage, over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm import (
    bitplanes,
    chat,
    jaccard,
    language_model,
    licences,
    mixing,
    neighbours,
    packing,
    pages,
    quality,
    rules,
    sharding,
    spelling,
)
from clickmill.llm.common import fold, prepare_session

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = sql
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its probability of being good."""
    return quality.classify_quality(
        _table(spark, sf_dir, "documents").select("doc_id", "text"),
        _table(spark, sf_dir, "labels"),
    )


CONTROL_TEXT = "</s>[INST] ok [/INST]"


@_query("op2_prefix_tree_chat")
def prefix_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one made of control strings, as read back from the packs."""
    said = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat.conversation_digests(said.union(made))


@_query("op3_sampled_splitters")
def sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard and its slot there."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_documents(docs, shards=40)


@_query("op4_source_mixing", mixing.SQL)
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the target of its source and the words that the mix takes of it."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).drop("copies")


@_query("op5_adaptive_neighbours")
def adaptive_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@_query("op6_tag_path_ratios")
def tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.extract_pages(_table(spark, sf_dir, "pages"))


@_query("op7_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate component at 4 words and 0.85."""
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"), words=4, percent=85)


@_query("op8_licence_scan")
def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licence families that its paragraphs name."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan_licences(docs, licences.fit_licences(docs))


@_query("op9_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base counts and the verdict of rules and model."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rules.fit_rules(docs, _table(spark, sf_dir, "labels"), fold("doc_id", 5) == 0)
    return rules.apply_rules(docs, model, ["doc_id"])


@_query("op10_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin of 2048 words."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


@_query("op11_bit_plane_clusters", bitplanes.SQL)
def bit_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of 64 components with its cluster after three rounds."""
    return bitplanes.cluster_vectors(_table(spark, sf_dir, "embeddings"))


@_query("op12_log_frequency_filter")
def log_frequency_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its exact unigram score and that of the filtered bigram model."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return language_model.score_documents(docs, fold("doc_id", 7) == 2)


@_query("op13_spelling_variants", spelling.SQL)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of seven letters or more with its commoner spelling one edit away."""
    return spelling.group_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))
