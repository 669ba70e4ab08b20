"""Five-stage cleaning and packing of the document table; each stage reads the last one's rows.

Defined results: rows with null or empty texts fail the quality rules and go; very long texts
are read whole by every stage; rows that repeat a doc_id are judged each by their own text,
and stay or go together in the join; extra columns are kept up to the last stage, whatever
their names; an empty table passes through all stages without rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickmill.llm import jaccard, mixing, packing, quality, rules
from clickmill.llm.common import prepare_session
from clickmill.session import intermediate_tables, write_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the n-gram model."""
    prepare_session(spark)
    return rules.keep_passed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant predicts good."""
    prepare_session(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, at 5 words and 0.8."""
    prepare_session(spark)
    return jaccard.keep_one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prepare_session(spark)
    return mixing.repeat_mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their bins."""
    prepare_session(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# Trained models decide which documents stay, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again.

    What a stage wrote for itself is deleted once its result is written; the results, and what
    the last stage reads, go with the caller's block of ``intermediate_tables``.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with intermediate_tables(spark):
            docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}", outlives=True)
    return STAGES[-1][1](spark, docs, sf_dir)
