"""Stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``.

Each takes all documents that the one before kept and, but for the last, returns their columns.
Empty tables pass through; null texts are rejected by the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, table
from tidemark.session import apply_session_settings

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules and the isolation forest keep."""
    from tidemark.llm.quality import keep_good
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand earlier in the corpus; ``n_chars`` follows the text."""
    from tidemark.llm.lines import ANY_LINE, deduplicated_lines
    kept = deduplicated_lines(docs, min_exact=ANY_LINE)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    from tidemark.llm.jaccard import one_of_each
    return one_of_each(docs, n_gram=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    from tidemark.llm.decontaminate import decontaminate
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens, packed into sequences."""
    from tidemark.llm.catalog import tokenizer_path
    from tidemark.llm.packing import packed_documents
    return packed_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run_stages(spark: SparkSession, sf_dir: str, stages: list[tuple[str, Stage]]) -> DataFrame:
    apply_session_settings(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in stages:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
