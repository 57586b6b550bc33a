"""Corpus pipeline: the training-data operators one after the other over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.stages import STAGES, run_stages

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each stage's rows are written and read again."""
    return run_stages(spark, sf_dir, STAGES)
