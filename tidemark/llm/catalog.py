"""The registered queries of the subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.session import apply_session_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_session_settings(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.packing import packed_documents
    return packed_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.decontaminate import contamination_report
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.jaccard import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.quality import judged
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.personal import personal_data_report
    return personal_data_report(table(spark, sf_dir, "documents"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.language import identified_languages
    return identified_languages(table(spark, sf_dir, "documents"))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.lines import ANY_LINE, line_report
    return line_report(table(spark, sf_dir, "documents"), min_exact=ANY_LINE)


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.licenses import licence_report
    return licence_report(table(spark, sf_dir, "documents"))


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.html_text import extracted_text
    return extracted_text(table(spark, sf_dir, "pages"))


@query
def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.warc import fixity_report
    from tidemark.session import scratch_path
    return fixity_report(table(spark, sf_dir, "pages"), scratch_path(spark, "llm-warc"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.middle import fill_in_middle_report
    return fill_in_middle_report(table(spark, sf_dir, "documents"))


@query
def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.mixing import mix_report
    return mix_report(table(spark, sf_dir, "documents"))


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.trie import conversation_trie
    return conversation_trie(table(spark, sf_dir, "conversations"))


def _oracles() -> dict[str, str]:
    from tidemark.llm import middle, mixing, trie
    return {"op11_source_mix": mixing.SQL, "op12_conversation_trie": trie.SQL, "op13_fill_in_middle": middle.SQL}


ORACLES.update(_oracles())
