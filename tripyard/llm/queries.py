"""The registered queries of this subpackage: thin wraps of its operators.

Each reads its whole tables and returns the operator's full result; the
columns are digests derived from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripyard.llm import (
    chat_format,
    decontamination,
    exact_dedup,
    html_extraction,
    language_id,
    line_dedup,
    lm_scoring,
    ngram_join,
    packing,
    periodic_runs,
    spelling_variants,
    topk_search,
    url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), k=3, num=9, den=10)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup_lines(_table(spark, sf_dir, "documents")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(_table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.with_control_case(spark, _table(spark, sf_dir, "conversations"))
    return chat_format.digest(chat_format.format_conversations(rows))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(_table(spark, sf_dir, "pages"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scores(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontamination.digest(decontamination.contamination(documents, benchmark))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(_table(spark, sf_dir, "documents"))


def op12_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), control=True))


QUERIES = (op1_ngram_jaccard_join, op2_line_dedup, op3_language_id, op4_url_filter, op5_best_fit_packing,
           op6_chat_format, op7_exact_dedup, op8_html_extraction, op9_lm_scoring, op10_decontamination,
           op11_spelling_variants, op12_exact_topk_search, op13_periodic_runs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the tests hold the others
    (3, 4, 5, 8, 9) against brute force, round trips or held-out rows."""
    return {
        "op1_ngram_jaccard_join": ngram_join.oracle_sql(),
        "op2_line_dedup": line_dedup.oracle_sql(),
        "op6_chat_format": chat_format.oracle_sql(),
        "op7_exact_dedup": exact_dedup.oracle_sql(),
        "op10_decontamination": decontamination.oracle_sql(),
        "op11_spelling_variants": spelling_variants.oracle_sql(),
        "op12_exact_topk_search": topk_search.oracle_sql(),
        "op13_periodic_runs": periodic_runs.oracle_sql(),
    }
