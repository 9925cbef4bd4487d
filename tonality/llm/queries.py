"""The registered queries of the numbered operators, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tonality.llm import (collocations, decontaminate, html_text, language, licenses, merkle, mix, ngram_join, pii,
                          repeats, substring_dedup, topk, url_filter)
from tonality.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.prepared(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter(F.col("id") % 100 == 0))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cut_repeats(table(spark, sf_dir, "documents"), shared=True)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(table(spark, sf_dir, "documents"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_html_text": op2_html_text,
    "op3_license_scan": op3_license_scan,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_pii": op5_pii,
    "op6_language_id": op6_language_id,
    "op7_mix_sources": op7_mix_sources,
    "op8_url_filter": op8_url_filter,
    "op9_ngram_join": op9_ngram_join,
    "op10_repeats": op10_repeats,
    "op11_collocations": op11_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_substring_dedup": op13_substring_dedup,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op4_exact_top_k": topk.ORACLE,
    "op7_mix_sources": mix.ORACLE.format(docs="documents"),
    "op9_ngram_join": ngram_join.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_substring_dedup": substring_dedup.ORACLE,
}
