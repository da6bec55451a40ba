"""Queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallyspark.llm import (
    bench_decontam,
    crf_extract,
    exact_stream_dedup,
    feistel_pii,
    hamming_dedup,
    kronecker_negatives,
    license_scan,
    mixture_langid,
    prefix_trie,
    simhash_bitslice,
    sp_sampling,
    suffix_dedup,
    url_cascade,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(license_scan.scan_licenses(_table(spark, sf_dir, "documents")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_stream_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge_urls(_table(spark, sf_dir, "pages"))


def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_pii.pseudonymise(_table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op7_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_sampling.sample_segmentations(_table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_extract.extract_main_text(_table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bench_decontam.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_langid.identify(_table(spark, sf_dir, "documents"))


def op11_simhash_bitsliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bitslice.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_report(prefix_trie.build_trie(_table(spark, sf_dir, "conversations")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kronecker_negatives.mine_negatives(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_exact_dedup,
        op3_url_filter,
        op4_pii_pseudonyms,
        op5_near_dedup,
        op6_suffix_dedup,
        op7_sentencepiece_sampling,
        op8_html_extraction,
        op9_decontamination,
        op10_language_id,
        op11_simhash_bitsliced,
        op12_prefix_trie,
        op13_hard_negatives,
        pipeline,
    )
}

LLM_ORACLE = {
    "op2_exact_dedup": exact_stream_dedup.ORACLE,
    "op3_url_filter": url_cascade.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_hard_negatives": kronecker_negatives.ORACLE,
}
