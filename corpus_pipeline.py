"""Corpus pipeline over ``documents``: language ID, exact dedup, near-dedup,
benchmark decontamination, SentencePiece sampling.

Each stage gets the rows that its predecessor kept, written as Parquet and
read again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import bench_decontam, exact_stream_dedup, hamming_dedup, mixture_langid, sp_sampling
from tallyspark.llm.common import Stages


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language (``und``) go."""
    return mixture_langid.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_stream_dedup.keep_latest(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (similarity 0.85, five words) the smallest doc_id stays."""
    return hamming_dedup.keep_representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return bench_decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document that is left."""
    return sp_sampling.sample_segmentations(docs)


STAGES = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontaminate),
    ("sentencepiece", segment),
]

# EM, MinHash, edit matching and sampling are not SQL; tests/llm holds the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stages = spark.read.parquet(f"{sf_dir}/documents.parquet"), Stages(spark, "pipeline")
    for name, stage in STAGES:
        docs = stages.write(stage(spark, docs, sf_dir), name)
    return docs
