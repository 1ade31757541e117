"""Corpus pipeline: the stages that turn ``documents`` into training tokens.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and
reread as the next stage's ``docs``.  All stages but the last keep the columns
of the documents, extra ones included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from estatelens.llm import common, decontaminate, mixing, quality, simhash, tokenfiles


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule rejects, or that hold little besides boilerplate lines, go; such lines leave the others."""
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly such passages go."""
    return decontaminate.remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as its source's share takes it."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and from them each document's place, length and checksum."""
    return tokenfiles.encoded(docs)


STAGES: list[tuple[str, Callable]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", source_mix),
    ("token_output", token_output),
]

#: Fingerprints, random transfers and token files are not SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
