"""Corpus pipeline: quality filter, exact dedup, near-dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm import exact_dedup, mixing, near_dedup, packing, quality
from tabloom.llm.common import stage_table, table
from tabloom.llm.queries import tokenizer_path
from tabloom.session import ship_package


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """9: documents whose perplexity passes their language's threshold."""
    ship_package(spark)
    return quality.keep_documents(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """2: one document of each group of equal texts."""
    ship_package(spark)
    return exact_dedup.dedup_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """10: one document of each component of near copies, at 0.8."""
    ship_package(spark)
    return near_dedup.dedup_documents(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """5: every document as often as its source's target takes it."""
    ship_package(spark)
    return mixing.mix_documents(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """6: the place of every piece in sequences of 4096 ids."""
    ship_package(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality", keep_quality), ("exact_dedup", drop_copies),
          ("near_dedup", drop_near_copies), ("mixing", mix_sources), ("packing", pack_tokens)]

# Perplexities of a smoothed n-gram model, and best-fit packing, have no SQL;
# tests/llm compares the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
