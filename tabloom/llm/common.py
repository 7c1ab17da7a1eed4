"""Helpers shared by the corpus operators.

Every operator takes the columns it needs by name and drops the rest at the
scan, so extra columns, whatever their names, cannot clash with its own.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import dropping_shuffles, scratch_path

# The contracts' word pattern and their only case folding.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD_PATTERN_SQL = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 256  # whole texts that a Python worker holds at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z only.  Pure-ASCII values take the fast ``lower``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER))


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it again.

    Cuts lineage and survives lost executors; the caller's later passes
    scan the small table instead of recomputing it.  The shuffle files of
    the query that wrote it are dropped.
    """
    path = scratch_path(df.sparkSession, name)
    with dropping_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Even the partitions of a table that feeds heavy per-row work.

    A table of fewer splits than the session has cores would leave cores
    idle; one of more splits is left as it is.  Where the session leaves the
    size of Arrow batches open, it becomes BATCH_ROWS, as texts can be long.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, BATCH_ROWS)
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if len(df.inputFiles()) < want and \
        df.rdd.getNumPartitions() < want else df


def nest(df: DataFrame, **more: Column) -> DataFrame:
    """One struct column ``row`` of all columns, and ``more`` computed from
    them: no name of the table can clash with an operator's own."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"),
                     *[c.alias(n) for n, c in more.items()])


def unnest(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def basename(path: str) -> str:
    return os.path.basename(path.rstrip("/"))
