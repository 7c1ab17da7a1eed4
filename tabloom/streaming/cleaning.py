"""Cleaning on a Structured Streaming source.

The data-dependent decisions of the cleaning plan (which date columns need
the lenient parse, which columns are too sparse) are fitted once on a batch
table (``fit_cleaning``); ``apply_cleaning`` is then a stateless projection
and filter, so it runs unchanged on ``readStream``.  Output goes to a
parquet sink with its checkpoint in the shared checkpoint folder, so a
restarted query resumes exactly once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tabloom.plans.cleaning import CleaningPlan, apply_cleaning
from tabloom.session import scratch_path


def clean_stream(spark: SparkSession, source_dir: str, schema, plan: CleaningPlan,
                 sink_dir: str | None = None, available_now: bool = True,
                 max_files_per_trigger: int = 64) -> tuple[StreamingQuery, str]:
    """Start the stream: parquet files in ``source_dir`` -> cleaned parquet."""
    sink_dir = sink_dir or scratch_path(spark, "clean-stream-out")
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))
    cleaned = apply_cleaning(stream, plan)
    writer = (cleaned.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", os.path.join(sink_dir, "_checkpoint"))
              .option("path", os.path.join(sink_dir, "data")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start(), os.path.join(sink_dir, "data")


def run_to_completion(spark: SparkSession, source_dir: str, schema, plan: CleaningPlan
                      ) -> DataFrame:
    """Process every file present now, then read the sink back."""
    query, data = clean_stream(spark, source_dir, schema, plan, available_now=True)
    while query.isActive:          # short waits, not one long blocking call
        query.awaitTermination(1)
    if query.exception() is not None:
        raise query.exception()
    return spark.read.parquet(data)
