"""Row filters, ordered limits, shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.columns import col, missing_flag


def present_rows(df: DataFrame, name: str) -> DataFrame:  # F1
    return df.filter(~missing_flag(df, name))


def missing_rows(df: DataFrame, name: str) -> DataFrame:  # F1
    return df.filter(missing_flag(df, name))


def any_missing(df: DataFrame, cols: list[str] | None = None) -> Column:
    cols = df.columns if cols is None else cols
    flags = [missing_flag(df, c) for c in cols]
    out = F.lit(False)
    for f in flags:
        out = out | f
    return out


def drop_rows_any_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """keep rows with no NULL (nor NaN) in ``cols`` (default: all).

    ``na.drop`` plans one compact ``AtLeastNNonNulls`` test (NaN counts as
    missing), which keeps wide rows inside whole-stage code generation."""
    return df.na.drop(how="any", subset=cols if cols is not None else df.columns)


def row_loss_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A10: rows before, after and dropped by F2, from one pass over the
    unfiltered frame."""
    miss = any_missing(df, cols)
    return df.agg(F.count(F.lit(1)).alias("rows_before"),
                  F.count_if(~miss).alias("rows_after"),
                  F.count_if(miss).alias("rows_dropped"))


def open_range(df: DataFrame, c: Column | str, low: float, high: float) -> DataFrame:
    """low < c < high, both ends excluded."""
    c = col(c) if isinstance(c, str) else c
    return df.filter((c > low) & (c < high))


def trim_equals(c: Column | str, value: str) -> Column:
    """whole-value equality after stripping spaces."""
    c = col(c) if isinstance(c, str) else c
    return F.trim(c) == F.lit(value)


def head(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """First ``n`` rows in an explicit order (planned as a top-k)."""
    return df.orderBy(*order_by).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """One row (rows, cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("long"))


def sort_by_magnitude(df: DataFrame, value: str, out: str = "importance",
                      tie: list[str] | None = None) -> DataFrame:
    """Add |value| and sort by it, largest first, ties by ``tie``."""
    tie = tie or []
    return (df.withColumn(out, F.abs(col(value)))
              .orderBy(F.desc(out), *[col(t) for t in tie]))


def top_k(df: DataFrame, k: int, by: str, tie: list[str] | None = None) -> DataFrame:
    """The ``k`` largest by ``by``; a bounded top-k (TakeOrderedAndProject)."""
    return df.orderBy(F.desc(col(by)), *[col(t) for t in (tie or [])]).limit(k)


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame from driver-side metadata (coefficients, parameters)."""
    return spark.createDataFrame(rows, schema)
