"""Whole-table profiles.

Each profile is one aggregate over all columns (map-side partial
aggregation, one small result) and an ``unpivot`` to one row per column.
Per-value counts use a single shuffle for all string columns together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.columns import col, missing_flag, string_columns
from tabloom.operators.quantiles import exact_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _long(df: DataFrame, row_df: DataFrame, cols: list[str], value: str) -> DataFrame:
    keys = [f"c{i}" for i in range(len(cols))]
    wide = row_df
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(k).alias(value)) for c, k in zip(cols, keys)
    ])).alias("s")).select("s.column_name", f"s.{value}")
    return stacked


def missing_share(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A1: (column, missing_share)."""
    cols = df.columns if cols is None else cols
    agg = df.agg(*[F.avg(missing_flag(df, c).cast("double")).alias(f"c{i}")
                   for i, c in enumerate(cols)])
    return _long(df, agg, cols, "missing_share")


def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A2: (column, missing_count), largest first."""
    cols = df.columns if cols is None else cols
    agg = df.agg(*[F.count_if(missing_flag(df, c)).alias(f"c{i}") for i, c in enumerate(cols)])
    return _long(df, agg, cols, "missing_count").orderBy(F.desc("missing_count"), "column_name")


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """A3: (value, count) of present values, most frequent first."""
    return (df.filter(col(name).isNotNull()).groupBy(col(name).alias("value"))
              .agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), "value"))


def sentinel_counts(df: DataFrame, sentinel: str = "UNKNOWN",
                    cols: list[str] | None = None) -> DataFrame:
    """A4: per string column, cells equal to ``sentinel`` after trimming."""
    cols = string_columns(df) if cols is None else cols
    agg = df.agg(*[F.count_if(F.trim(col(c)) == F.lit(sentinel)).alias(f"c{i}")
                   for i, c in enumerate(cols)])
    return _long(df, agg, cols, "n_sentinel")


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A5: count, mean, sample std, min, exact quartiles, max per column."""
    cols = numeric_columns(df) if cols is None else cols
    spark = df.sparkSession
    stats = []
    for i, c in enumerate(cols):
        x = col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        stats += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                  F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                  F.max(x).alias(f"hi{i}")]
    row = df.agg(*stats).first()
    quart = exact_quantiles(df, cols, (0.25, 0.5, 0.75))
    rows = [(c, row[f"n{i}"], row[f"m{i}"], row[f"s{i}"], row[f"lo{i}"],
             *quart[c], row[f"hi{i}"]) for i, c in enumerate(cols)]
    return spark.createDataFrame(
        rows, "column_name string, count long, mean double, std double, min double, "
              "q25 double, q50 double, q75 double, max double")


def describe_strings(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, unique, top, freq per string column.

    All columns go through one shuffle: unpivot to (column, value), count
    per pair (partial aggregation absorbs hot values), then per column the
    most frequent value (ties: smallest value).
    """
    cols = string_columns(df) if cols is None else cols
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), col(c).alias("value")) for c in cols
    ])).alias("p")).select("p.column_name", "p.value").filter(F.col("value").isNotNull())
    per_value = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"))


def column_info(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null) in schema order."""
    cols = df.columns
    agg = df.agg(*[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = _long(df, agg, cols, "non_null")
    mapping = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return out.select("column_name", mapping[F.col("column_name")].alias("dtype"), "non_null")


def distinct_labels(df: DataFrame, label: str = "prediction",
                    noise=None) -> DataFrame:
    """Number of distinct labels, ``noise`` (e.g. -1) excluded."""
    c = col(label)
    if noise is not None:
        c = F.when(c != F.lit(noise), c)
    return df.agg(F.count_distinct(c).alias("n_labels"))


def min_max(df: DataFrame, name: str) -> DataFrame:
    """A9."""
    return df.agg(F.min(col(name)).alias("min_value"), F.max(col(name)).alias("max_value"))
