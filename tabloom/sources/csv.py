"""CSV source and sink with pandas-like reading rules.

* every column is read as text, so no value is lost to an early guess;
* S1b: pandas' default missing-value tokens become NULL (whole value);
* S3: column names lose ';' and surrounding spaces;
* types are inferred in ONE aggregate pass over all columns (a column is
  ``bigint`` when every present value parses as an integer, ``double`` when
  every one parses as a number, ``boolean`` for True/False text, else
  text); dates stay text, as in pandas, and are parsed later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.numeric import clean_name
from tabloom.operators.columns import col
from tabloom.session import scratch_path

# Fixed values (pandas' default ``na_values``).
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                  "nan", "null")
TRUE_TEXT = ("True", "TRUE", "true")
FALSE_TEXT = ("False", "FALSE", "false")


def read_csv_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Header row, comma, '"' quotes doubled inside quotes; all text."""
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("quote", '"').option("escape", '"').option("multiLine", multiline)
            .csv(path))


def normalise_missing(df: DataFrame, tokens=MISSING_TOKENS) -> DataFrame:
    """A cell equal to a token (no trim) becomes NULL."""
    toks = [F.lit(t) for t in tokens]
    return df.withColumns({c: F.when(~col(c).isin(*toks), col(c)) for c in df.columns})


def clean_column_names(df: DataFrame) -> DataFrame:
    """S3."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def infer_types(df: DataFrame) -> dict[str, str]:
    """One aggregate over all text columns -> Spark type name per column."""
    exprs = []
    for i, c in enumerate(df.columns):
        x = col(c)
        exprs += [
            F.count(x).alias(f"n{i}"),
            F.count(x.try_cast("bigint")).alias(f"l{i}"),
            F.count(x.try_cast("double")).alias(f"d{i}"),
            F.count_if(x.isin(*TRUE_TEXT, *FALSE_TEXT)).alias(f"b{i}"),
        ]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *exprs).first()
    out = {}
    for i, c in enumerate(df.columns):
        n = row[f"n{i}"]
        if n and row[f"b{i}"] == n:
            out[c] = "boolean"
        elif n and row[f"l{i}"] == n:
            # pandas makes an integer column with a missing value float64
            out[c] = "bigint" if n == row["rows"] else "double"
        elif n and row[f"d{i}"] == n:
            out[c] = "double"
        else:
            out[c] = "string"
    return out


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    exprs = {}
    for c, t in types.items():
        if c not in df.columns:
            continue
        if t == "boolean":
            exprs[c] = (F.when(col(c).isin(*TRUE_TEXT), F.lit(True))
                        .when(col(c).isin(*FALSE_TEXT), F.lit(False)))
        elif t != "string":
            exprs[c] = col(c).try_cast(t)
    return df.withColumns(exprs)


def read_csv(spark: SparkSession, path: str, clean_names: bool = True,
             infer: bool = False, multiline: bool = False) -> DataFrame:
    """Read a CSV the way the reference's ``read_csv`` sees it."""
    df = read_csv_text(spark, path, multiline)
    if clean_names:
        df = clean_column_names(df)
    df = normalise_missing(df)
    if infer:
        df = cast_columns(df, infer_types(df))
    return df


def write_csv(df: DataFrame, path: str | None = None, name: str = "table") -> str:
    """Header row, no index; written in parallel as part files.

    Without ``path`` the table goes below the shared checkpoint folder.
    """
    path = path or scratch_path(df.sparkSession, f"csv-{name}")
    (df.write.mode("overwrite").option("header", True).option("quote", '"')
       .option("escape", '"').csv(path))
    return path


def write_parquet(df: DataFrame, path: str | None = None, name: str = "table") -> str:
    path = path or scratch_path(df.sparkSession, f"parquet-{name}")
    df.write.mode("overwrite").parquet(path)
    return path
