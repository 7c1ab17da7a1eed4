"""Projections and column management.

Every operator is one lazy projection except ``drop_sparse_columns``, which
needs one aggregate job to learn which columns to drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """Column by exact name (names may hold '(', '%', '/', '.')."""
    return F.col("`" + name.replace("`", "``") + "`")


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:  # P1
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*[col(c) for c in cols])


def drop_strict(df: DataFrame, cols: list[str] | str) -> DataFrame:
    """Like pandas ``drop(columns=...)``: an absent name is an error."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def drop_tolerant(df: DataFrame, cols: list[str]) -> DataFrame:
    """Absent names are ignored."""
    return df.drop(*[c for c in cols if c in df.columns])


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def drop_prefix(df: DataFrame, prefix: str) -> DataFrame:  # P4
    return df.drop(*columns_with_prefix(df, prefix))


def missing_flag(df: DataFrame, name: str) -> Column:
    """NULL, and NaN for floating columns (pandas counts both as missing)."""
    c = col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def missing_shares(df: DataFrame, cols: list[str] | None = None) -> dict[str, float]:
    """Missing share of every column in one aggregate job."""
    cols = df.columns if cols is None else cols
    row = df.agg(*[F.avg(missing_flag(df, c).cast("double")).alias(f"s{i}")
                   for i, c in enumerate(cols)]).first()
    return {c: row[f"s{i}"] for i, c in enumerate(cols)}


def drop_sparse_columns(df: DataFrame, threshold: float = 0.40):
    """P5: drop columns whose missing share is strictly above ``threshold``.

    Returns ``(frame, dropped)``.  On an empty frame nothing is dropped.
    """
    shares = missing_shares(df)
    dropped = [c for c, s in shares.items() if s is not None and s > threshold]
    return df.drop(*dropped), dropped


def string_columns(df: DataFrame) -> list[str]:  # P6
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def select_strings(df: DataFrame) -> DataFrame:
    return df.select(*[col(c) for c in string_columns(df)])


def derive(df: DataFrame, **exprs: Column) -> DataFrame:  # P8
    return df.withColumns(exprs)


def cast_columns(df: DataFrame, cols: list[str], to: str = "int",
                 strict: bool = True) -> DataFrame:
    """Cast a list of columns.  Double -> int truncates toward zero.

    ``strict`` mirrors ``astype(int)``, which fails on missing values: one
    aggregate job checks that no listed column holds NULL/NaN.
    """
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    if strict and cols:
        row = df.agg(*[F.count_if(missing_flag(df, c)).alias(f"n{i}")
                       for i, c in enumerate(cols)]).first()
        bad = [c for i, c in enumerate(cols) if row[f"n{i}"]]
        if bad:
            raise ValueError(f"cannot cast missing values to {to}: {bad}")
    return df.withColumns({c: col(c).cast(to) for c in cols})


def hconcat(df: DataFrame, *parts: list[Column]) -> DataFrame:
    """P10: side-by-side concat of column groups computed from one frame.

    In Spark the groups come from the same rows, so this is one ``select``,
    never a join on position.
    """
    exprs = [c for part in parts for c in part]
    return df.select(*exprs)


def align_columns(df: DataFrame, cols: list[str], fill=0) -> DataFrame:
    """Exactly ``cols`` in that order; absent ones are ``fill``."""
    return df.select(*[col(c) if c in df.columns else F.lit(fill).alias(c) for c in cols])


# Fixed values of the reference: columns known after the fact (leakage),
# and the two that must be gone afterwards.
LEAKAGE_COLUMNS = ("Distance(mi)", "Severity", "End_Lat", "End_Lng")
LEAKAGE_PREFIX = "End_"
LEAKAGE_CHECK = ("Distance(mi)", "Severity")


def leakage_guard(df: DataFrame, target: str, prefix: str = LEAKAGE_PREFIX,
                  strict_cols=LEAKAGE_COLUMNS, check=LEAKAGE_CHECK,
                  raise_on_leak: bool = True):
    """Drop the target, every ``prefix*`` column and the strict list
    (absent names ignored); then verify ``check`` columns are gone.

    Returns ``(features, dropped, ok)``.
    """
    drop = [target] + columns_with_prefix(df, prefix) + list(strict_cols)
    out = drop_tolerant(df, drop)
    leaked = [c for c in check if c in out.columns]
    if leaked and raise_on_leak:
        raise ValueError(f"leakage columns still present: {leaked}")
    dropped = [c for c in dict.fromkeys(drop) if c in df.columns]
    return out, dropped, not leaked
