"""Standard scaling (Z1) with the population deviation.

``pyspark.ml.feature.StandardScaler`` divides by the sample deviation; the
reference's scaler divides by the population deviation and leaves a
zero-variance column at deviation 1.  Fit is one aggregate job for all
columns; transform is a projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.columns import col


def fit_scaler(df: DataFrame, cols: list[str], weight: str | None = None) -> dict[str, tuple]:
    """{column: (mean, population std)}; ``weight`` counts a row w times."""
    exprs = []
    for i, c in enumerate(cols):
        x = col(c).cast("double")
        if weight is None:
            exprs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        else:
            w = col(weight).cast("double")
            exprs.append((F.sum(w * x) / F.sum(w)).alias(f"m{i}"))
    row = df.agg(*exprs).first()
    central = None
    if weight is not None:
        # squares around the mean: a constant column has variance zero exactly
        w = col(weight).cast("double")
        central = df.agg(*[
            (F.sum(w * (col(c).cast("double") - F.lit(row[f"m{i}"])) ** 2) / F.sum(w)).alias(f"q{i}")
            for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        m = row[f"m{i}"]
        if weight is None:
            s = row[f"s{i}"]
        else:
            var = central[f"q{i}"] if m is not None else None
            s = var ** 0.5 if var is not None else None
        out[c] = (m, 1.0 if not s else s)
    return out


def apply_scaler(df: DataFrame, stats: dict[str, tuple], suffix: str = "") -> DataFrame:
    return df.withColumns({c + suffix: (col(c).cast("double") - F.lit(m)) / F.lit(s)
                           for c, (m, s) in stats.items()})


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fit on ``df`` and scale ``cols`` in place."""
    return apply_scaler(df, fit_scaler(df, cols))
