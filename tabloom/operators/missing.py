"""Missing-value operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.columns import col, string_columns
from tabloom.operators.quantiles import exact_median

# Fixed value of the reference: the text that stands for a missing category.
SENTINEL = "UNKNOWN"


def sentinel_to_null(df: DataFrame, sentinel: str = SENTINEL,
                     cols: list[str] | None = None) -> DataFrame:
    """A string cell equal to ``sentinel`` (whole value, no trim)
    becomes missing; other columns are untouched.  One projection."""
    cols = string_columns(df) if cols is None else cols
    return df.withColumns({c: F.when(col(c) != F.lit(sentinel), col(c)) for c in cols})


def fit_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact median of each column (NumPy rule: mean of the two middle
    values for an even count), distributed; see ``quantiles``."""
    return exact_median(df, cols)


def fill_values(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """Replace NULL and NaN by the given value per column.  Columns whose
    value is None (no value seen at fit time) are dropped, as the
    reference's imputer does."""
    dead = [c for c, v in values.items() if v is None]
    exprs = {}
    for c, v in values.items():
        if v is None:
            continue
        x = col(c)
        exprs[c] = F.when(x.isNull() | F.isnan(x.cast("double")), F.lit(float(v))).otherwise(
            x.cast("double"))
    return df.withColumns(exprs).drop(*dead)


def median_impute(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fit exact medians on ``df`` and fill ``cols``."""
    return fill_values(df, fit_medians(df, cols))
