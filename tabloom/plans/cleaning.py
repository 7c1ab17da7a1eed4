"""Cleaning plan for the accident table (query lifecycle A).

drop text columns -> parse date-like columns (strict, or lenient when more
than 5 % fail) -> drop columns more than 40 % missing -> drop rows with any
missing value -> time features -> imperial to metric.

The two data-dependent decisions (strict or lenient per date column; which
columns are sparse) are taken from ONE aggregate pass: for every column it
measures the raw missing share, and for date-like columns the missing share
under both parses.  The result is then a single lazy projection + filter,
so at scale the input is read twice (metadata, then output), not once per
step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.dates import (LENIENT_AFTER_SHARE, STRICT_FORMAT, add_time_features,
                                     datetime_like_columns, format_mask, is_datetime,
                                     lenient_parse, mask_fails, strict_parse, vote_aggregates,
                                     votes_day_first)
from tabloom.functions.units import convert_imperial_to_metric
from tabloom.operators.columns import col, drop_tolerant, missing_flag
from tabloom.operators.rows import drop_rows_any_missing

# Fixed values of the reference: text/id columns dropped first, and the
# missing share above which a column is dropped.
TEXT_DROP_CANDIDATES = ("ID", "Description", "Street", "Weather_Timestamp", "Source")
DROP_MISSING_COL_THRESHOLD = 0.40


def plan_cleaning(df: DataFrame, threshold: float = DROP_MISSING_COL_THRESHOLD,
                  share: float = LENIENT_AFTER_SHARE, fmt: str = STRICT_FORMAT):
    """One aggregate job -> ({date column: "strict" | "lenient" | "day_first"}, dropped
    columns)."""
    dates = [c for c in datetime_like_columns(df) if not is_datetime(df, c)]
    # one projection parses each value once: the formats a text fits also tell
    # whether either lenient parse fails
    flags = []
    for i, c in enumerate(df.columns):
        if c in dates:
            flags += [strict_parse(col(c), fmt).isNull().alias(f"s{i}"),
                      format_mask(col(c)).alias(f"v{i}")]
        else:
            flags.append(missing_flag(df, c).alias(f"m{i}"))
    exprs = []
    for i, c in enumerate(df.columns):
        if c in dates:
            mask = F.col(f"v{i}")
            missing = {f"s{i}": F.col(f"s{i}"),
                       **{f"l{i}_{d}": mask_fails(mask, bool(d)) for d in (0, 1)}}
            exprs += vote_aggregates(col(c), f"v{i}", mask)
        else:
            missing = {f"m{i}": F.col(f"m{i}")}
        exprs += [F.avg(m.cast("double")).alias(name) for name, m in missing.items()]
    row = df.select(*flags).agg(*exprs).first()
    chosen, dropped = {}, []
    for i, c in enumerate(df.columns):
        if c in dates:
            strict_share = row[f"s{i}"]
            lenient = strict_share is not None and strict_share > share
            day = lenient and votes_day_first(row, f"v{i}")
            chosen[c] = "day_first" if day else "lenient" if lenient else "strict"
            miss = row[f"l{i}_{int(day)}"] if lenient else strict_share
        else:
            miss = row[f"m{i}"]
        if miss is not None and miss > threshold:
            dropped.append(c)
    return chosen, dropped


@dataclass(frozen=True)
class CleaningPlan:
    """What the data decided: parse mode per date-like text column, and the
    sparse columns to drop.  Small, serialisable, reusable on new data
    (e.g. a stream) without touching old data again."""
    parse: dict            # column -> "strict" | "lenient" | "day_first"
    dropped: tuple
    text_columns: tuple = TEXT_DROP_CANDIDATES
    fmt: str = STRICT_FORMAT


def fit_cleaning(df: DataFrame, threshold: float = DROP_MISSING_COL_THRESHOLD,
                 text_columns=TEXT_DROP_CANDIDATES) -> CleaningPlan:
    """One aggregate job over ``df``."""
    base = drop_tolerant(df, list(text_columns))
    modes, dropped = plan_cleaning(base, threshold)
    return CleaningPlan(parse=modes, dropped=tuple(dropped), text_columns=tuple(text_columns))


def apply_cleaning(df: DataFrame, plan: CleaningPlan) -> DataFrame:
    """Projection + filter only (no job): works on batch and streaming frames."""
    df = drop_tolerant(df, list(plan.text_columns))
    exprs = {c: (strict_parse(col(c), plan.fmt) if mode == "strict" else
                 lenient_parse(col(c), mode == "day_first"))
             for c, mode in plan.parse.items() if c in df.columns}
    df = df.withColumns(exprs).drop(*plan.dropped)
    df = drop_rows_any_missing(df)
    df = add_time_features(df)
    return convert_imperial_to_metric(df)


def clean_accidents(df: DataFrame, threshold: float = DROP_MISSING_COL_THRESHOLD,
                    text_columns=TEXT_DROP_CANDIDATES) -> DataFrame:
    """The flagship: fit the plan (one aggregate), then one projection."""
    return apply_cleaning(df, fit_cleaning(df, threshold, text_columns))


def clean_accidents_report(df: DataFrame, threshold: float = DROP_MISSING_COL_THRESHOLD,
                           text_columns=TEXT_DROP_CANDIDATES) -> dict:
    """The decisions the cleaning took, for logging/tests."""
    df = drop_tolerant(df, list(text_columns))
    modes, dropped = plan_cleaning(df, threshold)
    return {"parse": modes, "dropped": dropped}
