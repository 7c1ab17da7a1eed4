"""Numeric coercion and imperial -> metric conversion (M1-M8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def clip_lower(c: Column | str, lower: float = 0.0) -> Column:
    """M1: values below ``lower`` become ``lower``; missing stays missing
    (``greatest`` would skip NULL, so it is not used)."""
    c = _c(c)
    return F.when(c < lower, F.lit(lower)).otherwise(c)


def to_number(c: Column | str) -> Column:
    """M2: lenient numeric cast; text that is not a number becomes missing."""
    return _c(c).try_cast("double")


def fahrenheit_to_celsius(c: Column | str) -> Column:
    """M3, in the reference's order of operations: (x - 32) * 5.0 / 9.0."""
    return (_c(c) - 32.0) * 5.0 / 9.0


# Fixed values of the reference: conversion factors.
MILE_KM = 1.609344
MPH_MS = 0.44704
INCH_MM = 25.4
INHG_HPA = 33.8638866667


def miles_to_km(c):  # M4
    return _c(c) * MILE_KM


def mph_to_ms(c):  # M5
    return _c(c) * MPH_MS


def inch_to_mm(c):  # M6
    return _c(c) * INCH_MM


def inhg_to_hpa(c):  # M7
    return _c(c) * INHG_HPA


# Fixed values of the reference: which column becomes which, in this order.
IMPERIAL_TO_METRIC = (
    ("Temperature(F)", "Temperature(C)", fahrenheit_to_celsius),
    ("Wind_Chill(F)", "Wind_Chill(C)", fahrenheit_to_celsius),
    ("Distance(mi)", "Distance(km)", miles_to_km),
    ("Wind_Speed(mph)", "Wind_Speed(m/s)", mph_to_ms),
    ("Visibility(mi)", "Visibility(km)", miles_to_km),
    ("Precipitation(in)", "Precipitation(mm)", inch_to_mm),
    ("Pressure(in)", "Pressure(hPa)", inhg_to_hpa),
)


def convert_imperial_to_metric(df: DataFrame, table=IMPERIAL_TO_METRIC) -> DataFrame:
    """M8: for each source column present, coerce to a number, convert, put
    the new column last and drop the source.  One projection."""
    present = [(src, dst, fn) for src, dst, fn in table if src in df.columns]
    if not present:
        return df
    sources = {src for src, _, _ in present}
    keep = [F.col(f"`{c}`") for c in df.columns if c not in sources]
    new = [fn(to_number(F.col(f"`{src}`"))).alias(dst) for src, dst, fn in present]
    return df.select(*keep, *new)
