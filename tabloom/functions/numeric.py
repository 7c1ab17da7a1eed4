"""Small scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def absolute(c):  # M9
    return F.abs(_c(c))


def square_root(c):  # M10
    return F.sqrt(_c(c))


def jitter(c, sd: float = 1.0, seed: int = 42, key=None) -> Column:
    """Add N(0, sd) noise, the same on every rerun and partitioning.

    The normal value is Box-Muller of two 32-bit parts of md5(seed, key);
    ``key`` names the row's key columns (without it the value is the key, so
    equal values get equal noise).
    """
    parts = [_c(k).cast("string") for k in ([c] if key is None else key)]
    h = F.md5(F.concat_ws(":", F.lit(str(int(seed))), *parts))
    u, v = (F.conv(F.substring(h, i, 8), 16, 10).cast("double") for i in (1, 9))
    radius = F.sqrt(F.lit(-2.0) * F.log((u + 1.0) / F.lit(4294967297.0)))
    return _c(c) + radius * F.cos(F.lit(2.0) * F.pi() * v / F.lit(4294967296.0)) * sd


# Fixed values of the reference: R² band limits for the fit verdict.
WEAK_BELOW = 0.1
SOME_BELOW = 0.5
VERDICTS = ("little predictive power", "captures some trends, much noise",
            "finds solid patterns")


def band(c, limits=(WEAK_BELOW, SOME_BELOW), labels=VERDICTS) -> Column:
    """The first label whose upper limit the value is under."""
    c = _c(c)
    expr = F.when(c < limits[0], F.lit(labels[0]))
    for lim, lab in zip(limits[1:], labels[1:-1]):
        expr = expr.when(c < lim, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def clean_name(name: str) -> str:
    """S3/M13 on a column name: drop ';' then strip spaces."""
    return name.replace(";", "").strip()


def strip_text(c):  # M13
    return F.trim(_c(c))


def lower_text(c):  # M13
    return F.lower(_c(c))


def replace_text(c, old: str, new: str):  # M13
    return F.replace(_c(c), F.lit(old), F.lit(new))


def starts_with(c, prefix: str):  # M13
    return F.startswith(_c(c), F.lit(prefix))
