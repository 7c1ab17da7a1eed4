"""Least squares on sparse features, collinear or not.

Dummies of a category next to a column they add up to, a repeated column or
more features than rows leave many equally good weights.  Of these the one of
least norm is found, on standardised features, by conjugate directions on the
normal equations: started at zero, every step stays in the span of the rows.

The features stay sparse as they are: centring and scaling are applied to the
short vectors on either side of a product, never to the rows.  A step needs
the product A'(A p), which is one pass over the rows (per-partition sums, one
row per slot, added by Spark).  Up to ``GRAM_SLOTS`` slots A'A itself is summed
in one pass and steps need no further ones; passes that measure the true
gradient then correct the rounding.  The driver holds vectors of one number
per slot, and directions within ``KEPT_NUMBERS``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.columns import col

GRAM_SLOTS = 512          # A'A of at most 2 MB a task
KEPT_NUMBERS = 1 << 24    # numbers of earlier gradients kept against drift
TOLERANCE = 1e-13         # gradient against the first one
CORRECTIONS = 8           # restarts from the true gradient, at most


@dataclass(frozen=True)
class LinearFit:
    """Weights on standardised features; ``raw_weights`` on the given ones."""
    coefficients: np.ndarray
    intercept: float        # the label's mean, at the features' means
    mean: np.ndarray
    scale: np.ndarray       # population deviation, 1 for a constant slot
    n: int
    passes: int

    @property
    def raw_weights(self) -> np.ndarray:
        return self.coefficients / self.scale

    @property
    def raw_intercept(self) -> float:
        return float(self.intercept - self.mean @ self.raw_weights)


def sparse_rows(df: DataFrame, features: str = "features", label: str | None = None) -> DataFrame:
    """(slots, values[, y]) of an ML vector column; rows without a label are left out."""
    v = F.unwrap_udt(col(features))
    out = [F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1)).alias("slots"),
           v["values"].alias("values")]
    if label is None:
        return df.select(*out)
    y = col(label).cast("double")
    return df.where(y.isNotNull()).select(*out, y.alias("y"))


def _flat(batch):
    """(row of each entry, slot, value, rows) of one Arrow batch."""
    slots, values = batch.column("slots"), batch.column("values")
    lengths = np.diff(slots.offsets.to_numpy())
    row = np.repeat(np.arange(len(slots)), lengths)
    return (row, slots.flatten().to_numpy(zero_copy_only=False),
            values.flatten().to_numpy(zero_copy_only=False), len(slots))


def _sums(rows: DataFrame, kernel, length: int) -> np.ndarray:
    """Sum over all rows of the vectors that ``kernel(batch, total)`` adds up."""
    def run(batches):
        total = np.zeros(length)
        for batch in batches:
            if batch.num_rows:
                kernel(batch, total)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])],
                                         names=["at", "total"])

    parts = rows.mapInArrow(run, "at long, total double")
    got = parts.groupBy("at").agg(F.sum("total").alias("total")).toPandas()
    out = np.zeros(length)
    out[got["at"].to_numpy(dtype=np.int64)] = got["total"].to_numpy()
    return out


def _extremes(rows: DataFrame, size: int):
    """(entries, smallest, largest) of each slot among its stored entries."""
    def run(batches):
        n, lo, hi = np.zeros(size, np.int64), np.full(size, np.inf), np.full(size, -np.inf)
        for batch in batches:
            _, slot, value, _ = _flat(batch)
            n += np.bincount(slot, minlength=size)
            np.minimum.at(lo, slot, value)
            np.maximum.at(hi, slot, value)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(n[at]), pa.array(lo[at]), pa.array(hi[at])],
            names=["at", "n", "lo", "hi"])

    got = rows.mapInArrow(run, "at long, n long, lo double, hi double").groupBy("at").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toPandas()
    n, lo, hi = np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
    at = got["at"].to_numpy(dtype=np.int64)
    n[at], lo[at], hi[at] = got["n"], got["lo"], got["hi"]
    return n, lo, hi


def _moments(rows: DataFrame, size: int):
    """Count, the label's mean, and each slot's mean and population deviation.

    Squares are taken around the means, in a second pass.  A slot whose values
    are all equal has deviation exactly zero."""
    def first(batch, total):
        _, slot, value, n = _flat(batch)
        total[:size] += np.bincount(slot, weights=value, minlength=size)
        total[size] += n
        total[size + 1] += batch.column("y").to_numpy(zero_copy_only=False).sum()

    sums = _sums(rows, first, size + 2)
    n = int(sums[size])
    if n == 0:
        raise ValueError("no row with a label to fit on")
    mean, y_mean = sums[:size] / n, sums[size + 1] / n
    stored, lo, hi = _extremes(rows, size)

    def second(batch, total):
        _, slot, value, _ = _flat(batch)
        total += np.bincount(slot, weights=(value - mean[slot]) ** 2, minlength=size)

    var = (_sums(rows, second, size) + (n - stored) * mean ** 2) / n
    partly = (stored > 0) & (stored < n)  # the slot also holds zeros
    lo, hi = np.where(partly, np.minimum(lo, 0), lo), np.where(partly, np.maximum(hi, 0), hi)
    return n, y_mean, mean, np.where(lo == hi, 0.0, np.sqrt(var))


def _conjugate(product, gradient: np.ndarray, steps: int) -> np.ndarray:
    """Least-norm x of A'A x = ``gradient``; ``product(p)`` is A'A p.

    Gradients are kept orthogonal to the earlier ones kept, which ends the
    search after as many steps as the rows have rank."""
    x, s, p = np.zeros_like(gradient), gradient.copy(), gradient.copy()
    first = gamma = float(s @ s)
    kept, room = [], max(2, KEPT_NUMBERS // max(1, len(s)))
    for _ in range(steps):
        if gamma <= first * TOLERANCE ** 2:
            break
        q = product(p)
        curve = float(p @ q)
        if curve <= 0:
            break
        kept.append(s / np.sqrt(gamma))
        kept = kept[-room:]
        alpha = gamma / curve
        x += alpha * p
        s = s - alpha * q
        for _ in range(2):
            basis = np.array(kept)
            s = s - basis.T @ (basis @ s)
        new = float(s @ s)
        p, gamma = s + (new / gamma) * p, new
    return x


def fit_least_norm(df: DataFrame, size: int, features: str = "features",
                   label: str = "label") -> LinearFit:
    """R1 with an intercept on standardised features: among the weights of
    least squared error, those of least norm.

    ``size`` is the vector's length.  Rows without a label are left out; no row
    at all raises.  A constant slot gets weight zero.  ``df`` is read once per
    pass, so a caller hands in a staged table."""
    rows = sparse_rows(df, features, label)
    n, y_mean, mean, sd = _moments(rows, size)
    passes = 3
    inverse = np.divide(1.0, sd, out=np.zeros(size), where=sd > 0)

    def pass_over(p: np.ndarray, with_label: bool) -> np.ndarray:
        """A'(y - A p) with the label, A'(A p) without."""
        q = p * inverse
        shift = float(mean @ q)

        def kernel(batch, total):
            row, slot, value, m = _flat(batch)
            r = np.bincount(row, weights=value * q[slot], minlength=m) - shift
            if with_label:
                r = batch.column("y").to_numpy(zero_copy_only=False) - y_mean - r
            total[:size] += np.bincount(slot, weights=value * r[row], minlength=size)
            total[size] += r.sum()

        got = _sums(rows, kernel, size + 1)
        return (got[:size] - mean * got[size]) * inverse

    if size <= GRAM_SLOTS:
        upper = np.triu_indices(size)

        def gram(batch, total):
            row, slot, value, m = _flat(batch)
            for lo in range(0, m, 1024):
                a, b = np.searchsorted(row, [lo, lo + 1024])
                dense = np.zeros((min(1024, m - lo), size))
                dense[row[a:b] - lo, slot[a:b]] = value[a:b]
                dense = (dense - mean) * inverse
                total += (dense.T @ dense)[upper]

        half = np.zeros((size, size))
        half[upper] = _sums(rows, gram, len(upper[0]))
        whole = half + half.T - np.diag(np.diag(half))
        passes += 1
        product = whole.__matmul__
    else:
        def product(p):
            nonlocal passes
            passes += 1
            return pass_over(p, False)

    weights, best, least, first = np.zeros(size), np.zeros(size), np.inf, None
    for _ in range(CORRECTIONS):
        gradient = pass_over(weights, True)
        passes += 1
        norm = float(np.linalg.norm(gradient))
        first = norm if first is None else first
        gained = norm <= least / 4
        if norm < least:
            best, least = weights, norm
        if norm <= first * TOLERANCE or not gained:
            break
        weights = weights + _conjugate(product, gradient, min(size, n) + 1)
    return LinearFit(best, float(y_mean), mean, np.where(sd > 0, sd, 1.0), n, passes)


def predict_linear(df: DataFrame, fit: LinearFit, features: str = "features",
                   output: str = "prediction") -> DataFrame:
    """``df`` with the fitted value of its (unscaled) vector column."""
    weights, base = fit.raw_weights, fit.raw_intercept

    @F.pandas_udf("double")
    def value(slots: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([base + float(weights[np.asarray(s, dtype=np.int64)] @ v)
                          for s, v in zip(slots, values)], dtype=float)

    v = F.unwrap_udt(col(features))
    slots = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    return df.withColumn(output, value(slots, v["values"]))
