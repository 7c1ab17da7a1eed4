"""Gaussian mixture with diagonal covariance (C2), EM as Spark jobs.

Spark's ``GaussianMixture`` has no covariance type and no regulariser.  Here
one EM round is one job over the rows:

* every Arrow batch computes, with NumPy, log pi_j + log N(x | mu_j,
  diag var_j) for all components, the log-sum-exp and the
  responsibilities, and folds them into the M-step sufficient statistics
  (sum w r_j, sum w r_j x, sum w r_j x^2, weighted log-likelihood) -- one
  fixed-size vector per partition (``mapInPandas``);
* Spark sums those vectors (``posexplode`` + grouped sum), so the driver
  sees k(1 + 2d) + 2 numbers per round, whatever the row count.

(As pure column expressions the E-step needs k*d terms per row and ~k(1+2d)
aggregates, which overflows whole-stage code generation and runs
interpreted; the batch kernel is an order of magnitude faster.)

Start: hard labels from k-means (one run, as the reference's default
``init_params='kmeans'``), tolerance 1e-3 on the mean log-likelihood, at
most 100 rounds, ``reg`` added to every variance.  Labels are the argmax
responsibility of the returned parameters.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.columns import col

_EPS10 = 10 * np.finfo(np.float64).eps
_LOG_2PI = math.log(2 * math.pi)


@dataclass
class DiagonalMixture:
    weights: np.ndarray   # (k,)
    means: np.ndarray     # (k, d)
    variances: np.ndarray  # (k, d)
    log_likelihood: float = float("nan")  # total (weighted) over the fitted rows
    n: float = 0.0
    n_iter: int = 0
    converged: bool = False

    @property
    def k(self) -> int:
        return len(self.weights)


def _w(weight):
    return F.lit(1.0) if weight is None else col(weight).cast("double")


def _log_weighted(x: np.ndarray, m: DiagonalMixture) -> np.ndarray:
    """(n, k): log pi_j + log N(x | mu_j, diag var_j)."""
    inv = 1.0 / m.variances                                   # (k, d)
    quad = (x * x) @ inv.T - 2.0 * x @ (m.means * inv).T + (m.means ** 2 * inv).sum(1)
    const = np.log(m.weights) - 0.5 * (x.shape[1] * _LOG_2PI + np.log(m.variances).sum(1))
    return const[None, :] - 0.5 * quad


def _partials(df: DataFrame, features: list[str], m: DiagonalMixture,
              weight: str | None = None) -> DataFrame:
    k, d = m.k, len(features)
    w = _w(weight)
    pts = df.select(*[col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
                    w.alias("w"))
    xs = [f"x{i}" for i in range(d)]

    def kernel(it):
        acc = np.zeros(k * (1 + 2 * d) + 2)
        for pdf in it:
            if pdf.empty:
                continue
            x = pdf[xs].to_numpy(dtype=np.float64)
            wt = pdf["w"].to_numpy(dtype=np.float64)
            lw = _log_weighted(x, m)
            mx = lw.max(axis=1, keepdims=True)
            lse = (mx + np.log(np.exp(lw - mx).sum(axis=1, keepdims=True)))[:, 0]
            r = np.exp(lw - lse[:, None]) * wt[:, None]            # (n, k) weighted
            acc[:k] += r.sum(axis=0)
            acc[k:k + k * d] += (r.T @ x).ravel()
            acc[k + k * d:k + 2 * k * d] += (r.T @ (x * x)).ravel()
            acc[-2] += float(wt @ lse)
            acc[-1] += float(wt.sum())
        yield pd.DataFrame({"v": [acc.tolist()]})

    parts = pts.mapInPandas(kernel, "v array<double>")
    return (parts.select(F.posexplode("v").alias("i", "x"))
            .groupBy("i").agg(F.sum("x").alias("x")))


def sufficient_stats(df: DataFrame, features: list[str], m: DiagonalMixture,
                     weight: str | None = None):
    """One job: (N_j, S_j, Q_j, total log-likelihood, total weight)."""
    k, d = m.k, len(features)
    vals = np.zeros(k * (1 + 2 * d) + 2)
    for i, x in _partials(df, features, m, weight).collect():
        vals[i] = x
    N = vals[:k]
    S = vals[k:k + k * d].reshape(k, d)
    Q = vals[k + k * d:k + 2 * k * d].reshape(k, d)
    return N, S, Q, float(vals[-2]), float(vals[-1])


COVARIANCE_TYPES = ("diag", "spherical")


def m_step(N, S, Q, n, reg, covariance: str = "diag") -> DiagonalMixture:
    """``diag``: one variance per component and dimension; ``spherical``:
    their mean over dimensions, one variance per component."""
    if covariance not in COVARIANCE_TYPES:
        raise NotImplementedError(f"covariance type {covariance!r}")
    nk = N + _EPS10
    means = S / nk[:, None]
    var = Q / nk[:, None] - means ** 2 + reg
    var = np.maximum(var, reg)
    if covariance == "spherical":
        var = np.repeat(var.mean(axis=1, keepdims=True), var.shape[1], axis=1)
    return DiagonalMixture(weights=nk / n, means=means, variances=var)


def init_from_labels(df: DataFrame, features: list[str], label: str, k: int,
                     reg: float, weight: str | None = None,
                     covariance: str = "diag") -> DiagonalMixture:
    """M-step from hard labels 0..k-1 (one grouped aggregate)."""
    w = _w(weight)
    aggs = [F.sum(w).alias("N")]
    for i, f in enumerate(features):
        x = col(f).cast("double")
        aggs += [F.sum(w * x).alias(f"S{i}"), F.sum(w * x * x).alias(f"Q{i}")]
    rows = {r["__lab"]: r for r in df.groupBy(col(label).cast("int").alias("__lab")).agg(*aggs)
            .collect()}
    d = len(features)
    N = np.array([rows[j]["N"] if j in rows else 0.0 for j in range(k)], dtype=float)
    S = np.array([[rows[j][f"S{i}"] if j in rows else 0.0 for i in range(d)] for j in range(k)])
    Q = np.array([[rows[j][f"Q{i}"] if j in rows else 0.0 for i in range(d)] for j in range(k)])
    return m_step(N, S, Q, N.sum(), reg, covariance)


def fit_diagonal_mixture(df: DataFrame, features: list[str], k: int, reg: float = 1e-6,
                         seed: int = 42, tol: float = 1e-3, max_iter: int = 100,
                         weight: str | None = None, init_label: str | None = None,
                         covariance: str = "diag") -> DiagonalMixture:
    """EM from k-means labels (or ``init_label``); ``df`` should be cached."""
    if init_label is None:
        from tabloom.operators.cluster.kmeans import fit_kmeans
        labelled = fit_kmeans(df, features, k, n_init=1, seed=seed, weight=weight)["predictions"]
        init_label = "prediction"
    else:
        labelled = df
    m = init_from_labels(labelled, features, init_label, k, reg, weight, covariance)
    prev = -math.inf
    for it in range(1, max_iter + 1):
        N, S, Q, ll, n = sufficient_stats(df, features, m, weight)
        bound = ll / n
        m_new = m_step(N, S, Q, n, reg, covariance)
        m_new.n, m_new.n_iter = n, it
        change = bound - prev
        prev = bound
        m = m_new
        if abs(change) < tol:
            m.converged = True
            break
    # final E-step: log-likelihood of the returned parameters
    _, _, _, ll, n = sufficient_stats(df, features, m, weight)
    m.log_likelihood, m.n = ll, n
    return m


def predict(df: DataFrame, features: list[str], m: DiagonalMixture,
            output: str = "prediction") -> DataFrame:
    """Argmax responsibility (ties: lowest component), batch by batch."""
    xs = [f"__x{i}" for i in range(len(features))]
    staged = df.select("*", *[col(f).cast("double").alias(x) for f, x in zip(features, xs)])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def kernel(it):
        for pdf in it:
            lw = _log_weighted(pdf[xs].to_numpy(dtype=np.float64), m)
            out = pdf.drop(columns=xs)
            out[output] = lw.argmax(axis=1).astype(np.int32)
            yield out

    return staged.mapInPandas(kernel, f"{fields}, `{output}` int")


def log_likelihood(df: DataFrame, features: list[str], m: DiagonalMixture,
                   weight: str | None = None) -> DataFrame:
    """Total log-likelihood and weight of the rows under ``m`` (one job)."""
    spark = df.sparkSession
    _, _, _, ll, n = sufficient_stats(df, features, m, weight)
    return spark.createDataFrame([(ll, n)], "log_likelihood double, n double")
