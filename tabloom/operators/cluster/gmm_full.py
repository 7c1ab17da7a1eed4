"""Gaussian mixture with full or tied covariance, EM as Spark jobs.

As ``gmm``, with cross products: each round, every partition folds
sum w r_j, sum w r_j (x - mu_j) and sum w r_j (x - mu_j)(x - mu_j)' about the
round's means into one vector, and Spark adds the vectors, so the driver sees
k(1 + d + d^2) + 2 numbers a round.  ``tied`` averages the components'
covariances by their weights.  Start, tolerance, rounds and ``reg`` as there.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.cluster.gmm import _EPS10, _LOG_2PI, _w
from tabloom.operators.columns import col


@dataclass
class FullMixture:
    weights: np.ndarray      # (k,)
    means: np.ndarray        # (k, d)
    covariances: np.ndarray  # (k, d, d)
    log_likelihood: float = float("nan")
    n: float = 0.0
    n_iter: int = 0
    converged: bool = False

    @property
    def k(self) -> int:
        return len(self.weights)

    def log_weighted(self, x: np.ndarray) -> np.ndarray:
        """(n, k): log pi_j + log N(x | mu_j, cov_j)."""
        out = np.empty((len(x), self.k))
        for j in range(self.k):
            low = np.linalg.cholesky(self.covariances[j])
            y = np.linalg.solve(low, (x - self.means[j]).T)
            out[:, j] = (math.log(self.weights[j]) - np.log(np.diag(low)).sum()
                         - 0.5 * (x.shape[1] * _LOG_2PI + (y * y).sum(axis=0)))
        return out


def _sums(df: DataFrame, features: list[str], centers: np.ndarray, m: FullMixture | None,
          label: str | None, weight: str | None):
    """(N_j, S_j, C_j about the centers, log-likelihood, weight) of the
    responsibilities under ``m``, or of hard labels without it."""
    k, d = centers.shape
    xs = [f"x{i}" for i in range(d)]
    pts = df.select(*[col(f).cast("double").alias(x) for f, x in zip(features, xs)],
                    _w(weight).alias("w"),
                    (F.lit(0) if label is None else col(label)).cast("int").alias("lab"))

    def kernel(it):
        total = np.zeros(2)
        N, S, C = np.zeros(k), np.zeros((k, d)), np.zeros((k, d, d))
        for pdf in it:
            if pdf.empty:
                continue
            x = pdf[xs].to_numpy(dtype=np.float64)
            w = pdf["w"].to_numpy(dtype=np.float64)
            if m is None:
                r = (pdf["lab"].to_numpy()[:, None] == np.arange(k)[None, :]) * w[:, None]
            else:
                lw = m.log_weighted(x)
                top = lw.max(axis=1, keepdims=True)
                lse = (top + np.log(np.exp(lw - top).sum(axis=1, keepdims=True)))[:, 0]
                r = np.exp(lw - lse[:, None]) * w[:, None]
                total[0] += float(w @ lse)
            total[1] += float(w.sum())
            N += r.sum(axis=0)
            for j in range(k):
                c = x - centers[j]
                S[j] += r[:, j] @ c
                C[j] += (c * r[:, j:j + 1]).T @ c
        yield pd.DataFrame({"v": [np.r_[N, S.ravel(), C.ravel(), total].tolist()]})

    parts = pts.mapInPandas(kernel, "v array<double>")
    vals = np.zeros(k * (1 + d + d * d) + 2)
    for i, x in parts.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(
            F.sum("x").alias("x")).collect():
        vals[i] = x
    return (vals[:k], vals[k:k + k * d].reshape(k, d), vals[k + k * d:-2].reshape(k, d, d),
            float(vals[-2]), float(vals[-1]))


def _m_step(N, S, C, n, centers, reg: float, covariance: str) -> FullMixture:
    nk = N + _EPS10
    moved = S / nk[:, None]
    cov = C / nk[:, None, None] - moved[:, :, None] * moved[:, None, :]
    if covariance == "tied":
        cov = np.repeat(((nk[:, None, None] * cov).sum(axis=0) / nk.sum())[None], len(nk), axis=0)
    cov = cov + reg * np.eye(cov.shape[1])[None]
    return FullMixture(nk / n, centers + moved, cov)


def fit_full_mixture(df: DataFrame, features: list[str], k: int, reg: float = 1e-6,
                     seed: int = 42, tol: float = 1e-3, max_iter: int = 100,
                     weight: str | None = None, init_label: str | None = None,
                     covariance: str = "full") -> FullMixture:
    """EM from k-means labels (or ``init_label``); ``df`` should be cached."""
    if covariance not in ("full", "tied"):
        raise NotImplementedError(f"covariance type {covariance!r}")
    labelled = df
    if init_label is None:
        from tabloom.operators.cluster.kmeans import fit_kmeans
        labelled = fit_kmeans(df, features, k, n_init=1, seed=seed, weight=weight)["predictions"]
        init_label = "prediction"
    centers = np.zeros((k, len(features)))
    N, S, C, _, n = _sums(labelled, features, centers, None, init_label, weight)
    m = _m_step(N, S, C, n, centers, reg, covariance)
    prev = -math.inf
    for it in range(1, max_iter + 1):
        N, S, C, ll, n = _sums(df, features, m.means, m, None, weight)
        m = _m_step(N, S, C, n, m.means, reg, covariance)
        m.n, m.n_iter = n, it
        change, prev = ll / n - prev, ll / n
        if abs(change) < tol:
            m.converged = True
            break
    m.log_likelihood = _sums(df, features, m.means, m, None, weight)[3]
    return m


def predict_full(df: DataFrame, features: list[str], m: FullMixture) -> DataFrame:
    """prediction: argmax responsibility of every row (ties: lowest)."""
    xs = [f"x{i}" for i in range(len(features))]
    pts = df.select(*[col(f).cast("double").alias(x) for f, x in zip(features, xs)])

    def kernel(it):
        for pdf in it:
            best = m.log_weighted(pdf[xs].to_numpy(dtype=np.float64)).argmax(axis=1)
            yield pd.DataFrame({"prediction": best.astype(np.int32)})

    return pts.mapInPandas(kernel, "prediction int")
