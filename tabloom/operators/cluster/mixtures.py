"""EM of many Gaussian mixtures in the same passes over the rows.

One pass serves every mixture that hasn't converged, whatever its number of
components and covariance type: a block is multiplied with all components'
precision factors at once, and one matrix product of the responsibilities
with the rows' outer products gives all moments.  The driver sees
(1 + d + d^2) numbers per component and round.  Start, rounds and tolerance
as ``gmm``: hard labels of one k-means run, mean log-likelihood moving less
than ``tol``, at most ``max_iter`` rounds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from tabloom.operators import blocks as B
from tabloom.operators.cluster.restarts import Start, nearest

CHUNK = 512
_EPS10 = 10 * np.finfo(np.float64).eps
TYPES = ("full", "tied", "diag", "spherical")


@dataclass
class Mixture:
    k: int
    covariance: str
    reg: float
    weights: np.ndarray | None = None      # (k,)
    means: np.ndarray | None = None        # (k, d)
    covariances: np.ndarray | None = None  # (k, d, d)
    log_likelihood: float = float("nan")
    n: float = 0.0
    n_iter: int = 0
    converged: bool = False
    used: int = 0                          # components that win a row

    def factors(self) -> tuple[np.ndarray, np.ndarray]:
        """(k, d, d) whitening matrices and the logs of the densities' scale
        and weight."""
        low = np.linalg.cholesky(self.covariances)
        d = low.shape[1]
        inv = np.linalg.solve(low, np.broadcast_to(np.eye(d), low.shape))
        scale = np.log(np.diagonal(low, axis1=1, axis2=2)).sum(axis=1)
        return np.swapaxes(inv, 1, 2), np.log(self.weights) - scale - 0.5 * d * math.log(2 * math.pi)


def _estimate(m: Mixture, N: np.ndarray, S: np.ndarray, C: np.ndarray, middle: np.ndarray,
              n: float) -> None:
    """M-step from moments about ``middle``."""
    nk = N + _EPS10
    mean = S / nk[:, None]
    cov = C / nk[:, None, None] - mean[:, :, None] * mean[:, None, :]
    d = cov.shape[1]
    if m.covariance == "tied":
        cov = np.repeat(((nk[:, None, None] * cov).sum(axis=0) / nk.sum())[None], m.k, axis=0)
    elif m.covariance in ("diag", "spherical"):
        var = np.maximum(np.diagonal(cov, axis1=1, axis2=2), 0.0)
        if m.covariance == "spherical":
            var = np.repeat(var.mean(axis=1, keepdims=True), d, axis=1)
        cov = var[:, :, None] * np.eye(d)[None]
    m.weights, m.means = nk / n, mean + middle
    m.covariances = cov + m.reg * np.eye(d)[None]


def _pass(blocks: B.Blocks, mixtures: list[Mixture], middle: np.ndarray, total: float,
          starts: dict[int, Start] | None = None):
    """By mixture: (N, S, C, log-likelihood, rows won by each component)."""
    first = np.cumsum([0, *(m.k for m in mixtures)])
    c, d = int(first[-1]), len(middle)
    if starts is None:
        parts = [m.factors() for m in mixtures]
        white = np.concatenate([p for p, _ in parts])                    # (c, d, d)
        logs = np.concatenate([s for _, s in parts])
        means = np.concatenate([m.means for m in mixtures]) - middle
        shift = np.einsum("ci,cij->cj", means, white).reshape(-1)
        white = np.swapaxes(white, 0, 1).reshape(d, c * d)

    def kernel(b: B.Block) -> np.ndarray:
        moments, ll, won = np.zeros((c, 1 + d + d * d)), np.zeros(len(mixtures)), np.zeros(c)
        for lo in range(0, b.m, CHUNK):
            x, w = b.x[lo:lo + CHUNK] - middle, b.w[lo:lo + CHUNK]
            r = np.zeros((len(x), c))
            if starts is None:
                y = x @ white
                y -= shift
                y *= y
                lp = logs - 0.5 * y.reshape(len(x), c, d).sum(axis=2)
                for i, (p, q) in enumerate(zip(first, first[1:])):
                    part = lp[:, p:q]
                    top = part.max(axis=1, keepdims=True)
                    e = np.exp(part - top)
                    s = e.sum(axis=1, keepdims=True)
                    r[:, p:q] = e / s * w[:, None]
                    ll[i] += w @ (top[:, 0] + np.log(s[:, 0]))
                    won[p:q] += np.bincount(part.argmax(axis=1), w, q - p)
            else:
                for i, m in enumerate(mixtures):
                    at = nearest(b.x[lo:lo + CHUNK], [starts[m.k]])[0][0]
                    r[np.arange(len(x)), first[i] + at] = w
            outer = (x[:, :, None] * x[:, None, :]).reshape(len(x), d * d)
            moments += r.T @ np.concatenate([np.ones((len(x), 1)), x, outer], axis=1)
        return np.concatenate([moments.ravel(), ll, won])

    got = B.fold(blocks, kernel)
    width = c * (1 + d + d * d)
    moments, ll, won = got[:width].reshape(c, -1), got[width:width + len(mixtures)], got[-c:]
    out = []
    for i, (p, q) in enumerate(zip(first, first[1:])):
        part = moments[p:q]
        out.append((part[:, 0], part[:, 1:1 + d], part[:, 1 + d:].reshape(-1, d, d),
                    float(ll[i]), won[p:q]))
    return out


def fit_mixtures(blocks: B.Blocks, mixtures: list[Mixture], starts: dict[int, Start],
                 tol: float = 1e-3, max_iter: int = 100) -> list[Mixture]:
    """Fits all mixtures from the k-means start of their k."""
    bad = {m.covariance for m in mixtures} - set(TYPES)
    if bad:
        raise NotImplementedError(f"covariance types {sorted(bad)}")
    d = next(iter(starts.values())).centers.shape[1]
    got = B.fold(blocks, lambda b: np.concatenate([[b.w.sum()], b.w @ b.x]))
    total, middle = float(got[0]), got[1:1 + d] / got[0]
    for m, (N, S, C, _, _) in zip(mixtures, _pass(blocks, mixtures, middle, total, starts)):
        _estimate(m, N, S, C, middle, total)
        m.n = total
    live, before = list(mixtures), {id(m): -math.inf for m in mixtures}
    while live:
        for m, (N, S, C, ll, _) in zip(live, _pass(blocks, live, middle, total)):
            _estimate(m, N, S, C, middle, total)
            m.n_iter += 1
            m.converged = abs(ll / total - before[id(m)]) < tol
            before[id(m)] = ll / total
        live = [m for m in live if not m.converged and m.n_iter < max_iter]
    for m, (_, _, _, ll, won) in zip(mixtures, _pass(blocks, mixtures, middle, total)):
        m.log_likelihood, m.used = ll, int((won > 0).sum())
    return mixtures
