"""K-means restarts (C1) that share every pass over the rows.

All starts, of any number of centres, advance together: one pass per
k-means++ step draws each start's next centre, and one pass per Lloyd round
returns the sums of all starts that still move.  The driver holds the
centres only.  A draw is the least of -log(u) / (w d^2) over the rows, where
u is a hash of the row's coordinates, the start and the step, so the same
centres are drawn under any partitioning; equal rows of equal weight share
a draw.  A centre without rows stays where it is.

A start stops when the squared shift of its centres is at most ``tol`` times
the mean variance, or after ``max_iter`` rounds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from tabloom.operators import blocks as B

CHUNK = 256
_ODD = np.random.default_rng(99).integers(1, 2**63, 512, dtype=np.uint64) * np.uint64(2) + \
    np.uint64(1)


@dataclass
class Start:
    k: int
    seed: int
    centers: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    cost: float = float("inf")
    rounds: int = 0
    moving: bool = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _row_hash(x: np.ndarray) -> np.ndarray:
    bits = np.ascontiguousarray(x + 0.0).view(np.uint64)
    odd = np.resize(_ODD, x.shape[1])
    return _mix((_mix(bits) * odd).sum(axis=1, dtype=np.uint64))


def _draws(h: np.ndarray, seeds: np.ndarray, step: int) -> np.ndarray:
    """(rows, starts) uniform numbers in (0, 1]."""
    salt = _mix(seeds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step))
    return ((_mix(h[:, None] ^ salt[None, :]) >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53


def _scores(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """(centres, rows): squared distances less the rows' squared norms."""
    wide = np.concatenate([-2.0 * centers, (centers * centers).sum(axis=1)[:, None]], axis=1)
    return wide @ np.concatenate([x, np.ones((len(x), 1))], axis=1).T


def seed_starts(blocks: B.Blocks, starts: list[Start]) -> None:
    """k-means++: one pass per step for all starts."""
    for step in range(max(s.k for s in starts)):
        live = [s for s in starts if s.k > step]
        seeds = np.array([s.seed for s in live])
        placed = np.concatenate([s.centers for s in live]) if step else None

        def kernel(b: B.Block) -> np.ndarray:
            best = np.full((len(live), 1 + b.x.shape[1]), np.inf)
            for lo in range(0, b.m, CHUNK):
                x, w = b.x[lo:lo + CHUNK], b.w[lo:lo + CHUNK]
                u = -np.log(_draws(_row_hash(x), seeds, step))
                mass = np.broadcast_to(w[:, None], u.shape)
                if placed is not None:
                    far = _scores(x, placed).reshape(len(live), step, len(x)).min(axis=1)
                    mass = np.maximum(far + (x * x).sum(axis=1), 0.0).T * w[:, None]
                with np.errstate(divide="ignore"):
                    key = np.where(mass > 0, u / mass, np.inf)
                at = key.argmin(axis=0)
                low = key[at, np.arange(len(live))]
                better = low < best[:, 0]
                best[better, 0] = low[better]
                best[better, 1:] = x[at[better]]
            return best.ravel()

        def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            a, b = a.reshape(len(live), -1), b.reshape(len(live), -1)
            return np.where((a[:, 0] <= b[:, 0])[:, None], a, b).ravel()

        got = B.fold(blocks, kernel, merge)
        if got is None:
            raise ValueError("k-means needs at least one row")
        for s, row in zip(live, got.reshape(len(live), -1)):
            new = row[1:] if np.isfinite(row[0]) else s.centers[0]  # no distinct row is left
            s.centers = np.vstack([s.centers.reshape(step, -1) if step else np.zeros((0, len(new))),
                                   new])


def nearest(x: np.ndarray, starts: list[Start]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, rows): each start's nearest centre (ties: the lowest) and
    its squared distance; starts of equal k are compared together."""
    at = np.empty((len(starts), len(x)), dtype=np.int32)
    near = np.empty((len(starts), len(x)))
    by_k: dict[int, list[int]] = {}
    for i, s in enumerate(starts):
        by_k.setdefault(s.k, []).append(i)
    for lo in range(0, len(x), CHUNK):
        part = x[lo:lo + CHUNK]
        norms = (part * part).sum(axis=1)
        for k, mine in by_k.items():
            d2 = _scores(part, np.concatenate([starts[i].centers for i in mine]))
            d2 = d2.reshape(len(mine), k, len(part))
            best, which = d2[:, 0].copy(), np.zeros((len(mine), len(part)), dtype=np.int32)
            for j in range(1, k):
                which[d2[:, j] < best] = j
                np.minimum(best, d2[:, j], out=best)
            at[mine, lo:lo + CHUNK] = which
            near[mine, lo:lo + CHUNK] = np.maximum(best + norms, 0.0)
    return at, near


def _round(blocks: B.Blocks, starts: list[Start]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """By start: (weights, sums) of its centres and its cost."""
    first = np.cumsum([0, *(s.k for s in starts)])
    total = int(first[-1])

    def kernel(b: B.Block) -> np.ndarray:
        d = b.x.shape[1]
        sums, cost = np.zeros((total, d + 1)), np.zeros(len(starts))
        for lo in range(0, b.m, CHUNK):
            x, w = b.x[lo:lo + CHUNK], b.w[lo:lo + CHUNK]
            at, near = nearest(x, starts)
            hot = np.zeros((total, len(x)))
            hot[at + first[:-1, None], np.arange(len(x))[None, :]] = w[None, :]
            sums += hot @ np.concatenate([x, np.ones((len(x), 1))], axis=1)
            cost += near @ w
        return np.concatenate([sums.ravel(), cost])

    got = B.fold(blocks, kernel)
    d = starts[0].centers.shape[1]
    sums, cost = got[:total * (d + 1)].reshape(total, d + 1), got[total * (d + 1):]
    return [(sums[a:b, d], sums[a:b, :d], float(c)) for a, b, c in zip(first, first[1:], cost)]


def run_starts(blocks: B.Blocks, starts: list[Start], max_iter: int = 300, tol: float = 1e-4
               ) -> list[Start]:
    """Seeds and moves all starts to their ends; fills centers and cost."""
    seed_starts(blocks, starts)
    d = starts[0].centers.shape[1]

    def moments(b: B.Block) -> np.ndarray:
        return np.concatenate([[b.w.sum()], b.w @ b.x, b.w @ (b.x * b.x)])

    got = B.fold(blocks, moments)
    spread = float((got[1 + d:] / got[0] - (got[1:1 + d] / got[0]) ** 2).mean())
    live = list(starts)
    while live:
        for s, (weight, sums, cost) in zip(live, _round(blocks, live)):
            s.cost = cost
            new = np.where(weight[:, None] > 0, sums / np.maximum(weight, 1e-300)[:, None],
                           s.centers)
            shift = float(((new - s.centers) ** 2).sum())
            s.centers, s.rounds = new, s.rounds + 1
            s.moving = shift > tol * spread and s.rounds < max_iter
        live = [s for s in live if s.moving]
    for s, (_, _, cost) in zip(starts, _round(blocks, starts)):
        s.cost = cost
    return starts


def best_start(starts: list[Start]) -> Start:
    return min(starts, key=lambda s: (s.cost, s.seed))


def label_blocks(blocks: B.Blocks, chosen: list[Start]) -> B.Blocks:
    """Blocks with one label per chosen start."""
    return B.labelled(blocks, lambda b: nearest(b.x, chosen)[0].T)
