"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers x = floor(scale * c) + offset, so counts, sums
and deviations are exact.  With X the rows centred at their mean, each step
multiplies a unit vector v by X and the result u by X', both as one pass over
the rows that Spark sums, and orthogonalises u against all earlier u (twice)
and the next v against all earlier v (twice).

No vector as long as the table is kept: every u is X g for a short vector g,
so a pass recomputes a row's entries of all u from the row itself.  The
driver holds v, g, X'u and the small matrix B with X V = U B, all bounded by
the dimension squared.  The singular values of B give the components and
deviations; residuals X'u - s v tell when the first ones have converged.  The
iteration then restarts once from a random vector orthogonal to all v and
goes on for ``PROBE`` steps, which finds repeated eigenvalues that one
sequence cannot see; it also restarts where a sequence ends early.

Defined cases: rows whose vector is null or has null or non-finite entries
take no part, nor do vectors of another length than most (of two equally
frequent lengths the longer stays); null ids and repeated rows are rows like
others; directions without variance are no components, so a table of equal
vectors, or an empty one, gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import spread, stage_table

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
TOLERANCE = 2e-14   # residual of a converged component, by the first deviation
PROBE = 8           # steps after the restart
FLAT = 1e-10        # a step this short, by the first deviation, adds nothing
LONG = 2 ** 63


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int,
                  offset: int) -> DataFrame:
    """(id, size, x): the rows that take part; x as 64-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not v.is_valid or v.values.null_count:
                    continue
                c = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(c).all():
                    ids.append(i)
                    out.append((np.floor(scale * c).astype(np.int64) + offset).astype("<i8"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(x) for x in out], pa.int32()),
                 pa.array([x.tobytes() for x in out], pa.binary())], names=["id", "size", "x"])

    rows = vectors.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>"))
    return spread(rows).mapInArrow(run, "id long, size int, x binary")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, d)


class Rows:
    """The staged rows; sums of functions of them, centred."""

    def __init__(self, rows: DataFrame, d: int):
        self.rows, self.d = rows, d
        found = rows.mapInArrow(self._first(d), "i int, x decimal(38,0)").groupBy("i").agg(
            F.sum("x").alias("x")).collect()  # d + 1 rows
        got = {r["i"]: int(r["x"]) for r in found}
        self.n = got.get(-1, 0)
        self.sums = [got.get(i, 0) for i in range(d)]

    @staticmethod
    def _first(d: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import decimal
            n, total = 0, [0] * d
            for batch in batches:
                x = _matrix(batch.column("x"), d)
                n += len(x)
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *range(d)], pa.int32()),
                 pa.array([decimal.Decimal(v) for v in (n, *total)], pa.decimal128(38, 0))],
                names=["i", "x"])
        return run

    def centred(self):
        """A function from whole-number rows to centred doubles: the
        numerator n x - S is exact before it is divided."""
        n, sums = self.n, np.array(self.sums, dtype=object)
        if n * max(map(abs, [*self.sums, 1])) < LONG // 4:
            sums = sums.astype(np.int64)
            return lambda x: (n * x - sums) / n
        return lambda x: ((n * x.astype(object) - sums) / n).astype(np.float64)

    def total(self, function, width: int) -> np.ndarray:
        """Sum over batches of ``function(centred rows)``, of this width."""
        d, centred = self.d, self.centred()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(width)
            for batch in batches:
                if batch.num_rows:
                    out += function(centred(_matrix(batch.column("x"), d)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width), pa.int32()), pa.array(out)], names=["i", "x"])

        got = self.rows.select("x").mapInArrow(run, "i int, x double").groupBy("i").agg(
            F.sum("x").alias("x")).collect()  # ``width`` rows
        out = np.zeros(width)
        for r in got:
            out[r["i"]] = r["x"]
        return out


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def principal(data: Rows, k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(components as rows, eigenvalues), largest first, at most ``k``."""
    d, rng = data.d, np.random.default_rng(seed)
    vs: list[np.ndarray] = []   # orthonormal right vectors
    gs: list[np.ndarray] = []   # u = X g, orthonormal
    ts: list[np.ndarray] = []   # X'u
    columns: list[np.ndarray] = []
    v, probe, last = None, None, None
    top = 0.0
    while True:
        if v is None:
            if len(vs) == d:
                break
            v = _orthogonal(rng.normal(size=d), vs)
            v = _orthogonal(v / np.linalg.norm(v), vs)
            v /= np.linalg.norm(v)
        g = np.array(gs).reshape(len(gs), d)

        def xv(rows: np.ndarray, v=v, g=g) -> np.ndarray:
            return (rows @ g.T).T @ (rows @ v)

        h = data.total(xv, len(gs)) if gs else np.zeros(0)
        y = v - h @ g

        def xtu(rows: np.ndarray, y=y, g=g) -> np.ndarray:
            u = rows @ y
            return np.concatenate([(rows @ g.T).T @ u, rows.T @ u, [u @ u]])

        got = data.total(xtu, len(gs) + d + 1)
        h2, s, square = got[:len(gs)], got[len(gs):-1], got[-1]
        y = y - h2 @ g
        s = s - h2 @ np.array(ts).reshape(len(ts), d)
        alpha = math.sqrt(max(square - h2 @ h2, 0.0))
        vs.append(v)
        top = max(top, alpha)
        v = None
        if alpha > FLAT * top:
            gs.append(y / alpha)
            ts.append(s / alpha)
            columns.append(np.r_[h + h2, alpha])
            new = _orthogonal(ts[-1], vs)
            beta = np.linalg.norm(new)
            if beta > FLAT * top and len(vs) < d:
                v = _orthogonal(new / beta, vs)
                v /= np.linalg.norm(v)
        else:
            columns.append(h + h2)
        if not gs:
            continue
        b = np.zeros((len(gs), len(vs)))
        for j, column in enumerate(columns):
            b[:len(column), j] = column
        p, sigma, qt = np.linalg.svd(b, full_matrices=False)
        top = max(top, sigma[0])
        m = min(k, d, len(sigma))
        right = qt[:m] @ np.array(vs)
        off = np.linalg.norm(p.T[:m] @ np.array(ts) - sigma[:m, None] * right, axis=1)
        if len(sigma) >= min(k, d) and off.max() <= TOLERANCE * top:
            if probe is None:
                probe, last, v = len(vs) + PROBE, sigma[:m], None
            elif len(vs) >= probe:
                if np.abs(sigma[:m] - last).max() <= 1e-10 * top:
                    break
                probe, last, v = len(vs) + PROBE, sigma[:m], None
    if not gs:
        return np.zeros((0, d)), np.zeros(0)
    keep = sigma[:m] > FLAT * top
    right = right[keep]
    right /= np.linalg.norm(right, axis=1, keepdims=True)
    return right, sigma[:m][keep] ** 2 / data.n


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           k: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error:
    a row per vector and component."""
    spark = vectors.sparkSession
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    rows = stage_table(whole_numbers(vectors, id_col, vector_col, scale, offset), "whole-vectors")
    common = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None or not common["size"]:
        return spark.createDataFrame([], schema)
    d = common["size"]
    data = Rows(rows.where(F.col("size") == d), d)
    axes, values = principal(data, k)
    if not len(values):
        return spark.createDataFrame([], schema)
    trace = data.total(lambda x: np.array([(x * x).sum()]), 1)[0] / data.n
    m, project = len(values), axes.T / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        z = x @ project
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    sums = data.total(moments, m + m * m) / data.n
    covariance = sums[m:].reshape(m, m) - np.outer(sums[:m], sums[:m])
    error = float(np.abs(covariance - np.eye(m)).max())
    n, whole, centred, explained = data.n, data.sums, data.centred(), values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.array(whole, dtype=object)
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            z = centred(x) @ project
            gap = n * x.astype(object) - s
            size = max((abs(v) for v in gap.ravel()), default=0)
            if size * size * d < LONG:
                gap = gap.astype(np.int64)
            far = [int(v) for v in (gap * gap).sum(axis=1)]
            rows = len(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(np.repeat(np.arange(rows), m))),
                 pa.array(np.tile(np.arange(1, m + 1), rows), pa.int32()),
                 pa.array(np.full(rows * m, n), pa.int64()),
                 pa.array([v for v in far for _ in range(m)], pa.int64()),
                 pa.array(z.ravel()), pa.array(np.tile(explained, rows)),
                 pa.array(np.full(rows * m, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                       "identity_error"])

    return data.rows.select("id", "x").mapInArrow(run, schema)
