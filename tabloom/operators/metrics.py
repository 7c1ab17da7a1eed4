"""Model metrics (V1-V6) and clustering metrics (K1-K4).

Every metric is an aggregate; clustering metrics take optional row weights
(multiplicities from ``split.bootstrap``) and then equal the metric on the
table with each row repeated ``weight`` times.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.numeric import band, jitter
from tabloom.operators import blocks as B
from tabloom.operators.columns import col


# ------------------------------------------------------------ supervised
def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """V1."""
    return df.agg(F.avg((col(label) == col(prediction)).cast("double")).alias("accuracy"))


def regression_metrics(df: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """V2-V4 in one pass: R², MAE, MSE, RMSE.  SS_tot = n * var_pop(y),
    whose Spark aggregate is numerically stable."""
    y, p = col(label).cast("double"), col(prediction).cast("double")
    err = y - p
    out = df.agg(F.count(F.lit(1)).alias("n"), F.sum(err * err).alias("sse"),
                 F.avg(F.abs(err)).alias("mae"), F.avg(err * err).alias("mse"),
                 F.var_pop(y).alias("vy"))
    return out.select(
        F.when(F.col("vy") > 0, F.lit(1.0) - F.col("sse") / (F.col("vy") * F.col("n")))
         .alias("r2"),
        "mae", "mse", F.sqrt("mse").alias("rmse"))


def fit_verdict(metrics: DataFrame) -> DataFrame:
    """V5: R² band as text."""
    return metrics.withColumn("verdict", band(F.col("r2")))


def prediction_sample(df: DataFrame, key: list[str], label: str = "label",
                      prediction: str = "prediction", n: int = 10) -> DataFrame:
    """V6: first ``n`` (real, predicted) pairs in key order."""
    return df.orderBy(*[col(k) for k in key]).limit(n).select(
        *[col(k) for k in key], col(label).alias("real"), col(prediction).alias("predicted"))


def plot_frame(df: DataFrame, label: str = "label", prediction: str = "prediction",
               seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """V6: (real, predicted + N(0,1) jitter) for the scatter plot."""
    return df.select(col(label).alias("real"), jitter(
        col(prediction), 1.0, seed, key and [col(k) for k in key]).alias("predicted_jitter"))


# ------------------------------------------------------------ clustering
def _w(weight):
    return F.lit(1.0) if weight is None else col(weight).cast("double")


def centroids(df: DataFrame, features: list[str], label: str,
              weight: str | None = None) -> DataFrame:
    """(label, n_k, c_<f>...) by one grouped aggregate."""
    w = _w(weight)
    return df.groupBy(col(label).alias("__label")).agg(
        F.sum(w).alias("__nk"),
        *[(F.sum(w * col(f)) / F.sum(w)).alias(f"__c{i}") for i, f in enumerate(features)])


def calinski_harabasz(df: DataFrame, features: list[str], label: str = "prediction",
                      weight: str | None = None) -> DataFrame:
    """K2: [B/(k-1)] / [W/(n-k)]; W = 0 gives 1.0 (scikit-learn's rule)."""
    spark = df.sparkSession
    w = _w(weight)
    cent = centroids(df, features, label, weight)
    k = cent.count()
    tot = df.agg(F.sum(w).alias("n"), *[(F.sum(w * col(f)) / F.sum(w)).alias(f"g{i}")
                                        for i, f in enumerate(features)]).first()
    n = tot["n"]
    between = cent.agg(F.sum(F.col("__nk") * sum(
        (F.col(f"__c{i}") - F.lit(tot[f"g{i}"])) ** 2 for i in range(len(features))))).first()[0]
    joined = df.join(cent, col(label) == F.col("__label"))
    within = joined.agg(F.sum(w * sum(
        (col(f) - F.col(f"__c{i}")) ** 2 for i, f in enumerate(features)))).first()[0]
    if k < 2:
        raise ValueError("Calinski-Harabasz needs at least 2 labels")
    score = 1.0 if within == 0 else (between / (k - 1)) / (within / (n - k))
    return spark.createDataFrame([(float(score),)], "calinski_harabasz double")


def davies_bouldin(df: DataFrame, features: list[str], label: str = "prediction",
                   weight: str | None = None) -> DataFrame:
    """K3: mean over clusters of max_j (s_i + s_j) / d(c_i, c_j).

    s_i (mean distance to the own centroid) is a grouped aggregate over the
    rows; the pairs of clusters meet in tiles of two blocks of centroids.
    """
    spark = df.sparkSession
    w = _w(weight)
    cent = centroids(df, features, label, weight)
    joined = df.join(cent, col(label) == F.col("__label"))
    dist = F.sqrt(sum((col(f) - F.col(f"__c{i}")) ** 2 for i, f in enumerate(features)))
    spread = joined.groupBy("__label").agg((F.sum(w * dist) / F.sum(w)).alias("__s"))
    names = [f"__c{i}" for i in range(len(features))]
    # a centroid's block carries s as its weight
    blocks = B.pack(cent.join(spread, "__label"), names, None, "__s", rows=1024)
    found = B.fold(blocks, lambda b: np.array([b.m, (np.abs(b.w) > 1e-8).sum()], dtype=float))
    if found is None or found[0] < 2:
        raise ValueError("Davies-Bouldin needs at least 2 labels")

    def ratios(a: B.Block, b: B.Block) -> list[tuple]:
        d = np.sqrt(((a.x[:, None, :] - b.x[None, :, :]) ** 2).sum(axis=-1))
        d[d == 0] = np.inf
        r = (a.w[:, None] + b.w[None, :]) / d
        if a.id == b.id:
            np.fill_diagonal(r, -np.inf)
        out = [(a.id, b.id, r.max(axis=1).tobytes())]
        return out + ([(b.id, a.id, r.max(axis=0).tobytes())] if a.id != b.id else [])

    best = B.sum_states(B.tiles(blocks, ratios, "block long, other long, v binary"), blocks,
                        merge=np.maximum)

    def means(batches):
        for batch in batches:
            v = [np.frombuffer(x, "<f8") for x in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([float(x.sum()) for x in v], pa.float64()),
                                              pa.array([len(x) for x in v], pa.int64())], ["s", "n"])

    row = best.mapInArrow(means, "s double, n long").agg(F.sum("s"), F.sum("n")).first()
    score = 0.0 if not found[1] else float(row[0] / row[1])
    return spark.createDataFrame([(score,)], "davies_bouldin double")


def n_parameters(k: int, d: int, covariance: str = "diag") -> int:
    """Free parameters of a k-component Gaussian mixture in d dimensions."""
    cov = {"full": k * d * (d + 1) // 2, "diag": k * d, "spherical": k,
           "tied": d * (d + 1) // 2}[covariance]
    return k * d + cov + k - 1


def bic(log_likelihood: float, n: float, k: int, d: int, covariance: str = "diag") -> float:
    """K4: -2 log L + p ln n."""
    return -2.0 * log_likelihood + n_parameters(k, d, covariance) * math.log(n)


def silhouette(df: DataFrame, id_col: str, features: list[str], label: str = "prediction",
               weight: str | None = None, block_rows: int = B.ROWS) -> DataFrame:
    """K1: exact Euclidean silhouette (weighted mean of per-row scores); every
    unordered pair of blocks is computed once, see ``silhouettes``."""
    from tabloom.operators.silhouettes import silhouettes
    d = len(features)
    blocks = B.pack(df, [*features, label], id_col, weight, block_rows)

    def split(batches):
        for b in B.iterate(batches):
            cells = (b.ids, b.w, np.ascontiguousarray(b.x[:, :d]),
                     np.ascontiguousarray(b.x[:, d:]).astype("<i4"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.id]), pa.array([b.m], pa.int32()),
                 *(pa.array([c.tobytes()], pa.binary()) for c in cells)],
                names=["block", "m", "ids", "w", "x", "labels"])

    found = silhouettes(blocks.with_table(blocks.table.mapInArrow(
        split, B.FIELDS + ", labels binary")))
    score = found[0][0] if found else None
    if found and score is None:
        score = 0.0  # one label: no other cluster to compare with
    return df.sparkSession.createDataFrame([(score,)], "silhouette double")
