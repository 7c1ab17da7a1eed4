"""Least squares of least norm against NumPy, on singular and wide designs."""
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabloom.operators import encode, least_squares
from tabloom.operators.least_squares import fit_least_norm, predict_linear


def design(n, seed=3):
    """Dummies that add up to one, a repeated column, a constant, a large offset."""
    rng = np.random.default_rng(seed)
    kind = rng.integers(0, 5, n)
    x = rng.normal(size=n)
    a = np.column_stack([np.eye(5)[kind], x, 3 * x + 2, 2016 + rng.integers(0, 7, n), np.full(n, 4.25),
                         rng.integers(0, 2, n)])
    return a, 3 * x + kind + rng.normal(size=n)


def frame(spark, a, y):
    """Every third vector dense, the others sparse."""
    rows = []
    for i, (r, v) in enumerate(zip(a.tolist(), y)):
        sparse = Vectors.sparse(len(r), [(j, x) for j, x in enumerate(r) if x])
        rows.append((i, Vectors.dense(r) if i % 3 == 0 else sparse, float(v)))
    return spark.createDataFrame(rows, ["id", "features", "label"])


def least_norm(a, y):
    sd = a.std(axis=0)
    z = (a - a.mean(axis=0)) / np.where(sd > 1e-12, sd, 1)
    return np.linalg.lstsq(z, y - y.mean(), rcond=1e-10)[0], z


@pytest.mark.parametrize("gram", [True, False])
def test_singular_design(spark, monkeypatch, gram):
    if not gram:
        monkeypatch.setattr(least_squares, "GRAM_SLOTS", 0)
    a, y = design(300)
    want, z = least_norm(a, y)
    df = frame(spark, a, y).repartition(5)
    fit = fit_least_norm(df, a.shape[1])
    assert np.abs(fit.coefficients - want).max() < 1e-8
    assert fit.coefficients[8] == 0 and abs(fit.intercept - y.mean()) < 1e-10
    got = np.array([r[0] for r in predict_linear(df, fit).orderBy("id").select("prediction").collect()])
    assert np.abs(got - (y.mean() + z @ want)).max() < 1e-8


def test_more_features_than_rows(spark, monkeypatch):
    rng = np.random.default_rng(1)
    a, y = rng.normal(size=(12, 40)), rng.normal(size=12)
    want, _ = least_norm(a, y)
    for slots in (512, 0):
        monkeypatch.setattr(least_squares, "GRAM_SLOTS", slots)
        fit = fit_least_norm(frame(spark, a, y), 40)
        assert np.abs(fit.coefficients - want).max() < 1e-8


def test_missing_labels_one_row_and_none(spark):
    a, y = design(60)
    df = frame(spark, a, y)
    gaps = df.withColumn("label", F.when(F.col("id") >= 20, F.col("label")))
    want, _ = least_norm(a[20:], y[20:])
    assert np.abs(fit_least_norm(gaps, a.shape[1]).coefficients - want).max() < 1e-8
    one = fit_least_norm(df.limit(1), a.shape[1])
    assert not one.coefficients.any() and one.intercept == df.limit(1).first()["label"]
    with pytest.raises(ValueError):
        fit_least_norm(df.where("id < 0"), a.shape[1])


def test_slot_names_of_sparse_dummies(spark):
    df = spark.createDataFrame([(1.0, "b_1", "x"), (2.0, "a", "x"), (3.0, None, "x"), (4.0, "c", "y")],
                               "n double, s string, t string")
    enc = encode.one_hot_vector(df, ["s", "t"], ["n"], drop_first=True)
    assert encode.slot_names(enc, ["s", "t"]) == ["n", "s_b_1", "s_c", "t_y"]
