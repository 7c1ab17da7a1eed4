"""Clustering models and metrics against independent NumPy versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import metrics as K
from tabloom.operators.cluster import gmm as G
from tabloom.operators.cluster.birch import birch, ward_labels
from tabloom.operators.cluster.dbscan import dbscan
from tabloom.operators.cluster.kmeans import fit_kmeans


def _frame(spark, X, labels=None, weights=None):
    rows = []
    for i, x in enumerate(X):
        r = [i] + [float(v) for v in x]
        if labels is not None:
            r.append(int(labels[i]))
        if weights is not None:
            r.append(float(weights[i]))
        rows.append(tuple(r))
    cols = ["id long"] + [f"f{j} double" for j in range(X.shape[1])]
    if labels is not None:
        cols.append("label int")
    if weights is not None:
        cols.append("w double")
    return spark.createDataFrame(rows, ", ".join(cols)).repartition(3)


def np_silhouette(X, lab):
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    s = np.zeros(len(X))
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() == 1:
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s[i] = (b - a) / max(a, b) if max(a, b) > 0 else 0
    return s.mean()


def test_silhouette_exact_with_singleton(spark):
    rng = np.random.default_rng(0)
    X = np.vstack([rng.normal(0, 1, (40, 3)), rng.normal(4, 1, (40, 3)), [[10, 10, 10]]])
    lab = np.array([0] * 40 + [1] * 40 + [2])
    df = _frame(spark, X, lab)
    got = K.silhouette(df, "id", ["f0", "f1", "f2"], "label", block_rows=16).first()[0]
    assert got == pytest.approx(np_silhouette(X, lab), abs=1e-11)


def test_weighted_silhouette_equals_repeated_rows(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(30, 2))
    lab = (X[:, 0] > 0).astype(int)
    w = rng.integers(1, 4, 30)
    rep = np.repeat(np.arange(30), w)
    want = np_silhouette(X[rep], lab[rep])
    got = K.silhouette(_frame(spark, X, lab, w), "id", ["f0", "f1"], "label", "w",
                       block_rows=8).first()[0]
    assert got == pytest.approx(want, abs=1e-11)


def test_calinski_and_davies_bouldin(spark):
    rng = np.random.default_rng(2)
    X = np.vstack([rng.normal(0, 1, (25, 2)), rng.normal(3, 1, (25, 2)), rng.normal(-3, 1, (25, 2))])
    lab = np.repeat([0, 1, 2], 25)
    df = _frame(spark, X, lab)
    n, k = len(X), 3
    g = X.mean(0)
    cents = np.array([X[lab == c].mean(0) for c in range(k)])
    B = sum((lab == c).sum() * ((cents[c] - g) ** 2).sum() for c in range(k))
    W = sum(((X[lab == c] - cents[c]) ** 2).sum() for c in range(k))
    ch = (B / (k - 1)) / (W / (n - k))
    s = np.array([np.sqrt(((X[lab == c] - cents[c]) ** 2).sum(1)).mean() for c in range(k)])
    d = np.sqrt(((cents[:, None] - cents[None]) ** 2).sum(-1))
    db = np.mean([max((s[i] + s[j]) / d[i, j] for j in range(k) if j != i) for i in range(k)])
    assert K.calinski_harabasz(df, ["f0", "f1"], "label").first()[0] == pytest.approx(ch, rel=1e-10)
    assert K.davies_bouldin(df, ["f0", "f1"], "label").first()[0] == pytest.approx(db, rel=1e-10)


def np_dbscan(X, eps, min_samples, w=None):
    n = len(X)
    w = np.ones(n) if w is None else w
    D2 = ((X[:, None] - X[None]) ** 2).sum(-1)
    nb = D2 <= eps * eps
    core = (nb * w[None]).sum(1) >= min_samples
    lab = -np.ones(n, dtype=int)
    comp = -np.ones(n, dtype=int)
    for i in range(n):  # components of the core graph, id = smallest member
        if core[i] and comp[i] < 0:
            stack, members = [i], []
            comp[i] = i
            while stack:
                j = stack.pop()
                members.append(j)
                for t in np.flatnonzero(nb[j] & core):
                    if comp[t] < 0:
                        comp[t] = i
                        stack.append(t)
            m = min(members)
            comp[members] = m
    for i in range(n):
        if core[i]:
            lab[i] = comp[i]
        else:
            c = comp[nb[i] & core]
            lab[i] = c.min() if len(c) else -1
    ids = sorted(set(lab[lab >= 0]))
    remap = {c: k for k, c in enumerate(ids)}
    return np.array([remap.get(c, -1) for c in lab]), core


def test_dbscan_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    X = np.vstack([rng.normal(0, 0.3, (60, 2)), rng.normal(3, 0.3, (60, 2)),
                   rng.uniform(-2, 5, (20, 2)), [[0.1, 0.1], [0.1, 0.1]]])
    want, _ = np_dbscan(X, 0.5, 5)
    out = dbscan(_frame(spark, X), "id", ["f0", "f1"], 0.5, 5, block_rows=32)
    got = dict(out.select("id", "prediction").collect())
    assert [got[i] for i in range(len(X))] == list(want)


def test_dbscan_weights_count_as_copies(spark):
    X = np.array([[0.0, 0.0], [0.1, 0.0], [5.0, 5.0]])
    w = np.array([3.0, 1.0, 1.0])
    out = dbscan(_frame(spark, X, weights=w), "id", ["f0", "f1"], 0.5, 4, weight="w",
                 block_rows=2)
    got = dict(out.select("id", "prediction").collect())
    assert got == {0: 0, 1: 0, 2: -1}


def np_loglik(X, m):
    lw = np.log(m.weights)[None] - 0.5 * (X.shape[1] * math.log(2 * math.pi)
                                          + np.log(m.variances).sum(1))[None] \
        - 0.5 * (((X[:, None, :] - m.means[None]) ** 2) / m.variances[None]).sum(-1)
    mx = lw.max(1, keepdims=True)
    return float((mx[:, 0] + np.log(np.exp(lw - mx).sum(1))).sum())


def test_gmm_loglik_and_monotone_em(spark):
    rng = np.random.default_rng(4)
    X = np.vstack([rng.normal(0, 1, (80, 2)), rng.normal(5, 0.5, (80, 2))])
    df = _frame(spark, X).cache()
    feats = ["f0", "f1"]
    m = G.fit_diagonal_mixture(df, feats, 2, reg=1e-6, max_iter=1)
    lls = []
    for _ in range(5):
        N, S, Q, ll, n = G.sufficient_stats(df, feats, m)
        assert ll == pytest.approx(np_loglik(X, m), rel=1e-10)
        lls.append(ll)
        m = G.m_step(N, S, Q, n, 1e-6)
    assert all(b >= a - 1e-9 for a, b in zip(lls, lls[1:]))
    full = G.fit_diagonal_mixture(df, feats, 2, reg=1e-6)
    labels = G.predict(df, feats, full).select("id", "prediction").collect()
    groups = {}
    for i, p in labels:
        groups.setdefault(i < 80, set()).add(p)
    assert len(groups[True]) == 1 and len(groups[False]) == 1 and groups[True] != groups[False]


def test_bic_parameter_count():
    assert K.n_parameters(10, 14, "diag") == 2 * 10 * 14 + 10 - 1
    assert K.bic(-100.0, 50, 2, 3) == pytest.approx(200 + (2 * 2 * 3 + 1) * math.log(50))


def test_kmeans_restarts_keep_lowest_cost(spark):
    rng = np.random.default_rng(5)
    X = np.vstack([rng.normal(0, 0.2, (30, 2)), rng.normal(3, 0.2, (30, 2))])
    res = fit_kmeans(_frame(spark, X), ["f0", "f1"], 2, n_init=3)
    preds = dict(res["predictions"].select("id", "prediction").collect())
    assert len({preds[i] for i in range(30)}) == 1
    assert {preds[i] for i in range(30)} != {preds[i] for i in range(30, 60)}


def test_ward_and_birch_separate_blobs(spark):
    cents = np.array([[0, 0], [0.1, 0], [5, 5], [5.1, 5], [10, 0]])
    lab = ward_labels(cents, 3)
    assert lab[0] == lab[1] and lab[2] == lab[3] and len(set(lab)) == 3
    rng = np.random.default_rng(6)
    X = np.vstack([rng.normal(0, 0.1, (50, 2)), rng.normal(5, 0.1, (50, 2)),
                   rng.normal([10, 0], 0.1, (50, 2))])
    out = birch(_frame(spark, X), ["f0", "f1"], 0.5, 3)["predictions"]
    got = dict(out.select("id", "prediction").collect())
    parts = [{got[i] for i in range(s, s + 50)} for s in (0, 50, 100)]
    assert all(len(p) == 1 for p in parts) and len(set.union(*parts)) == 3


def test_birch_does_not_depend_on_layout_or_block(spark):
    rng = np.random.default_rng(8)
    X = np.vstack([rng.normal(c, 0.8, (150, 2)) for c in ([0, 0], [6, 0], [0, 7], [9, 9])])
    df = _frame(spark, X)
    got = []
    for parts, block in ((1, 2048), (7, 2048), (3, 16), (5, 40)):
        out = birch(df.repartition(parts), ["f0", "f1"], 0.4, 4, block=block)
        pred = dict(out["predictions"].select("id", "prediction").collect())
        groups = {}
        for i, p in pred.items():
            groups.setdefault(p, set()).add(i)
        got.append(sorted(map(sorted, groups.values())))
        assert len(groups) == 4 and len(pred) == len(X)
        assert out["summaries"].agg(F.sum("n")).first()[0] == len(X)
    assert got[0] == got[1] == got[2] == got[3]


def test_birch_keeps_its_threshold(spark):
    rng = np.random.default_rng(9)
    X = rng.uniform(0, 50, (500, 2))
    out = birch(_frame(spark, X), ["f0", "f1"], 0.5, 3, block=64)
    radius = out["summaries"].select(F.sqrt(F.greatest(F.lit(0.0), F.expr(
        "ss / n - c0 * c0 - c1 * c1"))).alias("r"))
    assert radius.count() > 64 and radius.agg(F.max("r")).first()[0] <= 0.5 + 1e-9
    assert out["predictions"].select("prediction").distinct().count() == 3


def test_birch_missing_values_and_empty_input(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (1, None, 1.0), (2, float("nan"), 0.0),
                                (3, 9.0, 9.0)], "id long, f0 double, f1 double")
    got = dict(birch(df, ["f0", "f1"], 0.5, 2)["predictions"].select("id", "prediction").collect())
    assert got[1] is None and got[2] is None and {got[0], got[3]} == {0, 1}
    assert birch(df.limit(0), ["f0", "f1"], 0.5, 2)["predictions"].count() == 0


def test_accuracy_and_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (4.0, 6.0)],
                               "label double, prediction double")
    r = K.regression_metrics(df).first()
    assert (r["mae"], r["mse"], r["rmse"]) == (0.5, 1.0, 1.0)
    assert r["r2"] == pytest.approx(0.2)
    assert K.accuracy(df).first()[0] == 0.75
    assert F is not None


def test_spherical_mixture_shares_variance(spark):
    rng = np.random.default_rng(7)
    X = np.vstack([rng.normal(0, [1, 3], (60, 2)), rng.normal(6, [1, 3], (60, 2))])
    m = G.fit_diagonal_mixture(_frame(spark, X), ["f0", "f1"], 2, covariance="spherical")
    assert np.allclose(m.variances[:, 0], m.variances[:, 1])
    with pytest.raises(NotImplementedError):
        G.m_step(np.ones(1), np.ones((1, 2)), np.ones((1, 2)), 1.0, 1e-6, "full")
