"""Registered queries for clustering models and clustering metrics.

K1-K4 run on ``embeddings`` with its given labels and have DuckDB oracles;
the models run on the 50,000-row weighted bootstrap sample of the cleaned
accident table (lifecycle C) and are checked by row counts and tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import metrics as K
from tabloom.operators.columns import col
from tabloom.operators.cluster.gmm import (fit_diagonal_mixture, init_from_labels,
                                           log_likelihood)
from tabloom.operators.sweep import (SPACES, random_trials, sweep_birch, sweep_dbscan,
                                     sweep_kmeans, sweep_mixtures)
from tabloom.plans import clustering as C
from tabloom.plans import standins as S
from tabloom.plans.q_tabular import CLEAN_WITH
from tabloom.plans.registry import register

_UNNEST = ("SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, "
           "generate_subscripts(embedding, 1) AS dim FROM embeddings")


def _emb(spark, sf):
    """(table with one column per dimension, names of those columns)"""
    dims = S.vector_width(spark, sf)
    return S.embeddings(spark, sf, dims), S.embedding_columns(dims)


@register("k1_silhouette", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (SELECT a.vec_id AS i, a.label AS li, b.label AS lj, list_distance(a.v, b.v) AS d
          FROM e a, e b),
per AS (SELECT i, li, lj, sum(d) AS s, count(*) AS c FROM pairs GROUP BY i, li, lj),
ab AS (SELECT i, max(CASE WHEN lj = li THEN c END) AS c_own,
              max(CASE WHEN lj = li AND c > 1 THEN s / (c - 1) END) AS a,
              min(CASE WHEN lj <> li THEN s / c END) AS b FROM per GROUP BY i)
SELECT round(avg(CASE WHEN c_own <= 1 OR b IS NULL THEN 0.0
                      WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0 END), 6)
       AS silhouette FROM ab""")
def _k1(spark, sf):
    df, dims = _emb(spark, sf)
    return K.silhouette(df, "vec_id", dims, "label").select(
        F.round("silhouette", 6).alias("silhouette"))


_CENT = f"""e AS ({_UNNEST}),
c AS (SELECT label, dim, avg(x) AS cx, count(*) AS nk FROM e GROUP BY label, dim)"""


@register("k2_calinski_harabasz", f"""
WITH {_CENT},
g AS (SELECT dim, avg(x) AS gx FROM e GROUP BY dim),
b AS (SELECT sum(c.nk * (c.cx - g.gx) * (c.cx - g.gx)) AS between_ss FROM c JOIN g USING (dim)),
w AS (SELECT sum((e.x - c.cx) * (e.x - c.cx)) AS within_ss FROM e JOIN c USING (label, dim)),
k AS (SELECT count(DISTINCT label) AS k, count(*) AS n FROM embeddings)
SELECT round(CASE WHEN within_ss = 0 THEN 1.0
                  ELSE (between_ss / (k - 1)) / (within_ss / (n - k)) END, 6) AS calinski_harabasz
FROM b, w, k""")
def _k2(spark, sf):
    df, dims = _emb(spark, sf)
    return K.calinski_harabasz(df, dims, "label").select(
        F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


@register("k3_davies_bouldin", f"""
WITH {_CENT},
pd AS (SELECT e.vec_id, e.label, sqrt(sum((e.x - c.cx) * (e.x - c.cx))) AS dist
       FROM e JOIN c USING (label, dim) GROUP BY e.vec_id, e.label),
s AS (SELECT label, avg(dist) AS s FROM pd GROUP BY label),
dd AS (SELECT a.label AS i, b.label AS j, sqrt(sum((a.cx - b.cx) * (a.cx - b.cx))) AS d
       FROM c a JOIN c b ON a.dim = b.dim AND a.label <> b.label GROUP BY a.label, b.label),
r AS (SELECT dd.i, max((si.s + sj.s) / dd.d) AS r
      FROM dd JOIN s si ON si.label = dd.i JOIN s sj ON sj.label = dd.j GROUP BY dd.i)
SELECT round(avg(r), 6) AS davies_bouldin FROM r""")
def _k3(spark, sf):
    df, dims = _emb(spark, sf)
    return K.davies_bouldin(df, dims, "label").select(
        F.round("davies_bouldin", 6).alias("davies_bouldin"))


K4_REG = 1e-6


@register("k4_bic_label_mixture", f"""
WITH e AS ({_UNNEST}),
n AS (SELECT count(*) AS n FROM embeddings),
p AS (SELECT label, count(*) / (SELECT n FROM n) AS w FROM embeddings GROUP BY label),
c AS (SELECT label, dim, avg(x) AS mu, avg(x * x) - avg(x) * avg(x) + {K4_REG!r} AS var
      FROM e GROUP BY label, dim),
lp AS (SELECT e.vec_id, c.label AS j,
              sum(-0.5 * (ln(2 * pi()) + ln(c.var) + (e.x - c.mu) * (e.x - c.mu) / c.var)) AS lq
       FROM e JOIN c ON e.dim = c.dim GROUP BY e.vec_id, c.label),
lw AS (SELECT lp.vec_id, lp.lq + ln(p.w) AS l FROM lp JOIN p ON p.label = lp.j),
mx AS (SELECT vec_id, max(l) AS m FROM lw GROUP BY vec_id),
lse AS (SELECT lw.vec_id, mx.m + ln(sum(exp(lw.l - mx.m))) AS v FROM lw JOIN mx USING (vec_id)
        GROUP BY lw.vec_id, mx.m),
k AS (SELECT count(DISTINCT label) AS k FROM embeddings)
SELECT round(sum(v), 4) AS log_likelihood,
       round(-2 * sum(v) + (2 * k * (SELECT max(len(embedding)) FROM embeddings) + k - 1) * ln((SELECT n FROM n)), 4) AS bic
FROM lse, k GROUP BY k""")
def _k4(spark, sf):
    """BIC of the diagonal mixture whose components are the given labels."""
    df, dims = _emb(spark, sf)
    k = df.select("label").distinct().count()
    m = init_from_labels(df, dims, "label", k, K4_REG)
    row = log_likelihood(df, dims, m).first()
    ll, n = row["log_likelihood"], row["n"]
    return spark.createDataFrame(
        [(round(ll, 4), round(K.bic(ll, n, k, len(dims), "diag"), 4))],
        "log_likelihood double, bic double")


# ------------------------------------------------------------------ models
def _features_sql() -> str:
    num = [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in C.CLUSTER_NUMERIC]
    num += [f'CAST("{c}" AS INTEGER)::DOUBLE AS "{c}"' for c in C.CLUSTER_BOOL]
    night = f"{C.DUMMY_COLUMN}_Night"
    num.append(f"""CASE WHEN "{C.DUMMY_COLUMN}" = 'Night' THEN 1.0 ELSE 0.0 END::DOUBLE AS "{night}" """)
    names = [*C.CLUSTER_NUMERIC, *C.CLUSTER_BOOL, night]
    scaled = ", ".join(
        f'round(("{c}" - avg("{c}") OVER ()) / CASE WHEN stddev_pop("{c}") OVER () = 0 THEN 1 '
        f'ELSE stddev_pop("{c}") OVER () END, 6) AS "{c}"' for c in names)
    return (CLEAN_WITH + f", f AS (SELECT {', '.join(num)} FROM c), "
            f"g AS (SELECT * FROM f WHERE COLUMNS(*) IS NOT NULL) SELECT {scaled} FROM g")


@register("cluster_features", _features_sql())
def _cf(spark, sf):
    """P2, P1, E3, P10, Z1 on the cleaned accident table."""
    from tabloom.plans.cleaning import clean_accidents
    frame, names = C.cluster_features(clean_accidents(S.accidents(spark, sf)))
    return frame.select(*[F.round(col(c), 6).alias(c) for c in names])


@register("cluster_sample")
def _cs(spark, sf):
    """The 50,000-row weighted bootstrap of the scaled features."""
    return C.clustering_sample(spark, sf)[0]


def _model_query(name: str, model: str):
    @register(name)
    def _q(spark, sf):
        sample, names = C.clustering_sample(spark, sf)
        return C.run_model(sample, names, model).select("row_id", "weight", "prediction")
    _q.__doc__ = f"{model} labels of the weighted 50,000-row accident sample."
    return _q


_model_query("c1_kmeans", "kmeans")
_model_query("c2_gaussian_mixture", "gmm")
_model_query("c3_dbscan", "dbscan")
_model_query("c4_birch", "birch")


def _score_query(name: str, model: str):
    @register(name)
    def _q(spark, sf):
        sample, names = C.clustering_sample(spark, sf)
        labelled = C.run_model(sample, names, model)
        return C.scores(labelled, names, model)
    _q.__doc__ = f"K1-K3 of {model} on the weighted accident sample."
    return _q


_score_query("kmeans_scores", "kmeans")
_score_query("gmm_scores", "gmm")
_score_query("dbscan_scores", "dbscan")
_score_query("birch_scores", "birch")


def _sweep_query(name: str, model: str, n_trials: int, run):
    @register(name)
    def _q(spark, sf):
        sample, names = C.clustering_sample(spark, sf)
        trials = random_trials(SPACES[model], n_trials, seed=C.SEED)
        return run(sample, names, trials)
    _q.__doc__ = (f"{n_trials} seeded random trials of the {model} space on the weighted "
                  "accident sample, all in shared passes.")
    return _q


# Fixed values of the reference: 40 trials by silhouette (-1 for fewer than 2
# clusters), 50 mixtures by BIC.
_sweep_query("h1_sweep_kmeans", "kmeans", 40, lambda sample, names, trials: sweep_kmeans(
    sample, "row_id", names, trials, C.SEED, "weight"))
_sweep_query("h1_sweep_birch", "birch", 40, lambda sample, names, trials: sweep_birch(
    sample, "row_id", names, trials, "weight"))
_sweep_query("h1_sweep_dbscan", "dbscan", 40, lambda sample, names, trials: sweep_dbscan(
    sample, "row_id", names, trials, "weight"))
_sweep_query("h1_sweep_gmm", "gmm", 50, lambda sample, names, trials: sweep_mixtures(
    sample, names, trials, C.SEED, "weight"))


@register("k4_gmm_bic")
def _k4_fit(spark, sf):
    """BIC of the tuned diagonal mixture fitted on the weighted accident
    sample (the reference's mixture search objective)."""
    sample, names = C.clustering_sample(spark, sf)
    p = C.MIXTURE
    m = fit_diagonal_mixture(sample, names, p["k"], reg=p["reg"], seed=C.SEED,
                             weight="weight", covariance=p["covariance"])
    return spark.createDataFrame(
        [(p["k"], p["covariance"], m.n_iter, bool(m.converged), float(m.log_likelihood),
          float(K.bic(m.log_likelihood, m.n, p["k"], len(names), p["covariance"])))],
        "k int, covariance string, n_iter int, converged boolean, log_likelihood double, "
        "bic double")
