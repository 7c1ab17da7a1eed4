"""Registered sweeps and lifecycles run the reference's whole job."""
import numpy as np
import pytest

from tabloom.operators.cluster.gmm_full import fit_full_mixture, predict_full
from tabloom.operators import sweep
from tabloom.operators.sweep import SPACES, random_trials
from tabloom.plans import classification, q_cluster, q_models, registry


def crash_rows(n=240, seed=3):
    """Crashes whose targets follow a feature, with noise and missing values."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        w, l = rng.choice(["CLEAR", "RAIN", None], 2)
        pick = lambda a, b: str(a if (w == "RAIN") ^ (rng.random() < 0.1) else b)
        out.append((i, None if w is None else str(w), None if l is None else str(l),
                    pick("S", "C"), pick("I", "N"), pick("$1", "$2"),
                    None if i % 9 == 0 else pick("NONE", "LIGHT"), pick("REAR", "TURN"),
                    int(rng.integers(0, 4))))
    return out


CRASH_COLUMNS = ("crash_id long, weather_condition string, lighting_condition string, "
                 "alignment string, crash_type string, damage string, "
                 "traffic_control_device string, first_crash_type string, injuries_total int")


@pytest.mark.parametrize("name", ["g5_target_sweep", "impute_then_classify"])
def test_every_target_and_model(spark, monkeypatch, name):
    registry.load_all()
    frame = spark.createDataFrame(crash_rows(), CRASH_COLUMNS)
    monkeypatch.setattr(q_models, "prepared_crashes", lambda *a: frame)
    monkeypatch.setattr(q_models, "impute_crashes", lambda *a: frame)
    monkeypatch.setattr(classification, "N_TREES", 12)
    got = {(r["target"], r["model"]): r["accuracy"]
           for r in registry.QUERIES[name](spark, "unused").collect()}
    want = {(t, m) for t in classification.TARGETS for m in ("entropy", "gini", "forest")}
    assert len(classification.TARGETS) == 5 and set(got) == want
    assert all(0.5 < a <= 1 for a in got.values())


def blob_sample(spark, n=90):
    rng = np.random.default_rng(8)
    x = np.r_[rng.normal(0, 0.4, (n, 3)), rng.normal(4, 0.4, (n, 3)), rng.normal([8, 0, 4], 0.4, (n, 3))]
    rows = [(i, float(1 + i % 3), *map(float, v)) for i, v in enumerate(x)]
    names = ["f0", "f1", "f2"]
    return spark.createDataFrame(rows, "row_id long, weight double, f0 double, f1 double, f2 double"
                                 ).repartition(3), names


@pytest.mark.parametrize("model,trials", [("kmeans", 40), ("birch", 40), ("dbscan", 40), ("gmm", 50)])
def test_every_trial_is_a_real_fit(spark, monkeypatch, model, trials):
    registry.load_all()
    sample, names = blob_sample(spark)
    monkeypatch.setattr(q_cluster.C, "clustering_sample", lambda *a: (sample, names))
    got = registry.QUERIES[f"h1_sweep_{model}"](spark, "unused").orderBy("trial").collect()
    assert len(got) == trials and sum(r["best"] for r in got) == 1
    pick = min if model == "gmm" else max
    assert next(r["score"] for r in got if r["best"]) == pick(r["score"] for r in got)
    # a trial of its own gives the same row
    space = random_trials(SPACES[model], trials, seed=42)
    single = {"kmeans": lambda t: sweep.sweep_kmeans(sample, "row_id", names, [t], 42, "weight"),
              "birch": lambda t: sweep.sweep_birch(sample, "row_id", names, [t], "weight"),
              "dbscan": lambda t: sweep.sweep_dbscan(sample, "row_id", names, [t], "weight"),
              "gmm": lambda t: sweep.sweep_mixtures(sample, names, [t], 42, "weight")}[model]
    for i in (0, trials - 1):
        alone = single(space[i]).first()
        assert alone["n_clusters"] == got[i]["n_clusters"]
        assert alone["score"] == pytest.approx(got[i]["score"], rel=1e-9)


@pytest.mark.parametrize("covariance", ["full", "tied"])
def test_full_mixture_by_brute_force(spark, covariance):
    rng = np.random.default_rng(4)
    x = np.r_[rng.multivariate_normal([0, 0], [[2, 1.5], [1.5, 2]], 300),
              rng.multivariate_normal([9, 3], [[1, -0.6], [-0.6, 1]], 200)]
    lab = (x[:, 0] > 5).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, lab)],
                               "f0 double, f1 double, lab int")
    m = fit_full_mixture(df, ["f0", "f1"], 2, reg=1e-3, init_label="lab", covariance=covariance,
                         tol=0.0, max_iter=3)
    w, mu, cov = None, None, None
    r = np.eye(2)[lab]

    def density(w, mu, cov):
        return np.stack([w[j] * np.exp(-0.5 * np.einsum(
            "ni,ij,nj->n", x - mu[j], np.linalg.inv(cov[j]), x - mu[j]))
            / (2 * np.pi * np.sqrt(np.linalg.det(cov[j]))) for j in range(2)], axis=1)

    for step in range(4):       # the start and three rounds
        n = r.sum(axis=0)
        w, mu = n / len(x), (r.T @ x) / n[:, None]
        cov = [(r[:, j, None] * (x - mu[j])).T @ (x - mu[j]) / n[j] for j in range(2)]
        if covariance == "tied":
            cov = [sum(n[j] * cov[j] for j in range(2)) / len(x)] * 2
        cov = [c + 1e-3 * np.eye(2) for c in cov]
        p = density(w, mu, cov)
        r = p / p.sum(axis=1, keepdims=True)
    assert np.allclose(m.means, mu) and np.allclose(m.covariances, cov) and np.allclose(m.weights, w)
    assert m.log_likelihood == pytest.approx(np.log(p.sum(axis=1)).sum())
    got = [q["prediction"] for q in predict_full(df, ["f0", "f1"], m).collect()]
    assert np.mean(np.array(got) == lab) > 0.99
