"""Clustering plan (query lifecycle C) on the cleaned accident table.

strict drop of 29 names (P2) -> 11 numeric + 2 boolean (as int) + one
prefixed dummy of Sunrise_Sunset, first dropped (P1, E3, P10) -> population
z-scores fitted on all rows (Z1) -> exactly 50,000 rows drawn with
replacement, kept as weighted distinct rows (X3) -> a model (C1-C4) ->
silhouette, Calinski-Harabasz, Davies-Bouldin (K1-K3) on the sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.operators.cluster.birch import birch
from tabloom.operators.cluster.dbscan import dbscan
from tabloom.operators.cluster.gmm import fit_diagonal_mixture, predict
from tabloom.operators.cluster.kmeans import fit_kmeans
from tabloom.operators.columns import col, drop_strict, select_columns
from tabloom.operators.encode import dummies, fit_categories
from tabloom.operators.rows import drop_rows_any_missing
from tabloom.operators.metrics import calinski_harabasz, davies_bouldin, silhouette
from tabloom.operators.scale import apply_scaler, fit_scaler
from tabloom.operators.resample import bootstrap_by_content
from tabloom.session import cut_lineage, stage

# Fixed values of the reference: the 29 names the clustering scripts drop,
# the 11 numeric and 2 boolean columns they keep, the dummy's column, the
# sample size and seed, and the tuned model parameters.
CLUSTER_DROP = [
    "Start_Time", "End_Time", "City", "County", "State", "Zipcode", "Country",
    "Timezone", "Airport_Code", "Wind_Direction", "Civil_Twilight",
    "Nautical_Twilight", "Astronomical_Twilight", "Amenity", "Bump", "Give_Way",
    "No_Exit", "Railway", "Roundabout", "Traffic_Calming", "Turning_Loop",
    "Weather_Condition", "Start_Lat", "Start_Lng", "Wind_Chill(C)", "Distance(km)", "Stop",
    "Junction", "Station"]
CLUSTER_NUMERIC = ["Severity", "Humidity(%)", "start_hour", "start_dayofweek", "start_month",
                   "duration_min", "Temperature(C)", "Wind_Speed(m/s)", "Visibility(km)",
                   "Precipitation(mm)", "Pressure(hPa)"]
CLUSTER_BOOL = ["Crossing", "Traffic_Signal"]
DUMMY_COLUMN = "Sunrise_Sunset"
SAMPLE_ROWS = 50_000
SEED = 42
ROWS_PER_PARTITION = 1000  # of the sample, at least
KMEANS = {"k": 9, "n_init": 24}
MIXTURE = {"k": 10, "covariance": "diag", "reg": 2.1852258861569966e-06}
DBSCAN = {"eps": 4.620325164403749, "min_samples": 17}
BIRCH = {"threshold": 2.8985317784980644, "branching_factor": 222, "n_clusters": 3}


def raw_features(processed: DataFrame) -> DataFrame:
    """The features before scaling.

    Rows with a missing kept feature are dropped: cleaning drops incomplete
    rows before the unit conversion, so text that is not a number still
    arrives here as a missing value, which no model accepts."""
    return _features(drop_strict(processed, CLUSTER_DROP))


def _features(reduced: DataFrame) -> DataFrame:
    cats = fit_categories(reduced, [DUMMY_COLUMN])
    dummy = dummies(cats, drop_first=True, prefix={DUMMY_COLUMN: DUMMY_COLUMN}, dtype="double")
    num = [col(c).cast("double").alias(c) for c in CLUSTER_NUMERIC]
    flags = [col(c).cast("int").cast("double").alias(c) for c in CLUSTER_BOOL]
    return drop_rows_any_missing(reduced.select(*num, *flags, *dummy))


def cluster_features(processed: DataFrame):
    """(scaled feature frame, feature names)."""
    frame = raw_features(processed)
    return apply_scaler(frame, fit_scaler(frame, frame.columns)), frame.columns


def cluster_sample(processed: DataFrame, n: int = SAMPLE_ROWS, seed: int = SEED):
    """(weighted sample with row_id, weight, features; feature names).

    The scaler is fitted on all rows, as in the reference; the sample is drawn
    by the rows' contents before scaling, so it does not depend on partitions.
    The columns that the features come from are staged once, as parquet: the
    categories, the counts, the drawn rows and the scaler each read them.  The
    sample lies in a number of partitions that does not grow with the input,
    as every round of a model pays for each of them.
    """
    reduced = drop_strict(processed, CLUSTER_DROP)
    used = [*CLUSTER_NUMERIC, *CLUSTER_BOOL, DUMMY_COLUMN]
    frame = _features(stage(select_columns(reduced, used), "cluster-input"))
    names = frame.columns
    sample = bootstrap_by_content(frame, n, seed=seed, row_id="row_id")
    parts = min(processed.sparkSession.sparkContext.defaultParallelism,
                max(1, n // ROWS_PER_PARTITION))
    sample = sample.repartition(parts, "row_id")
    return cut_lineage(apply_scaler(sample, fit_scaler(frame, names))), names


def scores(labelled: DataFrame, names: list[str], model: str, label: str = "prediction",
           weight: str = "weight") -> DataFrame:
    """One row: model, clusters found (noise excluded), K1-K3 on the sample."""
    spark = labelled.sparkSession
    n_clusters = labelled.filter(col(label) >= 0).select(label).distinct().count()
    labels = labelled.select(label).distinct().count()
    if labels < 2:
        sil = ch = db = None
    else:
        sil = silhouette(labelled, "row_id", names, label, weight).first()[0]
        ch = calinski_harabasz(labelled, names, label, weight).first()[0]
        db = davies_bouldin(labelled, names, label, weight).first()[0]
    return spark.createDataFrame(
        [(model, int(n_clusters), sil, ch, db)],
        "model string, n_clusters int, silhouette double, calinski_harabasz double, "
        "davies_bouldin double")


def run_model(sample: DataFrame, names: list[str], model: str, params: dict | None = None):
    """Labels of one model on the weighted sample (column ``prediction``)."""
    if model == "kmeans":
        p = {**KMEANS, **(params or {})}
        return fit_kmeans(sample, names, p["k"], n_init=p["n_init"], seed=SEED,
                          weight="weight")["predictions"]
    if model == "gmm":
        p = {**MIXTURE, **(params or {})}
        m = fit_diagonal_mixture(sample, names, p["k"], reg=p["reg"], seed=SEED,
                                 weight="weight", covariance=p["covariance"])
        return predict(sample, names, m)
    if model == "dbscan":
        p = {**DBSCAN, **(params or {})}
        return dbscan(sample, "row_id", names, p["eps"], p["min_samples"], weight="weight")
    if model == "birch":
        p = {**BIRCH, **(params or {})}
        return birch(sample, names, p["threshold"], p["n_clusters"], weight="weight")["predictions"]
    raise ValueError(model)


def clustering_sample(spark: SparkSession, sf_dir: str):
    """The checkpointed sample of the accident stand-in, as the reference's
    four clustering scripts each build it."""
    from tabloom.plans import standins as S
    from tabloom.plans.cleaning import clean_accidents
    return cluster_sample(clean_accidents(S.accidents(spark, sf_dir)))
