"""Least-squares plans (query lifecycle B).

``duration_regression`` runs the lifecycle on the accident table: lenient
dates (D3) -> rows with both (F3) -> minutes (D6) in the open range 0..240
(F4) -> drop eleven text columns (P3) -> date parts of the start (D8) ->
leakage guard (P12) -> the steps below.  ``price_regression`` runs the steps
below on the price frame:

features (target dropped) -> one-hot, first category dropped (E2) ->
exact median imputation (N2, fitted on all rows as the reference does) ->
exact 80/20 split by key hash (X1) -> population z-scores fitted on train
(Z1) -> least squares (R1) -> coefficient table (R2, T1, T2) -> test
predictions -> R², MAE, MSE, RMSE and verdict (V2-V5).

The dummies are slots of one sparse vector, so their number has no limit;
scaling is applied to the weights, not to the rows, and collinear dummies get
the weights of least norm (``operators/least_squares``).  Jobs: category
list, medians (of the numeric columns; a dummy is never missing), split cut,
moments, products, metrics -- each an aggregate with small output.  The
encoded frame is checkpointed once because every later step reads it.
``encoded_frame`` and ``fit_and_score`` are the form with a column per dummy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.functions.dates import duration_minutes, expand_date_parts, lenient_parse
from tabloom.operators.columns import col, drop_tolerant, leakage_guard, string_columns
from tabloom.operators.encode import (assemble, dummy_names, fit_categories, get_dummies,
                                      one_hot_vector, slot_names)
from tabloom.operators.least_squares import fit_least_norm, predict_linear
from tabloom.operators.metrics import fit_verdict, regression_metrics
from tabloom.operators.missing import fill_values, fit_medians
from tabloom.operators.rows import drop_rows_any_missing, open_range
from tabloom.operators.scale import apply_scaler, fit_scaler
from tabloom.operators.split import split_exact, train_test
from tabloom.operators.supervised import coefficient_table, fit_linear
from tabloom.plans import standins as S
from tabloom.session import cut_lineage

PRICE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
NUMERIC = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
CATEGORICAL = ["p_type", "l_returnflag"]
TARGET = "l_extendedprice"


# Fixed values of the reference: the text columns dropped before the fit, and
# the range of durations (minutes, both ends excluded) that it keeps.
LONG_TEXT = ["ID", "Description", "Street", "City", "Timezone", "Airport_Code", "Zipcode",
             "Weather_Timestamp", "County", "State", "Country"]
DURATION_RANGE = (0, 240)
DURATION = "Duration_min"
ACCIDENT_KEY = "row_key"  # a copy of the id; never a feature


def encoded_frame(df: DataFrame, keys: list[str], target: str, numeric: list[str],
                  categorical: list[str]):
    """(encoded + imputed frame with split flag, feature names)."""
    cats = fit_categories(df, categorical)
    kept = df.select(*[col(c) for c in keys], *[col(c).cast("double").alias(c) for c in numeric],
                     *[col(c) for c in categorical], col(target))
    enc = get_dummies(kept, categorical, drop_first=True, categories=cats, dtype="double")
    names = numeric + dummy_names(cats, drop_first=True)
    enc = fill_values(enc, fit_medians(enc, numeric))
    return split_exact(enc, keys, seed=42, train_size=0.8), names


def regression_frame(df: DataFrame):
    """The price frame, encoded; see ``encoded_frame``."""
    return encoded_frame(df, PRICE_KEYS, TARGET, NUMERIC, CATEGORICAL)


def duration_frame(accidents: DataFrame) -> DataFrame:
    """Key, target and leakage-free features of the raw accident table."""
    df = accidents.withColumns({
        "Start_Time": lenient_parse("Start_Time"), "End_Time": lenient_parse("End_Time"),
        ACCIDENT_KEY: col("ID")})
    df = drop_rows_any_missing(df, ["Start_Time", "End_Time"])
    df = open_range(df.withColumn(DURATION, duration_minutes("Start_Time", "End_Time")),
                    DURATION, *DURATION_RANGE)
    df = expand_date_parts(drop_tolerant(df, LONG_TEXT), "Start_Time")
    features = leakage_guard(df, DURATION)[0].columns
    return df.select(*[col(c) for c in features], col(DURATION))


def fit_and_score(frame: DataFrame, names: list[str], keys: list[str], target: str) -> dict:
    """Scaling fitted on train, least squares, and the scores on test."""
    spark = frame.sparkSession
    frame = cut_lineage(frame)
    train, test = train_test(frame)
    stats = fit_scaler(train, names)
    train_v = assemble(apply_scaler(train, stats), names)
    test_v = assemble(apply_scaler(test, stats), names)
    model = fit_linear(train_v, label=target)
    coefs = coefficient_table(spark, names, list(model.coefficients), k=10)
    preds = model.transform(test_v).select(*[col(k) for k in keys], col(target).alias("label"),
                                           "prediction")
    metrics = fit_verdict(regression_metrics(preds, "label", "prediction"))
    return {"metrics": metrics, "coefficients": coefs, "predictions": preds,
            "intercept": float(model.intercept)}


def sparse_frame(df: DataFrame, keys: list[str], target: str, numeric: list[str],
                 categorical: list[str]):
    """(frame of keys, target, split flag and one sparse vector ``features``;
    its slot names): E2 with any number of categories, N2, X1."""
    kept = df.select(*[col(c) for c in keys], *[col(c).cast("double").alias(c) for c in numeric],
                     *[col(c) for c in categorical], col(target))
    kept = fill_values(kept, fit_medians(kept, numeric))
    enc = one_hot_vector(kept, categorical, numeric, drop_first=True)
    names = slot_names(enc, categorical)
    return split_exact(enc.select(*[col(c) for c in keys], col(target), "features"),
                       keys, seed=42, train_size=0.8), names


def score_sparse(frame: DataFrame, names: list[str], keys: list[str], target: str) -> dict:
    """Least squares of least norm on scaled train features (Z1, R1), the
    coefficient table, and the scores on test."""
    spark = frame.sparkSession
    frame = cut_lineage(frame)
    train, test = train_test(frame)
    fit = fit_least_norm(train, len(names), label=target)
    preds = predict_linear(test, fit).select(*[col(k) for k in keys], col(target).alias("label"),
                                             "prediction")
    return {"metrics": fit_verdict(regression_metrics(preds, "label", "prediction")),
            "coefficients": coefficient_table(spark, names, list(fit.coefficients), k=10),
            "predictions": preds, "intercept": fit.intercept, "fit": fit}


def price_regression(spark: SparkSession, sf_dir: str) -> dict:
    frame, names = sparse_frame(S.prices(spark, sf_dir), PRICE_KEYS, TARGET, NUMERIC, CATEGORICAL)
    return score_sparse(frame, names, PRICE_KEYS, TARGET)


def duration_regression(accidents: DataFrame) -> dict:
    """Lifecycle B: every string column becomes dummies, every other a number.

    The parsed frame is checkpointed: categories, medians and the split each
    read it several times."""
    df = cut_lineage(duration_frame(accidents))
    text = [c for c in string_columns(df) if c != ACCIDENT_KEY]
    numeric = [c for c in df.columns if c not in (*text, ACCIDENT_KEY, DURATION)]
    frame, names = sparse_frame(df, [ACCIDENT_KEY], DURATION, numeric, text)
    return score_sparse(frame, names, [ACCIDENT_KEY], DURATION)
