"""Registered queries for encoding, splitting, scaling, supervised models
and their metrics (E*, X*, Z1, R*, G*, N3, V*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import encode as E
from tabloom.operators import metrics as V
from tabloom.operators import split as X
from tabloom.operators.scale import standard_scale
from tabloom.plans import standins as S
from tabloom.plans.classification import (TARGETS, classify_crashes, impute_crashes,
                                          prepared_crashes, target_sweep)
from tabloom.plans.q_tabular import (CRASH, LENIENT_BOTH, N1_CRASH, _with, crashes_n1, dq,
                                     normal_sql)
from tabloom.plans.regression import (LONG_TEXT, PRICE_KEYS, duration_frame,
                                      duration_regression, price_regression)
from tabloom.plans.registry import register
from tabloom.session import cut_lineage

PRICES = S.duck_standin(S.PRICES_SQL)
EVT = S.duck_standin(S.EVENTS_SQL)

# Categories the crash stand-in can produce (read off its CASE expressions).
CRASH_CATEGORIES = {
    "weather_condition": ["CLEAR", "RAIN"],
    "lighting_condition": [" UNKNOWN", "DARKNESS", "DAYLIGHT"],
    "damage": ["$500 OR LESS", "$501 - $1,500", "OVER $1,500"],
}
ONEHOT_COLS = list(CRASH_CATEGORIES)
ONEHOT_KEEP = ["crash_id", "injuries_total", "road_defect"]


def _sql_dummies(drop_first=False, prefix=None):
    out = []
    for c, values in CRASH_CATEGORIES.items():
        p = (prefix or {}).get(c, c)
        for v in (values[1:] if drop_first else values):
            lit = v.replace("'", "''")
            out.append(f"CAST(CASE WHEN {c} = '{lit}' THEN 1 ELSE 0 END AS INTEGER) AS {dq(p + '_' + v)}")
    return ", ".join(out)


def _onehot_input(spark, sf):
    return crashes_n1(spark, sf).select(*ONEHOT_KEEP, *ONEHOT_COLS)


# ----------------------------------------------------------------- encoding
@register("e1_one_hot_all", _with(cr=CRASH, n=N1_CRASH)
          + f"SELECT {', '.join(ONEHOT_KEEP)}, {_sql_dummies()} FROM n")
def _e1(spark, sf):
    return E.get_dummies(_onehot_input(spark, sf), ONEHOT_COLS)


@register("e2_one_hot_drop_first", _with(cr=CRASH, n=N1_CRASH)
          + f"SELECT {', '.join(ONEHOT_KEEP)}, {_sql_dummies(drop_first=True)} FROM n")
def _e2(spark, sf):
    return E.get_dummies(_onehot_input(spark, sf), ONEHOT_COLS, drop_first=True)


@register("e3_prefixed_dummies", _with(a=S.duck_standin(S.ACCIDENTS_SQL))
          + """SELECT "ID", CAST(CASE WHEN "Sunrise_Sunset" = 'Night' THEN 1 ELSE 0 END AS INTEGER)
          AS "Sunrise_Sunset_Night" FROM a""")
def _e3(spark, sf):
    df = S.accidents(spark, sf).select("ID", "Sunrise_Sunset")
    return E.get_dummies(df, ["Sunrise_Sunset"], drop_first=True,
                         prefix={"Sunrise_Sunset": "Sunrise_Sunset"})


@register("e4_label_codes", _with(cr=CRASH, n=N1_CRASH)
          + "SELECT crash_id, traffic_control_device, CAST(CASE WHEN traffic_control_device IS NULL "
            "THEN -1 ELSE dense_rank() OVER (PARTITION BY traffic_control_device IS NULL "
            "ORDER BY traffic_control_device) - 1 END AS INTEGER) AS code FROM n")
def _e4(spark, sf):
    df = crashes_n1(spark, sf).select("crash_id", "traffic_control_device")
    return E.encode_labels(df, "traffic_control_device")


@register("e5_feature_names", _with(
    cr=CRASH, n=N1_CRASH,
    names="SELECT 0 AS grp, 'injuries_total' AS name UNION ALL "
          "SELECT 1, 'injuries_fatal' UNION ALL "
          "SELECT DISTINCT 2, 'weather_condition_' || weather_condition FROM n "
          "WHERE weather_condition IS NOT NULL UNION ALL "
          "SELECT DISTINCT 3, 'damage_' || damage FROM n WHERE damage IS NOT NULL")
    + "SELECT CAST(row_number() OVER (ORDER BY grp, name) - 1 AS INTEGER) AS idx, "
      "name AS feature FROM names")
def _e5(spark, sf):
    df = crashes_n1(spark, sf).select("injuries_total", "injuries_fatal",
                                      "weather_condition", "damage")
    enc = E.get_dummies(df, ["weather_condition", "damage"], dtype="double")
    vec = E.assemble(enc, enc.columns)
    names = E.feature_names(vec)
    return spark.createDataFrame(list(enumerate(names)), "idx int, feature string")


# ---------------------------------------------------------------- splitting
_KEYS_SQL = ", ".join(f"CAST({k} AS VARCHAR)" for k in PRICE_KEYS)


def _md5_prefix(digits: int) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {_KEYS_SQL}, '42')), 1, {digits}))::BIGINT"


@register("x1_split_hash", _with(pr=PRICES)
          + f"SELECT {', '.join(PRICE_KEYS)}, {_md5_prefix(8)} / 4294967296.0 < 0.8 AS is_train "
            "FROM pr")
def _x1(spark, sf):
    df = S.prices(spark, sf).select(*PRICE_KEYS)
    return X.split_hash(df, PRICE_KEYS, seed=42, train_frac=0.8)


@register("x1_split_exact", _with(pr=PRICES, h=f"SELECT *, {_md5_prefix(13)} AS h FROM pr")
          + f"SELECT {', '.join(PRICE_KEYS)}, row_number() OVER (ORDER BY h, "
            f"{', '.join(PRICE_KEYS)}) <= floor(0.8 * count(*) OVER ()) AS is_train FROM h")
def _x1e(spark, sf):
    df = S.prices(spark, sf).select(*PRICE_KEYS)
    return X.split_exact(df, PRICE_KEYS, seed=42, train_size=0.8)


@register("x2_split_target", _with(pr=PRICES) + "SELECT * EXCLUDE (l_extendedprice) FROM pr")
def _x2(spark, sf):
    return X.split_target(S.prices(spark, sf), "l_extendedprice")[0]


@register("x3_bootstrap", """
WITH r AS (SELECT vec_id, label, row_number() OVER (ORDER BY md5(vec_id || '|42'), vec_id) - 1 AS rank
           FROM embeddings),
d AS (SELECT ('0x' || substr(md5(i || ':42'), 1, 13))::BIGINT % (SELECT count(*) FROM r) AS rank
      FROM range(50000) t(i))
SELECT vec_id, label, count(*) AS weight FROM d JOIN r USING (rank) GROUP BY vec_id, label""")
def _x3(spark, sf):
    """Exactly 50,000 draws with replacement from ``embeddings`` (weight =
    multiplicity, sum 50,000)."""
    return X.bootstrap_by_key(S.load_table(spark, sf, "embeddings").select("vec_id", "label"),
                              50_000, ["vec_id"], seed=42)


Z_COLS = ["l_quantity", "l_discount", "l_tax", "p_retailprice"]


@register("z1_standard_scale", _with(pr=PRICES) + f"SELECT {', '.join(PRICE_KEYS)}, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
    f"ELSE stddev_pop({c}) OVER () END, 6) AS {c}" for c in Z_COLS) + " FROM pr")
def _z1(spark, sf):
    df = S.prices(spark, sf).select(*PRICE_KEYS, *Z_COLS)
    return standard_scale(df, Z_COLS).withColumns({c: F.round(c, 6) for c in Z_COLS})


# ------------------------------------------------------------------ metrics
V1_PRED = ("CASE WHEN value < 100 THEN 'view' WHEN value < 200 THEN 'click' "
           "ELSE 'purchase' END")


@register("v1_accuracy", _with(e=EVT) + f"SELECT avg(CASE WHEN event_type = {V1_PRED} THEN 1.0 "
          "ELSE 0.0 END)::DOUBLE AS accuracy FROM e")
def _v1(spark, sf):
    df = S.events(spark, sf).withColumn("prediction", F.expr(V1_PRED))
    return V.accuracy(df, "event_type", "prediction")


PRED_FRAME = ("SELECT *, l_extendedprice / 1000.0 AS label, "
              "l_quantity * p_retailprice * 0.95 / 1000.0 AS prediction FROM pr")
REG_SQL = ("SELECT round(CASE WHEN var_pop(label) > 0 THEN 1.0 - sum((label - prediction) * "
           "(label - prediction)) / (var_pop(label) * count(*)) END, 6) AS r2, "
           "round(avg(abs(label - prediction)), 6) AS mae, "
           "round(avg((label - prediction) * (label - prediction)), 6) AS mse, "
           "round(sqrt(avg((label - prediction) * (label - prediction))), 6) AS rmse FROM p")


def _pred_frame(spark, sf):
    return S.prices(spark, sf).withColumns({
        "label": F.col("l_extendedprice") / 1000.0,
        "prediction": F.col("l_quantity") * F.col("p_retailprice") * 0.95 / 1000.0})


def _round_all(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


@register("v2_v4_regression_metrics", _with(pr=PRICES, p=PRED_FRAME) + REG_SQL)
def _v2(spark, sf):
    return _round_all(V.regression_metrics(_pred_frame(spark, sf)))


@register("v5_fit_verdict", _with(pr=PRICES, p=PRED_FRAME, m=REG_SQL)
          + "SELECT *, CASE WHEN r2 < 0.1 THEN 'little predictive power' WHEN r2 < 0.5 THEN "
            "'captures some trends, much noise' ELSE 'finds solid patterns' END AS verdict FROM m")
def _v5(spark, sf):
    return V.fit_verdict(_round_all(V.regression_metrics(_pred_frame(spark, sf))))


@register("v6_prediction_sample", _with(pr=PRICES, p=PRED_FRAME)
          + f"SELECT {', '.join(PRICE_KEYS)}, label AS real, prediction AS predicted FROM p "
            f"ORDER BY {', '.join(PRICE_KEYS)} LIMIT 10")
def _v6(spark, sf):
    return V.prediction_sample(_pred_frame(spark, sf), PRICE_KEYS)


@register("v6_plot_frame", _with(pr=PRICES, p=PRED_FRAME)
          + "SELECT label AS real, round(prediction + "
          + normal_sql("'42:' || " + " || ':' || ".join(
              f"CAST({k} AS VARCHAR)" for k in PRICE_KEYS)) + ", 6) AS predicted_jitter FROM p")
def _v6b(spark, sf):
    """(real, predicted + seeded N(0,1) jitter) for every row."""
    frame = V.plot_frame(_pred_frame(spark, sf), key=PRICE_KEYS)
    return frame.withColumn("predicted_jitter", F.round("predicted_jitter", 6))


# ------------------------------------------------------------------- models
@register("r1_least_squares_one_feature", _with(pr=PRICES)
          + "SELECT round(regr_slope(l_extendedprice / 1000.0, l_quantity), 6) AS slope, "
            "round(regr_intercept(l_extendedprice / 1000.0, l_quantity), 6) AS intercept, "
            "round(regr_r2(l_extendedprice / 1000.0, l_quantity), 6) AS r2 FROM pr")
def _r1(spark, sf):
    from tabloom.operators.supervised import fit_linear
    df = S.prices(spark, sf).withColumn("label", F.col("l_extendedprice") / 1000.0)
    model = fit_linear(E.assemble(df, ["l_quantity"]))
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 6), round(float(model.intercept), 6),
          round(float(model.summary.r2), 6))], "slope double, intercept double, r2 double")


# Weights on standardised features of two columns, one of them given twice, in
# closed form: the repeated column's weight is shared equally.
_MIN_NORM = """m AS (SELECT var_pop(l_quantity) AS vq, var_pop(l_discount) AS vd,
  covar_pop(l_quantity, l_discount) AS qd, covar_pop(l_quantity, l_extendedprice / 1000.0) AS qy,
  covar_pop(l_discount, l_extendedprice / 1000.0) AS dy FROM pr),
b AS (SELECT sqrt(vq) * (vd * qy - qd * dy) / (vq * vd - qd * qd) AS q,
  sqrt(vd) * (vq * dy - qd * qy) / (vq * vd - qd * qd) AS d FROM m),
w AS (SELECT 'dozens' AS feature, q / 2 AS weight FROM b UNION ALL SELECT 'l_quantity', q / 2 FROM b
  UNION ALL SELECT 'l_discount', d FROM b)"""


@register("r2_least_norm_weights", f"WITH pr AS ({PRICES}), {_MIN_NORM} SELECT feature, "
          "round(weight, 6) AS weight, round(abs(weight), 6) AS importance FROM w")
def _r2n(spark, sf):
    """R1/R2 on a singular design: the quantity stands there twice, in two
    units.  Weights of least norm against the normal equations in SQL."""
    from tabloom.operators.least_squares import fit_least_norm
    from tabloom.operators.supervised import coefficient_table
    names = ["l_quantity", "dozens", "l_discount"]
    df = S.prices(spark, sf).select(
        "l_quantity", (F.col("l_quantity") / 12.0).alias("dozens"), "l_discount",
        (F.col("l_extendedprice") / 1000.0).alias("label"))
    fit = fit_least_norm(cut_lineage(E.assemble(df, names).select("features", "label")), len(names))
    return _round_all(coefficient_table(spark, names, list(fit.coefficients)))


@register("price_regression")
def _reg(spark, sf):
    """Lifecycle B on the price frame: leakage-free features, one-hot
    (first dropped), exact median imputation, exact 80/20 split, scaling
    fitted on train, least squares, metrics and verdict on test."""
    return price_regression(spark, sf)["metrics"]


@register("r2_coefficient_table")
def _r2(spark, sf):
    """Top 10 coefficients (on scaled features) by absolute weight."""
    return price_regression(spark, sf)["coefficients"]


@register("r1_price_predictions")
def _r1p(spark, sf):
    """Test-set predictions of the least-squares fit (V6 input)."""
    return price_regression(spark, sf)["predictions"]


_DURATION = """date_diff('microsecond', "Start_Time", "End_Time") / 6e7"""


@register("duration_frame", _with(a=S.duck_standin(S.ACCIDENTS_SQL), b=LENIENT_BOTH)
          + f"SELECT * EXCLUDE ({', '.join(map(dq, LONG_TEXT))}, \"Start_Time\", \"End_Time\", "
            f'"End_Lat", "End_Lng", "Distance(mi)", "Severity"), "ID" AS row_key, '
          + ", ".join(f'CAST({p}("Start_Time") AS INTEGER) AS "Start_Time_{p}"'
                      for p in ("year", "month", "day", "hour"))
          + f', {_DURATION} AS "Duration_min" FROM b WHERE {_DURATION} > 0 AND {_DURATION} < 240')
def _durf(spark, sf):
    """Lifecycle B up to the encoding: D3, F3, D6, F4, P3, D8, P12."""
    return duration_frame(S.accidents(spark, sf))


@register("duration_regression")
def _dur(spark, sf):
    """Lifecycle B on the accident table: test metrics and verdict."""
    return duration_regression(S.accidents(spark, sf))["metrics"]


@register("duration_predictions")
def _durp(spark, sf):
    """Test-set predictions of lifecycle B."""
    return duration_regression(S.accidents(spark, sf))["predictions"]


@register("g1_entropy_tree")
def _g1(spark, sf):
    return classify_crashes(prepared_crashes(spark, sf), TARGETS, ["entropy"])


@register("g2_gini_tree")
def _g2(spark, sf):
    return classify_crashes(prepared_crashes(spark, sf), TARGETS, ["gini"])


@register("g3_random_forest")
def _g3(spark, sf):
    return classify_crashes(prepared_crashes(spark, sf), TARGETS, ["forest"])


@register("g5_target_sweep")
def _g5(spark, sf):
    """Entropy tree, gini tree and 200-tree forest on each of the five targets."""
    return target_sweep(prepared_crashes(spark, sf), TARGETS)


@register("n3_tree_impute")
def _n3(spark, sf):
    """Depth-6 gini tree imputation of the six crash categories, in order."""
    return impute_crashes(spark, sf)


@register("impute_then_classify")
def _d(spark, sf):
    """Lifecycle D: N3 imputation, then the entropy tree, the gini tree and the
    200-tree forest on each of the five targets."""
    return target_sweep(impute_crashes(spark, sf), TARGETS)
