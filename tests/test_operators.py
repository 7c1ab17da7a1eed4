"""Edge cases of the tabular operators on tiny frames."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.functions import dates as D
from tabloom.functions import units as U
from tabloom.operators import columns as P
from tabloom.operators import encode as E
from tabloom.operators import missing as M
from tabloom.operators import rows as R
from tabloom.operators import split as X
from tabloom.operators.quantiles import exact_order_statistics, exact_quantiles
from tabloom.operators.scale import fit_scaler
from tabloom.sources import csv as CSV


def test_drop_sparse_strictly_above_threshold(spark):
    # a: 40 % missing (kept), b: 60 % missing (dropped)
    rows = [(1, None if i < 4 else 1.0, None if i < 6 else 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "k int, a double, b double")
    out, dropped = P.drop_sparse_columns(df, 0.40)
    assert dropped == ["b"]
    assert out.columns == ["k", "a"]


def test_drop_strict_raises_and_tolerant_ignores(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(KeyError):
        P.drop_strict(df, ["a", "zz"])
    assert P.drop_tolerant(df, ["a", "zz"]).columns == ["b"]


def test_parse_five_percent_rule(spark):
    good = "2024-01-02 03:04:05"
    odd = "2024-01-02 03:04:05.000000000"
    # exactly 5 % fail the strict format -> strict parse stays (odd -> NULL)
    rows = [(i, odd if i < 5 else good) for i in range(100)]
    df = spark.createDataFrame(rows, "i int, t string")
    out = D.parse_datetime(df, "t")
    assert out.filter(F.col("t").isNull()).count() == 5
    # 6 % fail -> the whole column is parsed leniently (odd is accepted)
    rows = [(i, odd if i < 6 else good) for i in range(100)]
    out = D.parse_datetime(spark.createDataFrame(rows, "i int, t string"), "t")
    assert out.filter(F.col("t").isNull()).count() == 0
    assert out.first()["t"] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_open_range_excludes_both_ends(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (239.9,), (240.0,)], "d double")
    assert sorted(r[0] for r in R.open_range(df, "d", 0, 240).collect()) == [0.5, 239.9]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(-3.0,), (None,), (2.0,)], "x double")
    got = [r[0] for r in df.select(U.clip_lower("x", 0.0)).collect()]
    assert got == [0.0, None, 2.0]


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12),)], "t timestamp_ntz")  # Monday
    assert df.select(D.date_parts("t")["dayofweek"]).first()[0] == 0


def test_duration_and_time_features(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 9, 30))],
                               "Start_Time timestamp_ntz, End_Time timestamp_ntz")
    row = D.add_time_features(df).first()
    assert row["duration_min"] == 0.0 and row["start_hour"] == 10 and row["start_month"] == 1


def test_unit_pack_order_and_coercion(spark):
    df = spark.createDataFrame([("50", 2.0, "x")], "`Temperature(F)` string, `Distance(mi)` double, k string")
    out = U.convert_imperial_to_metric(df)
    assert out.columns == ["k", "Temperature(C)", "Distance(km)"]
    r = out.first()
    assert r["Temperature(C)"] == (50.0 - 32) * 5.0 / 9.0
    assert r["Distance(km)"] == 2.0 * 1.609344
    bad = spark.createDataFrame([("calm",)], "`Temperature(F)` string")
    assert U.convert_imperial_to_metric(bad).first()[0] is None


def test_median_even_count_and_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,), (float("nan"),)],
                               "x double")
    assert M.fit_medians(df, ["x"]) == {"x": 2.5}
    filled = M.median_impute(df, ["x"])
    assert sorted(r[0] for r in filled.collect()) == [1.0, 2.0, 2.5, 2.5, 3.0, 10.0]


def test_median_of_empty_column_drops_it(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, x double")
    assert M.median_impute(df, ["x"]).columns == ["k"]


def test_exact_quantiles_match_numpy_with_hot_value(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.integers(0, 5, 1000)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(7)
    qs = (0.1, 0.25, 0.5, 0.75, 0.9)
    got = exact_quantiles(df, ["x"], qs, max_bracket=50)["x"]
    want = np.quantile(vals, qs)
    assert np.allclose(got, want, rtol=0, atol=1e-12)
    assert got[2] == np.median(vals)


def test_order_statistic_exact(spark):
    vals = list(range(1000, 0, -1))
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    assert exact_order_statistics(df, "x", [0, 499, 999], max_bracket=10) == {
        0: 1.0, 499: 500.0, 999: 1000.0}


def test_one_hot_missing_and_unseen_are_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    cats = E.fit_categories(train, ["c"])
    assert cats == {"c": ["a", "b"]}
    test = spark.createDataFrame([("z",), (None,), ("b",)], "c string")
    out = E.get_dummies(test, ["c"], categories=cats)
    assert out.columns == ["c_a", "c_b"]
    assert [tuple(r) for r in out.collect()] == [(0, 0), (0, 0), (0, 1)]
    first_dropped = E.get_dummies(test, ["c"], categories=cats, drop_first=True)
    assert first_dropped.columns == ["c_b"]


def test_label_codes(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("q",)], "c string")
    got = [r[0] for r in df.select(E.label_codes("c", ["a", "b"])).collect()]
    assert got == [1, -1, 0, -1]


def test_split_exact_sizes_disjoint_and_stable(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    a = X.split_exact(df, ["k"], seed=42, train_size=0.8)
    b = X.split_exact(df.repartition(5), ["k"], seed=42, train_size=0.8)
    assert a.filter("is_train").count() == math.floor(0.8 * 1003)
    assert a.count() == 1003
    ta = {r[0] for r in a.filter("is_train").select("k").collect()}
    tb = {r[0] for r in b.filter("is_train").select("k").collect()}
    assert ta == tb


def test_split_hash_stable(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = {r[0] for r in X.split_hash(df, ["k"]).filter("is_train").select("k").collect()}
    b = {r[0] for r in X.split_hash(df.repartition(3), ["k"]).filter("is_train").select("k").collect()}
    assert a == b and 300 < len(a) < 500


def test_bootstrap_exact_size(spark):
    df = spark.range(300).withColumnRenamed("id", "k").repartition(3)
    s = X.bootstrap(df, 1000, seed=7)
    assert s.agg(F.sum("weight")).first()[0] == 1000
    assert s.select("k").distinct().count() == s.count()
    assert X.bootstrap(df, 1000, seed=7, expand=True).count() == 1000


def test_scaler_population_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    st = fit_scaler(df, ["a", "b"])
    assert st["a"] == (2.0, 1.0)   # population deviation of {1, 3}
    assert st["b"] == (5.0, 1.0)   # zero variance -> 1


def test_sentinel_exact_match_only(spark):
    df = spark.createDataFrame([("UNKNOWN", 1), (" UNKNOWN", 2)], "c string, n int")
    got = [tuple(r) for r in M.sentinel_to_null(df).collect()]
    assert got == [(None, 1), (" UNKNOWN", 2)]


def test_csv_tokens_quotes_and_names(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text('a,b,"c;;;;"\n1,NA,"x, ""y"""\n2,,N/A\n3,4.5,plain\n')
    df = CSV.read_csv(spark, str(p), infer=True)
    assert df.columns == ["a", "b", "c"]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(1, None, 'x, "y"'), (2, None, None), (3, 4.5, "plain")]
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "string"}


def test_leakage_guard(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "y int, End_Time int, Severity int, "
                                                  "`Distance(mi)` int, keep int")
    out, dropped, ok = P.leakage_guard(df, "y")
    assert out.columns == ["keep"] and ok


def test_cleaning_plan_and_stream_match_batch(spark):
    from tabloom.plans import standins as S
    from tabloom.plans.cleaning import apply_cleaning, fit_cleaning
    from tabloom.session import scratch_path
    from tabloom.streaming.cleaning import run_to_completion
    raw = S.accidents(spark, "/root/testdata/sf0.001")
    plan = fit_cleaning(raw)
    assert plan.parse == {"Start_Time": "lenient", "End_Time": "strict"}
    assert set(plan.dropped) == {"End_Lat", "End_Lng"}
    batch = apply_cleaning(raw, plan)
    src = scratch_path(spark, "stream-src")
    raw.repartition(3).write.parquet(src)
    streamed = run_to_completion(spark, src, raw.schema, plan)
    key = ["Start_Time", "End_Time", "Severity", "Humidity(%)", "City", "Zipcode"]
    a = sorted(tuple(r) for r in batch.select(*key).collect())
    b = sorted(tuple(r) for r in streamed.select(*key).collect())
    assert a == b and len(a) > 0
