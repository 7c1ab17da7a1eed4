"""Zones, seeded noise, weighted scaling, and the package on executors."""
import datetime
import os
import subprocess
import sys

import numpy as np
from pyspark.sql import functions as F

from tabloom.functions import dates, numeric
from tabloom.operators import encode, impute, scale, split
from tabloom.plans import regression

TEXTS = ["2024-03-10 02:30:00", "2024-11-03 01:30:00", "2020-02-29 23:59:59", "1969-12-31 23:59:58",
         "2024-13-01 00:00:00", "x", "", None]
LENIENT = TEXTS[:4] + ["03/10/2024 02:30", "03/10/2024", "2024-03-10T02:30:00.123456789", "nope", None]


def test_dates_do_not_depend_on_the_session_zone(spark):
    a = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    b = spark.createDataFrame([(t,) for t in LENIENT], "t string")
    got = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got.append(([r[0] for r in a.select(dates.strict_parse("t").cast("string")).collect()],
                        [r[0] for r in b.select(dates.lenient_parse("t").cast("string")).collect()]))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == got[1]
    assert got[0][0] == [*TEXTS[:4], None, None, None, None]
    assert got[0][1][4:6] == ["2024-03-10 02:30:00", "2024-03-10 00:00:00"]


def test_jitter_is_the_same_in_any_partitioning(spark):
    df = spark.range(2000).withColumn("v", F.col("id") * 1.0)
    x = numeric.jitter("v", 2.0, 7, ["id"]).alias("x")
    a = {r["id"]: r["x"] for r in df.select("id", x).collect()}
    b = {r["id"]: r["x"] for r in df.repartition(7).select("id", x).collect()}
    assert a == b
    noise = [v - k for k, v in a.items()]
    mean = sum(noise) / len(noise)
    sd = (sum((n - mean) ** 2 for n in noise) / len(noise)) ** 0.5
    assert abs(mean) < 0.2 and 1.8 < sd < 2.2


def test_weighted_scaler_of_a_constant(spark):
    df = spark.createDataFrame([(1e8 + 0.1, 1, 2.0), (1e8 + 0.1, 3, 4.0)], "a double, w long, b double")
    got = scale.fit_scaler(df, ["a", "b"], "w")
    assert got["a"][1] == 1.0 and got["b"] == (3.5, (0.75) ** 0.5)


def test_runs_from_another_folder(tmp_path):
    """Executors get the package even where no path leads to it."""
    code = (
        "import importlib.util, sys\n"
        "s = importlib.util.spec_from_file_location('e', sys.argv[1])\n"
        "e = importlib.util.module_from_spec(s); s.loader.exec_module(e)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = (SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')\n"
        "  .config('spark.sql.shuffle.partitions', '2').getOrCreate())\n"
        "print('ROWS', e.queries()['k1_silhouette'](spark, '/root/testdata/sf0.001').count())\n")
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code, entry], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=280)
    assert "ROWS" in out.stdout, out.stderr[-2000:]


def test_bootstrap_by_key_is_the_same_in_any_partitioning(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    got = [sorted(map(tuple, split.bootstrap_by_key(x, 3000, ["id"], seed=5).collect()))
           for x in (df, df.repartition(7), df.orderBy(F.col("id").desc()).coalesce(2))]
    assert got[0] == got[1] == got[2]
    assert sum(w for _, _, w in got[0]) == 3000
    assert 900 < len(got[0]) <= 1000


def test_rank_by_hash_is_dense_at_any_prefix_length(spark, monkeypatch):
    df = spark.range(5000)
    want = sorted(map(tuple, split.rank_by_hash(df, ["id"]).collect()))
    assert sorted(r for _, r in want) == list(range(5000))
    monkeypatch.setattr(split, "RANK_ROWS", 1)  # longer prefixes, the same ranks
    assert sorted(map(tuple, split.rank_by_hash(df, ["id"]).collect())) == want


def test_duration_plan_against_numpy(spark):
    """Filters by hand, and the fit against NumPy's least squares."""
    rows = []
    for i in range(400):
        minutes = (i * 37) % 300 - 20  # -20..279: both ends and beyond
        start = datetime.datetime(2024, 1, 1 + i % 28, i % 24, i % 60)
        end = str(start + datetime.timedelta(minutes=minutes)) if i % 50 else "unknown"
        rows.append((f"A-{i}", str(start), end, i % 4, None if i % 7 == 0 else float(minutes % 50),
                     ["x", "y", None][i % 3], 1.0, "text", i % 2 == 0, 9.0))
    df = spark.createDataFrame(rows, "ID string, Start_Time string, End_Time string, Severity int, "
                               "`Humidity(%)` double, Wind_Direction string, `Distance(mi)` double, "
                               "Street string, Stop boolean, End_Lat double")
    frame = regression.duration_frame(df)
    kept = [r for r in rows if r[2] != "unknown" and 0 < (int(r[0][2:]) * 37) % 300 - 20 < 240]
    assert frame.count() == len(kept)
    assert set(frame.columns) == {"row_key", "Humidity(%)", "Wind_Direction", "Stop", "Duration_min",
                                  "Start_Time_year", "Start_Time_month", "Start_Time_day",
                                  "Start_Time_hour"}
    text, numeric = ["Wind_Direction"], ["Humidity(%)", "Stop", "Start_Time_day", "Start_Time_hour"]
    enc, names = regression.encoded_frame(frame, ["row_key"], "Duration_min", numeric, text)
    assert names == [*numeric, "Wind_Direction_y"]
    pdf = enc.toPandas()
    known = [r[4] for r in kept if r[4] is not None]
    filled = {r[0]: np.median(known) if r[4] is None else r[4] for r in kept}
    assert all(filled[k] == h for k, h in zip(pdf["row_key"], pdf["Humidity(%)"]))
    train = pdf["is_train"].to_numpy()
    assert train.sum() == int(0.8 * len(kept))
    a = np.column_stack([np.ones(len(pdf)), pdf[names].to_numpy(dtype=float)])
    y = pdf["Duration_min"].to_numpy()
    beta = np.linalg.lstsq(a[train], y[train], rcond=None)[0]
    want = dict(zip(pdf["row_key"][~train], (a @ beta)[~train]))
    out = regression.fit_and_score(enc, names, ["row_key"], "Duration_min")
    got = {r["row_key"]: r["prediction"] for r in out["predictions"].collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in got)
    sd = a[train][:, 1:].std(axis=0)
    by_name = dict(zip(names, beta[1:] * sd))
    for r in out["coefficients"].collect():
        assert abs(r[1] - by_name[r[0]]) < 1e-6
    m = out["metrics"].first()
    err = y[~train] - (a @ beta)[~train]
    assert abs(m["mae"] - np.abs(err).mean()) < 1e-6 and abs(m["mse"] - (err ** 2).mean()) < 1e-5


def test_one_hot_vector_equals_the_columns(spark):
    df = spark.createDataFrame([(1, "b", None, 2.0), (2, "a", None, 3.0), (3, None, None, 4.0),
                                (4, "c", None, 5.0)], "id int, s string, empty string, x double")
    for drop in (False, True):
        wide = encode.get_dummies(df, ["s"], drop_first=drop, dtype="double")
        names = [c for c in wide.columns if c.startswith("s_")]
        want = {r["id"]: [r["x"], *[r[n] for n in names]] for r in wide.collect()}
        got = encode.one_hot_vector(df, ["s", "empty"], ["x"], drop_first=drop)
        assert got.columns == [*df.columns, "features"]
        assert {r["id"]: list(r["features"].toArray()) for r in got.collect()} == want
    labels = {r["id"]: r["label"] for r in encode.class_codes(df, "s").collect()}
    assert labels == {1: 1.0, 2: 0.0, 3: 3.0, 4: 2.0}


def test_one_hot_vector_of_many_values(spark):
    df = spark.range(12_000).select("id", F.col("id").cast("string").alias("s"))
    got = encode.one_hot_vector(df, ["s"])
    assert got.where("id = 7").first()["features"].size == 12_000


def test_tree_imputation_fills_what_a_tree_can_learn(spark):
    rows = [(i, ["A", "B", "C"][i % 3] if i % 5 else None, "abc"[i % 3], float(i % 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "crash_id int, t string, s string, x double")
    out = impute.impute_with_tree(df, "t", "crash_id")
    assert out.columns == df.columns
    assert {r["crash_id"]: r["t"] for r in out.collect()} == {i: ["A", "B", "C"][i % 3] for i in range(300)}
    full = df.where("t is not null")
    assert impute.impute_with_tree(full, "t", "crash_id") is full
