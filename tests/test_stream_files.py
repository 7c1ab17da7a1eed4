"""The stream query builds its table once: the plan is fitted on the written files."""
import datetime

from tabloom.plans import cleaning, q_tabular, standins


def test_plan_is_fitted_on_the_files_that_stream(spark, tmp_path, monkeypatch):
    day = datetime.datetime(1996, 3, 5)
    orders = [(k, k % 7, "FOP"[k % 3], day, "1-URGENT") for k in range(60)]
    lines = [(k, k % 9, k % 4, 1 + k % 7, 10.0 + k % 30, 0.01 * (k % 11), 0.01 * (k % 9),
              "RAN"[k % 3], "OF"[k % 2], day) for k in range(60)]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, "
        "o_orderpriority string").write.parquet(standins.table_path(str(tmp_path), "orders"))
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz").write.parquet(standins.table_path(str(tmp_path), "lineitem"))
    fitted, fit = [], cleaning.fit_cleaning
    monkeypatch.setattr(cleaning, "fit_cleaning", lambda df, *more: fitted.append(df) or fit(df, *more))
    streamed = q_tabular._stream(spark, str(tmp_path)).collect()
    assert len(fitted) == 1 and all("accidents-files" in f for f in fitted[0].inputFiles())
    batch = q_tabular.cleaned(spark, str(tmp_path)).collect()
    assert batch and sorted(map(str, streamed)) == sorted(map(str, batch))
