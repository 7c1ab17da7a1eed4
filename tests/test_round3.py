"""Round 3: date texts beside the formatter, methods small enough to compile,
staged imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

import pytest

from tabloom.functions import dates as D

TEXTS = ["2020-02-29 01:02:03", "2019-02-29 01:02:03", "0000-01-01 00:00:00", "+12020-01-01 00:00:00",
         "-0001-01-01 00:00:00", "2020-01-01 24:00:00", "2020-01-01 23:59:60", " 2020-01-01 00:00:00",
         "2020-01-01 00:00:00\n", "2020-01-01 00:00:00.000000000", "2020-1-1 00:00:00", "unknown", "",
         None, "12/31/2020 23:59:59", "31/12/2020 23:59:59", "02/03/2020 04:05", "31/12/2020",
         "02/30/2020", "02/03/+12020", "00/10/2020", "1/2/2020", "２０２０-01-01 00:00:00",
         "02/03/0000", "02/03/2020 25:00", "9999-12-31 23:59:59"]
FORMATS = [D.STRICT_FORMAT, *D.LENIENT_FORMATS, *D.DAY_FIRST_FORMATS]


def test_date_texts_as_the_formatter_reads_them(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "s string").repartition(3)
    for fmt in FORMATS:
        assert D._shapes(fmt)
        rows = df.select("s", D.parse_ntz(F.col("s"), fmt).cast("string").alias("a"),
                         D._formatted_ntz(F.col("s"), fmt).cast("string").alias("b")).collect()
        assert [(r["s"], r["a"]) for r in rows] == [(r["s"], r["b"]) for r in rows]
        assert any(r["a"] for r in rows)


@pytest.mark.parametrize("fmt", ["dd MMM yyyy", "yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd ss"])
def test_other_formats_keep_the_formatter(fmt):
    assert D._shapes(fmt) is None


def test_prepared_sessions_compile_no_huge_method(spark):
    from tabloom.session import prepare
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "65535")
        prepare(spark)
        assert int(spark.conf.get(key)) == 8000
    finally:
        spark.conf.set(key, before)


def test_imputation_is_staged_as_columns(spark):
    from tabloom.operators.impute import impute_categories
    rows = [(i, "ab"[i % 2], None if i % 7 == 0 else "xy"[i % 2]) for i in range(140)]
    df = spark.createDataFrame(rows, "crash_id long, c string, t string")
    out = impute_categories(df, ["t"])
    assert out.inputFiles() and all(f.endswith(".parquet") for f in out.inputFiles())
    assert out.where("t is distinct from case c when 'a' then 'x' else 'y' end").count() == 0
    assert out.count() == 140


def test_category_lists_take_one_pass(spark):
    from tabloom.operators.encode import fit_categories
    seen = spark.sparkContext.accumulator(0)

    def count(v):
        seen.add(1)
        return v

    df = spark.range(50).select(F.udf(count)(F.col("id").cast("string")).alias("c"))
    assert fit_categories(df, ["c"]) == {"c": sorted(str(i) for i in range(50))}
    assert seen.value == 50
    with pytest.raises(ValueError):
        fit_categories(df, ["c"], max_categories=49)
