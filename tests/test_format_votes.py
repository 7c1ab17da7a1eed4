"""A column's values decide together which of day and month comes first."""
import datetime

from pyspark.sql import functions as F

from tabloom.functions import dates
from tabloom.plans import cleaning

AMBIGUOUS = ["03/04/2024", "01/02/2024 10:30", "11/12/2023 23:59:58"]


def column(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "Start_Time string")


def parsed(df):
    return [r[0] for r in dates.parse_datetime_columns(df).collect()]


def test_one_row_decides(spark):
    day = datetime.datetime(2024, 4, 3)
    assert parsed(column(spark, AMBIGUOUS * 50 + ["25/12/2024"]))[0] == day
    assert parsed(column(spark, AMBIGUOUS * 50 + ["12/25/2024"]))[0] == day.replace(month=3, day=4)


def test_no_row_decides(spark):
    got = parsed(column(spark, [*AMBIGUOUS, None, "unknown", "", "2024-03-10 01:02:03"]))
    assert got[0] == datetime.datetime(2024, 3, 4) and got[3:6] == [None] * 3
    assert got[6] == datetime.datetime(2024, 3, 10, 1, 2, 3)


def test_text_of_the_other_order_is_missing(spark):
    got = parsed(column(spark, ["25/12/2024", "26/12/2024", "12/27/2024", "01/02/2024"]))
    assert got[2] is None and got[3] == datetime.datetime(2024, 2, 1)


def test_masks(spark):
    df = column(spark, ["2024-01-01", "03/04/2024", "25/12/2024", "12/25/2024 10:30", "x", None])
    got = [r[0] for r in df.select(dates.format_mask("Start_Time")).collect()]
    assert got == [1, 8 | 64, 64, 4, 0, None]
    row = column(spark, [*AMBIGUOUS[:1], "25/12/2024", "x"]).agg(
        *dates.vote_aggregates("Start_Time", "v")).first()
    assert tuple(row) == (64, 1, 2)
    none = column(spark, [None]).agg(*dates.vote_aggregates("Start_Time", "v")).first()
    assert tuple(none) == (None, 0, 0) and not dates.votes_day_first(none, "v")


def test_cleaning_plan_takes_the_vote(spark):
    df = column(spark, AMBIGUOUS * 9 + ["25/12/2024"]).withColumn("x", F.lit(1))
    plan = cleaning.fit_cleaning(df)
    assert plan.parse == {"Start_Time": "day_first"} and not plan.dropped
    out = cleaning.apply_cleaning(df, plan)
    assert out.count() == 28 and out.first()["start_month"] == 4
    empty = cleaning.fit_cleaning(df.where("x = 2"))
    assert empty.parse == {"Start_Time": "strict"}


def test_mask_tells_what_either_parse_loses(spark):
    texts = [*AMBIGUOUS, "25/12/2024", "12/25/2024 10:30", "30/02/2024", "02/29/1900", "13/13/2024",
             "03/04/12024", "03/04/+2024", "03/04/0000", "3/4/2024", "1/2/2024x", " 03/04/2024 ",
             "03/04/2024 24:00", "03/04/2024 10:3", "a/b", "/", "2024-01-01T10:11:12.123456789",
             "2024-01-01 10:11:12/1", "", "x", None]
    df = column(spark, texts)
    for day_first in (False, True):
        rows = df.select(
            "Start_Time", dates.lenient_parse("Start_Time", day_first).isNull().alias("a"),
            dates.mask_fails(dates.format_mask("Start_Time"), day_first).alias("b"),
            F.coalesce(F.trim("Start_Time").try_cast("timestamp_ntz"), *[
                dates.parse_ntz(F.trim("Start_Time"), f) for f in (
                    dates.DAY_FIRST_FORMATS if day_first else dates.LENIENT_FORMATS)]).cast(
                    "string").alias("old"),
            dates.lenient_parse("Start_Time", day_first).cast("string").alias("new")).collect()
        assert [r["a"] for r in rows] == [r["b"] for r in rows]
        assert [r["old"] for r in rows] == [r["new"] for r in rows]
