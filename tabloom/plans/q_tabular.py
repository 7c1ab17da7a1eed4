"""Registered queries for sources, projections, filters, missing values,
dates, units and profiles, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.functions import dates as D
from tabloom.functions import numeric as N
from tabloom.functions import units as U
from tabloom.operators import columns as P
from tabloom.operators import encode as E
from tabloom.operators import missing as M
from tabloom.operators import profile as A
from tabloom.operators import rows as R
from tabloom.plans import standins as S
from tabloom.plans.cleaning import TEXT_DROP_CANDIDATES, clean_accidents
from tabloom.plans.clustering import CLUSTER_DROP, CLUSTER_NUMERIC
from tabloom.plans.registry import register
from tabloom.sources import csv as CSV

q = P.col


def _with(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS (\n{v}\n)" for k, v in ctes.items()) + "\n"


def dq(name: str) -> str:
    return '"' + name + '"'


def duck_lenient(expr: str) -> str:
    s = f"trim(CAST({expr} AS VARCHAR))"
    tries = [f"TRY_CAST({s} AS TIMESTAMP)"] + [
        f"try_strptime({s}, '{f}')" for f in ("%m/%d/%Y %H:%M:%S", "%m/%d/%Y %H:%M", "%m/%d/%Y")]
    return "COALESCE(" + ", ".join(tries) + ")"


def duck_strict(expr: str) -> str:
    return f"try_strptime(CAST({expr} AS VARCHAR), '%Y-%m-%d %H:%M:%S')"


ACC = S.duck_standin(S.ACCIDENTS_SQL)
CRASH = S.duck_standin(S.CRASHES_SQL)
EVT = S.duck_standin(S.EVENTS_SQL)

RAW_ACC_COLUMNS = [
    "ID", "Source", "Severity", "Start_Time", "End_Time", "Start_Lat", "Start_Lng", "End_Lat",
    "End_Lng", "Distance(mi)", "Description", "Street", "City", "County", "State", "Zipcode",
    "Country", "Timezone", "Airport_Code", "Weather_Timestamp", "Temperature(F)",
    "Wind_Chill(F)", "Humidity(%)", "Pressure(in)", "Visibility(mi)", "Wind_Direction",
    "Wind_Speed(mph)", "Precipitation(in)", "Weather_Condition", "Amenity", "Bump", "Give_Way",
    "No_Exit", "Railway", "Roundabout", "Traffic_Calming", "Turning_Loop", "Stop", "Junction",
    "Station", "Crossing", "Traffic_Signal", "Sunrise_Sunset", "Civil_Twilight",
    "Nautical_Twilight", "Astronomical_Twilight"]
ACC_STRINGS = ["ID", "Source", "Start_Time", "End_Time", "Description", "Street", "City",
               "County", "State", "Zipcode", "Country", "Timezone", "Airport_Code",
               "Weather_Timestamp", "Temperature(F)", "Wind_Direction", "Wind_Speed(mph)",
               "Weather_Condition", "Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight",
               "Astronomical_Twilight"]
UNIT_SOURCES = [s for s, _, _ in U.IMPERIAL_TO_METRIC]
CRASH_STRINGS = ["crash_date", "traffic_control_device", "weather_condition",
                 "lighting_condition", "roadway_surface_cond", "road_defect", "trafficway_type",
                 "alignment", "crash_type", "damage", "first_crash_type"]
INJURY_COLUMNS = ["injuries_total", "injuries_fatal", "injuries_incapacitating",
                  "injuries_non_incapacitating", "injuries_reported_not_evident",
                  "injuries_no_indication"]
CRASH_NUMERIC = ["crash_id"] + INJURY_COLUMNS


def duck_units(exclude_extra=()) -> str:
    """The M8 projection in DuckDB (sources dropped, targets appended)."""
    excl = ", ".join(dq(c) for c in list(UNIT_SOURCES) + list(exclude_extra))
    conv = []
    for src, dst, fn in U.IMPERIAL_TO_METRIC:
        x = f"TRY_CAST({dq(src)} AS DOUBLE)"
        if fn is U.fahrenheit_to_celsius:
            e = f"({x} - 32.0) * 5.0 / 9.0"
        else:
            factor = {U.miles_to_km: U.MILE_KM, U.mph_to_ms: U.MPH_MS,
                      U.inch_to_mm: U.INCH_MM, U.inhg_to_hpa: U.INHG_HPA}[fn]
            e = f"{x} * CAST({factor!r} AS DOUBLE)"
        conv.append(f"{e} AS {dq(dst)}")
    return excl, ",\n    ".join(conv)


def duck_time_features(start='"Start_Time"', end='"End_Time"') -> str:
    d = f"date_diff('microsecond', {start}, {end}) / 6e7"
    return (f"CAST(hour({start}) AS INTEGER) AS start_hour,\n"
            f"    CAST(isodow({start}) - 1 AS INTEGER) AS start_dayofweek,\n"
            f"    CAST(month({start}) AS INTEGER) AS start_month,\n"
            f"    CASE WHEN {d} < 0 THEN 0.0 ELSE {d} END AS duration_min")


_units_excl, _units_conv = duck_units()
CLEAN_CTES = dict(
    a=ACC,
    p=f"""SELECT * EXCLUDE ("ID", "Description", "Street", "Weather_Timestamp", "Source",
                          "End_Lat", "End_Lng")
    REPLACE ({duck_lenient('"Start_Time"')} AS "Start_Time",
             {duck_strict('"End_Time"')} AS "End_Time")
  FROM a""",
    r="SELECT * FROM p WHERE COLUMNS(*) IS NOT NULL",
    c=f"""SELECT * EXCLUDE ({_units_excl}),
    {duck_time_features()},
    {_units_conv}
  FROM r""",
)
CLEAN_WITH = _with(**CLEAN_CTES)
N_CLEAN_COLUMNS = len(RAW_ACC_COLUMNS) - len(TEXT_DROP_CANDIDATES) - 2 + 4


def cleaned(spark, sf):
    return clean_accidents(S.accidents(spark, sf))


# ---------------------------------------------------------------- flagship
register("clean_accidents", CLEAN_WITH + "SELECT * FROM c")(cleaned)


@register("clean_accidents_stream", CLEAN_WITH + "SELECT * FROM c")
def _stream(spark, sf):
    """The cleaning plan fitted on the table, then applied by a Structured
    Streaming query to the same rows arriving as parquet files.  The table is
    built once, as these files: the fit reads them, too."""
    from tabloom.plans.cleaning import fit_cleaning
    from tabloom.session import scratch_path
    from tabloom.streaming.cleaning import run_to_completion
    raw = S.accidents(spark, sf)
    src = scratch_path(spark, "accidents-files")
    raw.write.parquet(src)
    plan = fit_cleaning(spark.read.schema(raw.schema).parquet(src))
    return run_to_completion(spark, src, raw.schema, plan)

# ------------------------------------------------------- sources and sinks
HEAD_KEYS = ["Start_Time", "End_Time", "Severity", "Start_Lat", "Start_Lng", "Humidity(%)",
             "City", "Zipcode", "Airport_Code", "Temperature(C)", "Wind_Speed(m/s)"]


@register("s4_head", CLEAN_WITH + "SELECT * FROM c ORDER BY "
          + ", ".join(f"{dq(k)} ASC NULLS FIRST" for k in HEAD_KEYS) + " LIMIT 5")
def _s4(spark, sf):
    return R.head(cleaned(spark, sf), 5, [q(k).asc_nulls_first() for k in HEAD_KEYS])


@register("s5_shape", CLEAN_WITH
          + f"SELECT count(*) AS n_rows, CAST({N_CLEAN_COLUMNS} AS BIGINT) AS n_cols FROM c")
def _s5(spark, sf):
    return R.shape(cleaned(spark, sf))


CSV_COLUMNS = ["ID", "Severity", "Start_Time", "End_Time", "Distance(mi)", "Description",
               "Temperature(F)", "Wind_Chill(F)", "Weather_Condition", "Crossing"]


@register("s1_csv_roundtrip", _with(a=ACC) + "SELECT "
          + ", ".join(dq(c) for c in CSV_COLUMNS) + " FROM a")
def _s1(spark, sf):
    """Write the table as CSV (header names carry the ';;;;'
    junk of the reference's file) to the shared checkpoint folder, read it
    back with pandas' missing tokens and name cleaning, and cast back to
    the original types."""
    df = S.accidents(spark, sf).select(*[q(c) for c in CSV_COLUMNS])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    path = CSV.write_csv(df.toDF(*[c + (";;;;" if c == CSV_COLUMNS[-1] else "")
                                   for c in CSV_COLUMNS]), name="accidents")
    back = CSV.read_csv(spark, path, clean_names=True)
    return CSV.cast_columns(back, types)


# -------------------------------------------------------------- projections
@register("p1_select_columns", CLEAN_WITH + "SELECT "
          + ", ".join(dq(c) for c in CLUSTER_NUMERIC) + " FROM c")
def _p1(spark, sf):
    return P.select_columns(cleaned(spark, sf), CLUSTER_NUMERIC)


@register("p2_drop_strict", CLEAN_WITH + "SELECT * EXCLUDE ("
          + ", ".join(dq(c) for c in CLUSTER_DROP) + ") FROM c")
def _p2(spark, sf):
    return P.drop_strict(cleaned(spark, sf), CLUSTER_DROP)


@register("p3_drop_tolerant", _with(a=ACC) + "SELECT * EXCLUDE ("
          + ", ".join(dq(c) for c in TEXT_DROP_CANDIDATES) + ") FROM a")
def _p3(spark, sf):
    return P.drop_tolerant(S.accidents(spark, sf), list(TEXT_DROP_CANDIDATES) + ["Not_A_Column"])


@register("p4_drop_prefix", _with(a=ACC)
          + 'SELECT * EXCLUDE ("End_Time", "End_Lat", "End_Lng") FROM a')
def _p4(spark, sf):
    return P.drop_prefix(S.accidents(spark, sf), "End_")


@register("p5_drop_sparse_columns", _with(a=ACC) + 'SELECT * EXCLUDE ("End_Lat", "End_Lng") FROM a')
def _p5(spark, sf):
    return P.drop_sparse_columns(S.accidents(spark, sf), 0.40)[0]


@register("p6_select_strings", _with(a=ACC) + "SELECT "
          + ", ".join(dq(c) for c in ACC_STRINGS) + " FROM a")
def _p6(spark, sf):
    return P.select_strings(S.accidents(spark, sf))


@register("p7_datetime_like_columns", _with(a=ACC)
          + 'SELECT "Start_Time", "End_Time", "Weather_Timestamp" FROM a')
def _p7(spark, sf):
    df = S.accidents(spark, sf)
    return df.select(*[q(c) for c in D.datetime_like_columns(df)])


@register("p8_derive_column", _with(e=EVT)
          + "SELECT event_id, value, value * 2.0 + 1.0 AS derived FROM e")
def _p8(spark, sf):
    df = S.events(spark, sf).select("event_id", "value")
    return P.derive(df, derived=F.col("value") * 2.0 + 1.0)


@register("p9_cast_counts", _with(cr=CRASH) + "SELECT * REPLACE ("
          + ", ".join(f"CAST(trunc({c}) AS INTEGER) AS {c}" for c in INJURY_COLUMNS)
          + ") FROM cr")
def _p9(spark, sf):
    return P.cast_columns(S.crashes(spark, sf), INJURY_COLUMNS, "int")


@register("p10_hconcat", CLEAN_WITH
          + 'SELECT "Severity", duration_min, CAST("Crossing" AS INTEGER) AS "Crossing", '
            'CAST("Traffic_Signal" AS INTEGER) AS "Traffic_Signal", CAST(CASE WHEN '
            """"Sunrise_Sunset" = 'Night' THEN 1 ELSE 0 END AS INTEGER) AS "Sunrise_Sunset_Night" FROM c""")
def _p10(spark, sf):
    """Numbers, flags and dummies of one frame side by side."""
    df = cleaned(spark, sf)
    numbers = [q("Severity"), q("duration_min")]
    flags = [q(c).cast("int").alias(c) for c in ("Crossing", "Traffic_Signal")]
    cats = E.fit_categories(df, ["Sunrise_Sunset"])
    return P.hconcat(df, numbers, flags, E.dummies(cats, drop_first=True))


@register("p11_align_columns", _with(e=EVT)
          + "SELECT event_id, value, 0 AS absent_column, user_id FROM e")
def _p11(spark, sf):
    return P.align_columns(S.events(spark, sf), ["event_id", "value", "absent_column", "user_id"])


@register("p12_leakage_guard", _with(a=ACC)
          + 'SELECT * EXCLUDE ("End_Time", "End_Lat", "End_Lng", "Distance(mi)", "Severity") FROM a')
def _p12(spark, sf):
    df = S.accidents(spark, sf)
    df = df.withColumn("Duration_min", D.duration_minutes(D.lenient_parse("Start_Time"),
                                                          D.lenient_parse("End_Time")))
    return P.leakage_guard(df, "Duration_min")[0]


# ------------------------------------------------------------------ filters
N1_CRASH = "SELECT * REPLACE (" + ", ".join(
    f"NULLIF({c}, 'UNKNOWN') AS {c}" for c in CRASH_STRINGS) + ") FROM cr"


def crashes_n1(spark, sf):
    return M.sentinel_to_null(S.crashes(spark, sf))


@register("f1_present_rows", _with(cr=CRASH, n=N1_CRASH)
          + "SELECT * FROM n WHERE traffic_control_device IS NOT NULL")
def _f1a(spark, sf):
    return R.present_rows(crashes_n1(spark, sf), "traffic_control_device")


@register("f1_missing_rows", _with(cr=CRASH, n=N1_CRASH)
          + "SELECT * FROM n WHERE traffic_control_device IS NULL")
def _f1b(spark, sf):
    return R.missing_rows(crashes_n1(spark, sf), "traffic_control_device")


@register("f2_drop_any_missing", _with(a=ACC) + "SELECT * FROM a WHERE COLUMNS(*) IS NOT NULL")
def _f2(spark, sf):
    return R.drop_rows_any_missing(S.accidents(spark, sf))


LENIENT_BOTH = ("SELECT * REPLACE (" + duck_lenient('"Start_Time"') + ' AS "Start_Time", '
                + duck_lenient('"End_Time"') + ' AS "End_Time") FROM a')


def lenient_both(spark, sf):
    df = S.accidents(spark, sf)
    return df.withColumns({"Start_Time": D.lenient_parse("Start_Time"),
                           "End_Time": D.lenient_parse("End_Time")})


@register("f3_drop_missing_subset", _with(a=ACC, b=LENIENT_BOTH)
          + 'SELECT * FROM b WHERE "Start_Time" IS NOT NULL AND "End_Time" IS NOT NULL')
def _f3(spark, sf):
    return R.drop_rows_any_missing(lenient_both(spark, sf), ["Start_Time", "End_Time"])


@register("f4_open_range", CLEAN_WITH
          + 'SELECT "Start_Time", "End_Time", "Severity", duration_min FROM c '
            "WHERE duration_min > 0 AND duration_min < 240")
def _f4(spark, sf):
    df = cleaned(spark, sf).select("Start_Time", "End_Time", "Severity", "duration_min")
    return R.open_range(df, "duration_min", 0, 240)


@register("f5_trim_equals", _with(cr=CRASH)
          + "SELECT crash_id, lighting_condition, trim(lighting_condition) = 'UNKNOWN' "
            "AS is_unknown FROM cr")
def _f5(spark, sf):
    df = S.crashes(spark, sf)
    return df.select("crash_id", "lighting_condition",
                     R.trim_equals("lighting_condition", "UNKNOWN").alias("is_unknown"))


# ----------------------------------------------------------- missing values
@register("n1_sentinel_to_null", _with(cr=CRASH, n=N1_CRASH) + "SELECT * FROM n")
def _n1(spark, sf):
    return crashes_n1(spark, sf)


N2_COLS = ["Temperature(F)", "Wind_Chill(F)", "End_Lat", "End_Lng"]


@register("n2_median_impute", _with(
    a=ACC,
    x='SELECT "ID", TRY_CAST("Temperature(F)" AS DOUBLE) AS "Temperature(F)", '
      '"Wind_Chill(F)", "End_Lat", "End_Lng" FROM a')
    + 'SELECT "ID", ' + ", ".join(
        f'COALESCE({dq(c)}, (SELECT median({dq(c)}) FROM x)) AS {dq(c)}' for c in N2_COLS)
    + " FROM x")
def _n2(spark, sf):
    df = S.accidents(spark, sf)
    df = df.select("ID", U.to_number(q("Temperature(F)")).alias("Temperature(F)"),
                   *[q(c) for c in N2_COLS[1:]])
    return M.median_impute(df, N2_COLS)


# -------------------------------------------------------------------- dates
@register("d1_parse_strict_lenient", _with(a=ACC)
          + f'SELECT "ID", {duck_lenient(dq("Start_Time"))} AS "Start_Time", '
            f'{duck_strict(dq("End_Time"))} AS "End_Time" FROM a')
def _d1(spark, sf):
    df = S.accidents(spark, sf).select("ID", "Start_Time", "End_Time")
    return D.parse_datetime(D.parse_datetime(df, "Start_Time"), "End_Time")


@register("d2_parse_datetime_columns", _with(a=ACC)
          + f'SELECT "ID", {duck_lenient(dq("Start_Time"))} AS "Start_Time", '
            f'{duck_strict(dq("End_Time"))} AS "End_Time", '
            f'{duck_strict(dq("Weather_Timestamp"))} AS "Weather_Timestamp", "Timezone" FROM a')
def _d2(spark, sf):
    df = S.accidents(spark, sf).select("ID", "Start_Time", "End_Time", "Weather_Timestamp",
                                       "Timezone")
    return D.parse_datetime_columns(df)


@register("d3_lenient_parse", _with(e=EVT)
          + f"SELECT event_id, {duck_lenient('ts_text')} AS parsed FROM e")
def _d3(spark, sf):
    return S.events(spark, sf).select("event_id", D.lenient_parse("ts_text").alias("parsed"))


@register("d4_date_parts", _with(e=EVT)
          + "SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS "
            "month, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour FROM e")
def _d4(spark, sf):
    p = D.date_parts("ts")
    return S.events(spark, sf).select("event_id", *[p[k].alias(k) for k in
                                                    ("year", "month", "day", "hour")])


@register("d5_weekday", _with(e=EVT)
          + "SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek FROM e")
def _d5(spark, sf):
    return S.events(spark, sf).select("event_id", D.date_parts("ts")["dayofweek"].alias("dayofweek"))


_VOTED = {"placed_date": "%d/%m/%Y", "rare_date": "%d/%m/%Y", "due_time": "%m/%d/%Y %H:%M"}


def _voted_sql(name: str, fmt: str) -> str:
    """The column by the order of day and month that fits more of its texts."""
    tail = fmt[len("%d/%m/%Y"):]
    month, day = (f"try_strptime({name}, '{order}/%Y{tail}')" for order in ("%m/%d", "%d/%m"))
    return (f"CASE WHEN (SELECT count({day}) > count({month}) FROM t) THEN {day} ELSE {month} END "
            f"AS {name}")


@register("d1_format_votes", """WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS placed_date,
  CASE WHEN day(o_orderdate) <= 12 OR o_totalprice > 300000
    THEN strftime(o_orderdate, '%d/%m/%Y') END AS rare_date,
  strftime(o_orderdate, '%m/%d/%Y %H:%M') AS due_time FROM orders)
SELECT o_orderkey, """ + ", ".join(_voted_sql(c, f) for c, f in _VOTED.items()) + " FROM t")
def _d1v(spark, sf):
    """D1 on texts in both orders; in ``rare_date`` few rows tell which."""
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    df = S.load_table(spark, sf, "orders").select(
        "o_orderkey", day.alias("placed_date"),
        F.when((F.dayofmonth("o_orderdate") <= 12) | (F.col("o_totalprice") > 300000), day)
        .alias("rare_date"), F.date_format("o_orderdate", "MM/dd/yyyy HH:mm").alias("due_time"))
    return D.parse_datetime_columns(df)


@register("d6_duration_minutes", _with(a=ACC, b=LENIENT_BOTH)
          + """SELECT "ID", date_diff('microsecond', "Start_Time", "End_Time") / 6e7 AS minutes
          FROM b""")
def _d6(spark, sf):
    return lenient_both(spark, sf).select(
        "ID", D.duration_minutes("Start_Time", "End_Time").alias("minutes"))


@register("d7_time_features", _with(a=ACC, b=LENIENT_BOTH)
          + f'SELECT "ID", {duck_time_features()} FROM b')
def _d7(spark, sf):
    df = D.add_time_features(lenient_both(spark, sf))
    return df.select("ID", "start_hour", "start_dayofweek", "start_month", "duration_min")


@register("d8_date_part_expansion", _with(a=ACC, b=LENIENT_BOTH)
          + 'SELECT "ID", CAST(year("Start_Time") AS INTEGER) AS "Start_Time_year", '
            'CAST(month("Start_Time") AS INTEGER) AS "Start_Time_month", '
            'CAST(day("Start_Time") AS INTEGER) AS "Start_Time_day", '
            'CAST(hour("Start_Time") AS INTEGER) AS "Start_Time_hour", "Severity" FROM b')
def _d8(spark, sf):
    df = S.accidents(spark, sf).select("ID", "Start_Time", "Severity")
    return D.expand_date_parts(df, "Start_Time")


# -------------------------------------------------------------------- units
@register("m1_clip_lower", _with(a=ACC, b=LENIENT_BOTH)
          + """SELECT "ID", CASE WHEN date_diff('microsecond', "Start_Time", "End_Time") / 6e7 < 0
          THEN 0.0 ELSE date_diff('microsecond', "Start_Time", "End_Time") / 6e7 END AS minutes
          FROM b""")
def _m1(spark, sf):
    return lenient_both(spark, sf).select("ID", U.clip_lower(
        D.duration_minutes("Start_Time", "End_Time"), 0.0).alias("minutes"))


@register("m2_to_number", _with(a=ACC)
          + 'SELECT "ID", TRY_CAST("Temperature(F)" AS DOUBLE) AS temperature, '
            'TRY_CAST("Wind_Speed(mph)" AS DOUBLE) AS wind_speed FROM a')
def _m2(spark, sf):
    return S.accidents(spark, sf).select(
        "ID", U.to_number(q("Temperature(F)")).alias("temperature"),
        U.to_number(q("Wind_Speed(mph)")).alias("wind_speed"))


def _unit_query(name, fn, src, sql_expr):
    @register(name, _with(e=EVT) + f"SELECT event_id, {sql_expr} AS converted FROM e")
    def _q(spark, sf):
        return S.events(spark, sf).select("event_id", fn(q(src)).alias("converted"))
    return _q


_unit_query("m3_fahrenheit_to_celsius", U.fahrenheit_to_celsius, "Temperature(F)",
            '("Temperature(F)" - 32.0) * 5.0 / 9.0')
_unit_query("m4_miles_to_km", U.miles_to_km, "Distance(mi)",
            f'"Distance(mi)" * CAST({U.MILE_KM!r} AS DOUBLE)')
_unit_query("m5_mph_to_ms", U.mph_to_ms, "Wind_Speed(mph)",
            f'"Wind_Speed(mph)" * CAST({U.MPH_MS!r} AS DOUBLE)')
_unit_query("m6_inch_to_mm", U.inch_to_mm, "Precipitation(in)",
            f'"Precipitation(in)" * CAST({U.INCH_MM!r} AS DOUBLE)')
_unit_query("m7_inhg_to_hpa", U.inhg_to_hpa, "Pressure(in)",
            f'"Pressure(in)" * CAST({U.INHG_HPA!r} AS DOUBLE)')

_ev_excl, _ev_conv = duck_units()


@register("m8_imperial_to_metric", _with(e=EVT) + "SELECT * EXCLUDE ("
          + ", ".join(dq(c) for c in UNIT_SOURCES if c != "Wind_Chill(F)" and c != "Visibility(mi)")
          + "), " + ",\n".join(x for x in _ev_conv.split(",\n    ")
                               if "Wind_Chill" not in x and "Visibility" not in x) + " FROM e")
def _m8(spark, sf):
    return U.convert_imperial_to_metric(S.events(spark, sf))


@register("m9_abs", _with(e=EVT) + "SELECT event_id, abs(value - 250.0) AS magnitude FROM e")
def _m9(spark, sf):
    return S.events(spark, sf).select("event_id", N.absolute(F.col("value") - 250.0).alias("magnitude"))


@register("m10_sqrt", _with(e=EVT) + "SELECT event_id, sqrt(value) AS root FROM e")
def _m10(spark, sf):
    return S.events(spark, sf).select("event_id", N.square_root("value").alias("root"))


def normal_sql(key: str) -> str:
    """DuckDB form of ``numeric.jitter``'s noise for a key text."""
    return (f"sqrt(-2.0 * ln((CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) + 1.0::DOUBLE) "
            f"/ 4294967297.0::DOUBLE)) * cos(2.0 * pi() * "
            f"CAST('0x' || substr(md5({key}), 9, 8) AS BIGINT) / 4294967296.0::DOUBLE)")


@register("m11_jitter", _with(e=EVT)
          + "SELECT event_id, value, round(value + "
          + normal_sql("'42:' || CAST(event_id AS VARCHAR)") + ", 6) AS jittered FROM e")
def _m11(spark, sf):
    return S.events(spark, sf).select("event_id", "value", F.round(
        N.jitter("value", 1.0, 42, ["event_id"]), 6).alias("jittered"))


@register("m12_band", _with(e=EVT)
          + f"SELECT event_id, CASE WHEN value / 100.0 < 0.1 THEN '{N.VERDICTS[0]}' "
            f"WHEN value / 100.0 < 0.5 THEN '{N.VERDICTS[1]}' ELSE '{N.VERDICTS[2]}' END AS verdict "
            "FROM e")
def _m12(spark, sf):
    return S.events(spark, sf).select("event_id", N.band(F.col("value") / 100.0).alias("verdict"))


@register("m13_string_functions",
          "SELECT p_partkey, trim(p_name) AS stripped, lower(p_brand) AS lowered, "
          "replace(p_name, ' ', '_') AS replaced, starts_with(p_name, 'small') AS is_small "
          "FROM part")
def _m13(spark, sf):
    df = S.load_table(spark, sf, "part")
    return df.select("p_partkey", N.strip_text("p_name").alias("stripped"),
                     N.lower_text("p_brand").alias("lowered"),
                     N.replace_text("p_name", " ", "_").alias("replaced"),
                     N.starts_with("p_name", "small").alias("is_small"))


# ------------------------------------------------------------------ profile
def _unpivot(select_sql: str, value: str) -> str:
    return (f"SELECT column_name, {value} FROM (UNPIVOT ({select_sql}) ON COLUMNS(*) "
            f"INTO NAME column_name VALUE {value})")


@register("a1_missing_share", _with(cr=CRASH, n=N1_CRASH) + _unpivot(
    "SELECT " + ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS {c}"
                          for c in CRASH_NUMERIC + CRASH_STRINGS) + " FROM n", "missing_share"))
def _a1(spark, sf):
    return A.missing_share(crashes_n1(spark, sf), CRASH_NUMERIC + CRASH_STRINGS)


@register("a2_missing_counts", _with(cr=CRASH, n=N1_CRASH) + _unpivot(
    "SELECT " + ", ".join(f"count_if({c} IS NULL) AS {c}" for c in CRASH_NUMERIC + CRASH_STRINGS)
    + " FROM n", "missing_count"))
def _a2(spark, sf):
    return A.missing_counts(crashes_n1(spark, sf), CRASH_NUMERIC + CRASH_STRINGS)


@register("a3_value_counts", _with(cr=CRASH, n=N1_CRASH)
          + "SELECT traffic_control_device AS value, count(*) AS count FROM n "
            "WHERE traffic_control_device IS NOT NULL GROUP BY 1")
def _a3(spark, sf):
    return A.value_counts(crashes_n1(spark, sf), "traffic_control_device")


@register("a4_sentinel_counts", _with(cr=CRASH) + _unpivot(
    "SELECT " + ", ".join(f"count_if(trim({c}) = 'UNKNOWN') AS {c}" for c in CRASH_STRINGS)
    + " FROM cr", "n_sentinel"))
def _a4(spark, sf):
    return A.sentinel_counts(S.crashes(spark, sf))


def _r8(x: str) -> str:
    # 8 places: the stand-in's values are multiples of 0.05, so means have
    # short exact decimals whose 7th place may be a tie for 6-place rounding
    return f"round({x}, 8)"


@register("a5_describe_numeric", _with(cr=CRASH) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, {_r8(f'avg({c})')} AS mean, "
    f"{_r8(f'stddev_samp({c})')} AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"{_r8(f'quantile_cont({c}, 0.25)')} AS q25, {_r8(f'quantile_cont({c}, 0.5)')} AS q50, "
    f"{_r8(f'quantile_cont({c}, 0.75)')} AS q75, CAST(max({c}) AS DOUBLE) AS max FROM cr"
    for c in CRASH_NUMERIC))
def _a5(spark, sf):
    out = A.describe_numeric(S.crashes(spark, sf), CRASH_NUMERIC)
    return out.withColumns({c: F.round(c, 8) for c in ("mean", "std", "q25", "q50", "q75")})


@register("a6_describe_strings", _with(
    cr=CRASH, n=N1_CRASH,
    u="SELECT column_name, value FROM (UNPIVOT (SELECT " + ", ".join(CRASH_STRINGS)
      + " FROM n) ON COLUMNS(*) INTO NAME column_name VALUE value)",
    v="SELECT column_name, value, count(*) AS n FROM u GROUP BY 1, 2")
    + "SELECT column_name, sum(n)::BIGINT AS count, count(*) AS unique, "
      "first(value ORDER BY n DESC, value ASC) AS top, max(n) AS freq FROM v GROUP BY 1")
def _a6(spark, sf):
    return A.describe_strings(crashes_n1(spark, sf))


_SPARK_TYPE = ("CASE typeof(x) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
               "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
               "WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(typeof(x)) END")


@register("a7_column_info", _with(
    cr=CRASH,
    cnt=_unpivot("SELECT " + ", ".join(f"count({c}) AS {c}" for c in CRASH_NUMERIC + CRASH_STRINGS)
                 + " FROM cr", "non_null"),
    typ="SELECT column_name, dtype FROM (UNPIVOT (SELECT " + ", ".join(
        f"(SELECT {_SPARK_TYPE} FROM (SELECT {c} AS x FROM cr LIMIT 1)) AS {c}"
        for c in CRASH_NUMERIC + CRASH_STRINGS)
    + ") ON COLUMNS(*) INTO NAME column_name VALUE dtype)")
    + "SELECT cnt.column_name, typ.dtype, cnt.non_null FROM cnt JOIN typ USING (column_name)")
def _a7(spark, sf):
    return A.column_info(S.crashes(spark, sf).select(*CRASH_NUMERIC, *CRASH_STRINGS))


@register("a8_distinct_labels", "SELECT count(DISTINCT label) AS n_labels FROM embeddings")
def _a8(spark, sf):
    return A.distinct_labels(S.load_table(spark, sf, "embeddings"), "label")


@register("a9_min_max", CLEAN_WITH
          + "SELECT min(duration_min) AS min_value, max(duration_min) AS max_value FROM c")
def _a9(spark, sf):
    return A.min_max(cleaned(spark, sf), "duration_min")


@register("a10_row_loss_report", _with(
    a=ACC, s='SELECT * EXCLUDE ("End_Lat", "End_Lng") FROM a')
    + "SELECT count(*) AS rows_before, (SELECT count(*) FROM s WHERE COLUMNS(*) IS NOT NULL) "
      "AS rows_after, count(*) - (SELECT count(*) FROM s WHERE COLUMNS(*) IS NOT NULL) "
      "AS rows_dropped FROM s")
def _a10(spark, sf):
    df, _ = P.drop_sparse_columns(S.accidents(spark, sf), 0.40)
    return R.row_loss_report(df)


# ------------------------------------------------------------- sort, top-k
@register("t1_sort_by_magnitude", _with(e=EVT)
          + "SELECT event_id, value - 250.0 AS weight, abs(value - 250.0) AS importance FROM e")
def _t1(spark, sf):
    df = S.events(spark, sf).select("event_id", (F.col("value") - 250.0).alias("weight"))
    return R.sort_by_magnitude(df, "weight", tie=["event_id"])


@register("t2_top_k", _with(e=EVT)
          + "SELECT event_id, value - 250.0 AS weight, abs(value - 250.0) AS importance FROM e "
            "ORDER BY importance DESC, event_id LIMIT 10")
def _t2(spark, sf):
    df = S.events(spark, sf).select("event_id", (F.col("value") - 250.0).alias("weight"))
    return R.top_k(R.sort_by_magnitude(df, "weight"), 10, "importance", tie=["event_id"])
