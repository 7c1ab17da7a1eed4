"""Date parsing and date features.

All timestamps are ``timestamp_ntz``: the inputs are naive wall-clock times,
so neither the session zone nor daylight saving may shift them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the reference: the strict format (%Y-%m-%d %H:%M:%S), the
# failure share above which the whole column is parsed again leniently, and
# the lower-cased names that look like dates but are not.
STRICT_FORMAT = "yyyy-MM-dd HH:mm:ss"
LENIENT_AFTER_SHARE = 0.05
DATETIME_NAME_SKIP = frozenset({"timezone"})

# Lenient parse: ISO forms through the cast (date, date time, 'T'
# separator, up to nine fraction digits), then these patterns in order.
LENIENT_FORMATS = ("MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy")
# The same with the day first, for columns whose values vote for it.
DAY_FIRST_FORMATS = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy")

_TS_TYPES = (T.TimestampType, T.TimestampNTZType)


def is_datetime(df: DataFrame, name: str) -> bool:
    return name in df.columns and isinstance(df.schema[name].dataType, _TS_TYPES)


# Digits of a date, and what else the formatter accepts there: longer years
# and signs.
_FIELDS = {"yyyy": ("(?!0000)[0-9]{4}", "[-+]?[0-9]{4,}"),
           **{f: ("[0-9]{2}", "[0-9]{2}") for f in ("MM", "dd", "HH", "mm", "ss")}}


def _shapes(fmt: str) -> tuple[str, str] | None:
    """(pattern of the usual texts, pattern of all texts that ``fmt`` can
    fit); nothing for formats of other fields."""
    parts = re.findall("[A-Za-z]+|[^A-Za-z]+", fmt)
    words = [p for p in parts if p.isalpha()]
    if len(set(words)) < len(words) or not {"yyyy", "MM", "dd"} <= set(words) <= set(_FIELDS) \
            or re.search("[^A-Za-z/: -]", fmt) or ("mm" in words) != ("HH" in words) \
            or ("ss" in words and "mm" not in words):
        return None
    return tuple(r"\A" + "".join(_FIELDS[p][i] if p in _FIELDS else p for p in parts) + r"\z"
                 for i in (0, 1))


def _as_iso(s: Column, fmt: str) -> Column:
    """A usual text of ``fmt`` with its fields in ISO order."""
    if fmt == STRICT_FORMAT:
        return s

    def part(field: str) -> Column:
        return F.substring(s, fmt.index(field) + 1, len(field)) if field in fmt else F.lit("00")

    return F.concat(part("yyyy"), F.lit("-"), part("MM"), F.lit("-"), part("dd"), F.lit(" "),
                    part("HH"), F.lit(":"), part("mm"), F.lit(":"), part("ss"))


def parse_ntz(s: Column, fmt: str) -> Column:
    """Text -> wall-clock time in any session zone; bad text is missing.

    A text of the usual digits goes through the cast from ISO, which raises
    nothing inside; one that cannot fit is missing without a try, as the
    formatter's exception costs more than a row.  Only the rest meets the
    formatter.
    """
    shapes = _shapes(fmt)
    if shapes is None:
        return _formatted_ntz(s, fmt)
    usual, possible = shapes
    return F.when(s.rlike(usual), _as_iso(s, fmt).try_cast("timestamp_ntz")).when(
        s.rlike(possible), _formatted_ntz(s, fmt))


def _formatted_ntz(s: Column, fmt: str) -> Column:
    """The text is read as if at offset zero and rebuilt from its microseconds
    since 1970, so no zone's rules touch it."""
    at_zero = F.try_to_timestamp(F.concat(s, F.lit(" +0000")), F.lit(fmt + " xx"))
    seconds = (F.unix_micros(at_zero) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def strict_parse(c: Column | str, fmt: str = STRICT_FORMAT) -> Column:
    """Exact format or missing (bad text never raises)."""
    c = F.col(c) if isinstance(c, str) else c
    return parse_ntz(c.cast("string"), fmt)


# Text of the usual digits of any form with two slashes: the form is told by
# its length, the order of day and month by nothing.
_SLASHED = (r"\A[0-9]{2}/[0-9]{2}/(?!0000)[0-9]{4}"
            r"( [0-9]{2}:[0-9]{2}(:[0-9]{2})?)?\z")


def _slashed_ntz(s: Column, day_first: bool) -> Column:
    """A usual slashed text as time; the cast fills a missing time with zeros."""
    month, day = (4, 1) if day_first else (1, 4)
    return F.concat(F.substring(s, 7, 4), F.lit("-"), F.substring(s, month, 2), F.lit("-"),
                    F.substring(s, day, 2), F.substring(s, 11, 9)).try_cast("timestamp_ntz")


def lenient_parse(c: Column | str, day_first: bool = False) -> Column:
    """``to_datetime(errors='coerce')``: any known form, else missing.  Text
    with the day and the month in the other order is missing."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.trim(c.cast("string"))
    rest = [parse_ntz(s, f) for f in (DAY_FIRST_FORMATS if day_first else LENIENT_FORMATS)]
    return F.coalesce(s.try_cast("timestamp_ntz"), F.when(s.contains("/"), F.when(
        s.rlike(_SLASHED), _slashed_ntz(s, day_first)).otherwise(F.coalesce(*rest))))


def format_mask(c: Column | str) -> Column:
    """Which forms a text fits, as bits: 1 ISO, then the month-first patterns,
    then the day-first ones.  Zero fits none; missing text is missing.  Only
    text with two slashes is tried against the patterns, and of usual digits
    only against the one of its length, in both orders."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.trim(c.cast("string"))
    iso = s.try_cast("timestamp_ntz").isNotNull().cast("int")
    form = F.when(F.length(s) == 19, 2).when(F.length(s) == 16, 4).otherwise(8)
    usual = (F.when(_slashed_ntz(s, False).isNotNull(), form).otherwise(0)
             + F.when(_slashed_ntz(s, True).isNotNull(), form * (1 << len(LENIENT_FORMATS)))
             .otherwise(0))
    bits = sum((F.when(parse_ntz(s, f).isNotNull(), 2 << i).otherwise(0)
                for i, f in enumerate(LENIENT_FORMATS + DAY_FIRST_FORMATS)), F.lit(0))
    return (F.when(s.isNull(), None).when(~s.contains("/"), iso).when(s.rlike(_SLASHED), usual)
            .when(s.rlike("^[0-9]+/[0-9]+/"), bits).otherwise(iso))


MONTH_BITS = sum(2 << i for i in range(len(LENIENT_FORMATS)))
DAY_BITS = MONTH_BITS << len(LENIENT_FORMATS)


def mask_fails(mask: Column, day_first: bool) -> Column:
    """Is a text of this ``format_mask`` missing after ``lenient_parse``?"""
    known = 1 | (DAY_BITS if day_first else MONTH_BITS)
    return F.coalesce(mask, F.lit(0)).bitwiseAND(known) == 0


def vote_aggregates(c: Column | str, name: str, mask: Column | None = None) -> list[Column]:
    """Aggregates of a text column: ``<name>_all``, the forms that fit every
    value of a known form, and the values for either order of day and month.
    ``mask``: its ``format_mask`` where a projection already holds it."""
    mask = format_mask(c) if mask is None else mask
    return [F.bit_and(F.when(mask > 0, mask)).alias(f"{name}_all"),
            F.count_if(mask.bitwiseAND(MONTH_BITS) > 0).alias(f"{name}_month"),
            F.count_if(mask.bitwiseAND(DAY_BITS) > 0).alias(f"{name}_day")]


def votes_day_first(row, name: str) -> bool:
    """The order that fits more of the column's values; month first if equal,
    as when no value tells them apart."""
    return row[f"{name}_day"] > row[f"{name}_month"]


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _as_timestamp(df: DataFrame, name: str, expr: Column) -> Column:
    return _q(name).cast("timestamp_ntz") if is_datetime(df, name) else expr


def datetime_like_columns(df: DataFrame, skip=DATETIME_NAME_SKIP) -> list[str]:
    """Names containing 'time' or 'date' (any case), minus ``skip``."""
    return [c for c in df.columns
            if ("time" in c.lower() or "date" in c.lower()) and c.lower() not in skip]


def parse_datetime_columns(df: DataFrame, cols: list[str] | None = None,
                           fmt: str = STRICT_FORMAT,
                           share: float = LENIENT_AFTER_SHARE) -> DataFrame:
    """Strict parse; a column whose missing share after the strict
    parse is above ``share`` is parsed again leniently as a whole.

    One aggregate job measures every column's share and lets its values vote
    on the order of day and month; the result is a single lazy projection.
    """
    cols = datetime_like_columns(df) if cols is None else [c for c in cols if c in df.columns]
    if not cols:
        return df
    strict = {c: _as_timestamp(df, c, strict_parse(_q(c), fmt)) for c in cols}
    texts = {c: i for i, c in enumerate(cols) if not is_datetime(df, c)}
    # one projection parses each value once, whatever reads it above
    parsed = df.select(*[strict[c].isNull().alias(f"s{i}") for i, c in enumerate(cols)],
                       *[format_mask(_q(c)).alias(f"v{i}") for c, i in texts.items()])
    row = parsed.agg(*[F.avg(F.col(f"s{i}").cast("double")).alias(f"s{i}")
                       for i in range(len(cols))],
                     *[v for c, i in texts.items()
                       for v in vote_aggregates(_q(c), f"v{i}", F.col(f"v{i}"))]).first()
    exprs = {}
    for i, c in enumerate(cols):
        frac = row[f"s{i}"]
        if frac is not None and frac > share and not is_datetime(df, c):
            exprs[c] = lenient_parse(_q(c), votes_day_first(row, f"v{i}"))
        else:
            exprs[c] = strict[c]
    return df.withColumns(exprs)


def parse_datetime(df: DataFrame, col: str, fmt: str = STRICT_FORMAT,
                   share: float = LENIENT_AFTER_SHARE) -> DataFrame:
    """D1 for one column."""
    return parse_datetime_columns(df, [col], fmt, share)


def date_parts(c: Column | str) -> dict[str, Column]:
    """Hour, month, year, day of month, day of week (Monday = 0)."""
    c = F.col(c) if isinstance(c, str) else c
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c),
            "hour": F.hour(c), "dayofweek": F.weekday(c)}


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """(end - start) in minutes with fractions, exact to the microsecond."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("MICROSECOND", start, end) / 6e7


def add_time_features(df: DataFrame, start: str = "Start_Time",
                      end: str = "End_Time") -> DataFrame:
    """start_hour, start_dayofweek, start_month if ``start`` is a
    datetime; duration_min clipped at 0 if both are."""
    from tabloom.functions.units import clip_lower

    out = {}
    if is_datetime(df, start):
        p = date_parts(start)
        out.update(start_hour=p["hour"], start_dayofweek=p["dayofweek"],
                   start_month=p["month"])
    if is_datetime(df, start) and is_datetime(df, end):
        out["duration_min"] = clip_lower(duration_minutes(start, end), 0.0)
    return df.withColumns(out) if out else df


def expand_date_parts(df: DataFrame, col: str) -> DataFrame:
    """Lenient parse, add ``<col>_year/_month/_day/_hour``, drop ``col``."""
    ts = _as_timestamp(df, col, lenient_parse(_q(col)))
    return (df.withColumns({
        f"{col}_year": F.year(ts), f"{col}_month": F.month(ts),
        f"{col}_day": F.dayofmonth(ts), f"{col}_hour": F.hour(ts)})
        .drop(col))
