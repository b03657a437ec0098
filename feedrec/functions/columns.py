"""Column expressions shared by the jobs. All built-in Spark functions, so they
stay inside whole-stage codegen; none of them needs a Python UDF."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original jobs' for identical results:
# the tag separators are the ASCII comma and the full-width comma "，";
# a token is dropped when the whole token is whitespace, the word "其他"
# ("other"), or a run of the characters \ , | . ， 。
TAG_SEPARATOR = "[,，]"
TAG_STOP_PATTERN = r"[ \t\n\x0B\f\r]+|其他|[\\,|.，。]+"

# Default cell values of a theme that is missing from the catalogue, per field.
THEME_DEFAULTS = {"quality": "0", "grade": "3", "ctime": "1514796503"}

# Scale used whenever a floating weight is ranked, compared or normalised:
# both Spark and the SQL twin rank on round(x, 9) and emit round(x, 6).
RANK_DIGITS = 9
OUT_DIGITS = 6


def java_split(col: Column | str, sep_regex: str) -> Column:
    """``String.split(regex)`` as the JVM does it: trailing empty fields are
    removed, an empty input gives one empty field, and an input made only of
    separators gives no field at all (Spark's ``split`` keeps trailing
    empties)."""
    c = F.col(col) if isinstance(col, str) else col
    stripped = F.regexp_replace(c, f"(?:{sep_regex})+\\z", "")
    return (F.when(c == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, sep_regex)))


def tokenize_tags(col: Column | str) -> Column:
    """Split on either comma, drop stop tokens; order and duplicates kept,
    an empty token between two commas survives."""
    return F.filter(java_split(col, TAG_SEPARATOR),
                    lambda t: ~t.rlike(f"^(?:{TAG_STOP_PATTERN})\\z"))


def act_weight(col: Column | str, scan: float, download: float) -> Column:
    """Scan / Download / anything else -> scan / download / 0."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(c == "Scan", F.lit(float(scan)))
            .when(c == "Download", F.lit(float(download)))
            .otherwise(F.lit(0.0)))


def epoch_seconds(day: str) -> int:
    """UTC midnight of ``day`` (yyyy-MM-dd) as epoch seconds."""
    d = _dt.datetime.fromisoformat(day).replace(tzinfo=_dt.timezone.utc)
    return int(d.timestamp())


def age_days(time_col: Column | str, as_of: str, fallback_days: int,
             lenient: bool = False) -> Column:
    """Whole days between the event time and ``as_of`` (integer division,
    truncated toward zero). An unparseable time counts as exactly
    ``fallback_days`` old. ``lenient`` also accepts a bare date prefix."""
    c = F.col(time_col) if isinstance(time_col, str) else time_col
    ts = F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss"))
    if lenient:
        ts = F.coalesce(ts, F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")))
    # both ends are read in the session time zone, so the difference does not
    # depend on it
    now = F.to_timestamp(F.lit(f"{as_of} 00:00:00"), "yyyy-MM-dd HH:mm:ss")
    secs = F.unix_seconds(now) - F.unix_seconds(ts)
    return F.when(ts.isNull(), F.lit(int(fallback_days)).cast("long")) \
        .otherwise((secs / F.lit(86400)).cast("long"))


def time_decay(time_col: Column | str, as_of: str, k: float, fallback_days: int,
               lenient: bool = False) -> Column:
    """1 / (1 + k * whole_days(as_of - time))."""
    return F.lit(1.0) / (F.lit(1.0) + F.lit(float(k)) * age_days(time_col, as_of, fallback_days, lenient))


def r9(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, RANK_DIGITS)


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, OUT_DIGITS)


def nonempty(col: str) -> Column:
    return F.col(col).isNotNull() & (F.col(col) != "")


def split_limit(col: Column | str, sep: str, limit: int) -> Column:
    """Split with a limit; the last field keeps the remainder."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(c, sep, limit)
