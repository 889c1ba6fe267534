"""Time-of-day helpers: text or timestamp <-> BIGINT seconds since midnight.

All are Spark SQL expressions (JVM side, inside whole-stage codegen); the
``*_sql`` forms return the text for use in ``selectExpr``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pattern that accepts one- or two-digit fields ("8:05:00" and "08:05:00").
TIME_PATTERN = "H:m:s"


def time_literal(text: str) -> int:
    """Seconds of day of a ``HH:MM:SS`` literal (a TIME constant)."""
    h, m, s = (int(p) for p in text.split(":"))
    if not (0 <= h < 24 and 0 <= m < 60 and 0 <= s < 60):
        raise ValueError(f"not a time of day: {text!r}")
    return h * 3600 + m * 60 + s


def seconds_of_day_sql(ts: str) -> str:
    """hour*3600 + minute*60 + second of a timestamp, fraction floored."""
    return f"CAST(hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}) AS BIGINT)"


def parse_time_sql(text: str, coerce: bool = False) -> str:
    """Seconds of day of a time text.

    ``coerce=False`` behaves like a typed TIME column: a malformed value fails
    the query (ANSI). ``coerce=True`` is the tolerant ``%H:%M:%S`` reading of
    the dataframe-library forms: one or two digits per field, hour <= 23,
    minute <= 59, second <= 61 (60 and 61 roll into the next minute, and past
    midnight into the next day's time), no blanks or fractions; anything else
    becomes NULL.
    """
    if not coerce:
        return seconds_of_day_sql(f"to_timestamp(trim({text}), '{TIME_PATTERN}')")
    t = f"({text})"
    h, m, sec = (f"try_cast(try_element_at(split({t}, ':'), {i}) AS INT)" for i in (1, 2, 3))
    return (f"CASE WHEN {t} RLIKE '^[0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}$' "
            f"AND {h} <= 23 AND {m} <= 59 AND {sec} <= 61 "
            f"THEN CAST(({h} * 3600 + {m} * 60 + {sec}) % 86400 AS BIGINT) END")


def format_time_sql(seconds: str, pad_hour: bool = True) -> str:
    """``HH:MM:SS`` (or ``H:MM:SS``) text of seconds of day; NULL stays NULL."""
    fmt = "%02d:%02d:%02d" if pad_hour else "%d:%02d:%02d"
    s = f"({seconds})"
    return (f"CASE WHEN {s} IS NULL THEN CAST(NULL AS STRING) ELSE format_string('{fmt}', "
            f"CAST(floor({s} / 3600) AS INT), CAST(floor(({s} % 3600) / 60) AS INT), "
            f"CAST({s} % 60 AS INT)) END")


def seconds_of_day(ts: str) -> Column:
    return F.expr(seconds_of_day_sql(ts))


def parse_time(text: str, coerce: bool = False) -> Column:
    return F.expr(parse_time_sql(text, coerce))


def format_time(seconds: str, pad_hour: bool = True) -> Column:
    return F.expr(format_time_sql(seconds, pad_hour))


def seconds_to_hours_sql(seconds: str) -> str:
    """Hours as DOUBLE; divide once, after summing integer seconds."""
    return f"CAST({seconds} AS DOUBLE) / 3600.0D"

