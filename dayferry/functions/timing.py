"""Durations, times of day and local time over ``timestamp_ntz`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the zone in which schedules and history are shown.
BEIJING = "Asia/Shanghai"

# Fixed value: HH:MM where either part may have one digit.
_TIME_OF_DAY = r"^(?:2[0-3]|[01]\p{Nd}|\p{Nd}):(?:[0-5]\p{Nd}|\p{Nd})\z"


def _micros_between(start: Column, end: Column) -> Column:
    # timestampdiff() would go through the session time zone; the difference of two
    # timestamp_ntz values is an interval and does not.
    gap = end - start
    whole = F.extract(F.lit("DAY"), gap).cast("bigint") * 86400
    whole = whole + F.extract(F.lit("HOUR"), gap).cast("bigint") * 3600
    whole = whole + F.extract(F.lit("MINUTE"), gap).cast("bigint") * 60
    return whole * 1_000_000 + (F.extract(F.lit("SECOND"), gap) * 1_000_000).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end as a double; 0 while there is no end."""
    return F.coalesce(_micros_between(start, end) / F.lit(1e6), F.lit(0.0))


def _parts(seconds: Column) -> tuple[Column, Column, Column]:
    return (
        F.floor(seconds / 3600).cast("string"),
        F.floor((seconds % 3600) / 60).cast("string"),
        F.floor(seconds % 60).cast("string"),
    )


def duration_text(seconds: Column) -> Column:
    """Hours, minutes and seconds without leading zero parts; ``-`` for null, 0 or NaN."""
    h, m, s = _parts(seconds)
    return (
        F.when(seconds.isNull() | (seconds == 0) | F.isnan(seconds), F.lit("-"))
        .when(seconds >= 3600, F.concat(h, F.lit("时 "), m, F.lit("分 "), s, F.lit("秒")))
        .when(F.floor((seconds % 3600) / 60) > 0, F.concat(m, F.lit("分 "), s, F.lit("秒")))
        .otherwise(F.concat(s, F.lit("秒")))
    )


def elapsed_text(start: Column, as_of: Column) -> Column:
    """Time since start in whole seconds, always with all three parts."""
    h, m, s = _parts(F.floor(_micros_between(start, as_of) / F.lit(1e6)).cast("double"))
    return F.concat(h, F.lit("时 "), m, F.lit("分 "), s, F.lit("秒"))


def valid_time_of_day(text: Column) -> Column:
    return text.rlike(_TIME_OF_DAY)


def in_time_zone(utc: Column, zone: str = BEIJING) -> Column:
    """Wall-clock time in the zone for a UTC ``timestamp_ntz``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_text(ts: Column) -> Column:
    """``yyyy/M/d HH:mm:ss``. date_format() would go through the session time zone."""
    return F.concat(
        F.year(ts).cast("string"), F.lit("/"),
        F.month(ts).cast("string"), F.lit("/"),
        F.dayofmonth(ts).cast("string"), F.lit(" "),
        F.substring(ts.cast("string"), 12, 8),
    )
