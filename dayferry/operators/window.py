"""The rolling day window: the N days that end with ``as_of``, inclusive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.operators.project import column
from dayferry.registry import check_days

_TIME_TYPES = (T.DateType, T.TimestampNTZType, T.TimestampType, T.StringType)


def window_bounds(as_of: dt.date, days: int) -> tuple[dt.date, dt.date]:
    """First and last day of the window."""
    return as_of - dt.timedelta(days=check_days(days) - 1), as_of


def time_type(df: DataFrame, time_column: str) -> str:
    """The type of the time column: a date, a timestamp, or text that starts yyyy-MM-dd."""
    field = next((f for f in df.schema.fields if f.name.lower() == time_column.lower()), None)
    if field is None:
        raise ValueError(f"no time column {time_column!r}")
    if not isinstance(field.dataType, _TIME_TYPES):
        kind = field.dataType.simpleString()
        raise ValueError(f"time column {time_column!r} is {kind}, not a date or timestamp")
    return field.dataType.simpleString()


def zone_midnight(day: dt.date, zone: str) -> dt.datetime:
    """The start of a day in a zone, as UTC; the first moment of the day where clocks skip midnight."""
    start = dt.datetime.combine(day, dt.time(), ZoneInfo(zone)).astimezone(dt.UTC)
    return start.replace(tzinfo=None)


def today(zone: str, now: dt.datetime | None = None) -> dt.date:
    """The day it is in a zone, for the ``as_of`` of a job that runs by that zone's clock."""
    return (now or dt.datetime.now(dt.UTC)).astimezone(ZoneInfo(zone)).date()


def _bounds(df: DataFrame, kind: str, first: dt.date, last: dt.date, zone: str | None) -> tuple[Column, Column]:
    """Literals of the column's type: where the first day starts, and the day after the last one."""
    after = last + dt.timedelta(days=1)
    if zone is None:
        return F.lit(first).cast(kind), F.lit(after).cast(kind)
    _check_zoned(df, kind)
    texts = [zone_midnight(d, zone).isoformat(" ") for d in (first, after)]
    lower, upper = (F.lit(t).cast("timestamp_ntz").cast(kind) for t in texts)
    return lower, upper


def _check_zoned(df: DataFrame, kind: str) -> None:
    utc = df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z")
    if not (kind == "timestamp_ntz" or (kind == "timestamp" and utc)):
        raise ValueError(f"days of a zone need a time in UTC: timestamp_ntz, or timestamp in a UTC session, not {kind}")


def day_of(df: DataFrame, time_column: str, zone: str | None = None) -> Column:
    """The day of each row, by the stored time or by a zone's clock; null where it can't be read."""
    t = column(time_column)
    if zone is None:
        return t.try_cast("date")
    _check_zoned(df, time_type(df, time_column))
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), t.cast("timestamp_ntz")))


def between_days(df: DataFrame, time_column: str, first: dt.date, last: dt.date, zone: str | None = None) -> DataFrame:
    """Rows of the days first..last, by the stored time or, for times in UTC, by a zone's days.

    A plain range on the stored column: it prunes partitions, skips Parquet row groups,
    and reaches a JDBC source unchanged. Text compares as text; rows whose text does not start
    with a date as yyyy-MM-dd belong to no day.
    """
    return in_days(df, time_column, [first + dt.timedelta(days=i) for i in range((last - first).days + 1)], zone)


def in_days(df: DataFrame, time_column: str, days: Iterable[dt.date], zone: str | None = None) -> DataFrame:
    """Rows of the given days: a range for each run of days without a gap, any of which pushes down as above."""
    kind, t = time_type(df, time_column), column(time_column)
    runs: list[list[dt.date]] = []
    for day in sorted(set(days)):
        if runs and day - runs[-1][1] == dt.timedelta(days=1):
            runs[-1][1] = day
        else:
            runs.append([day, day])
    ranges = [_bounds(df, kind, first, last, zone) for first, last in runs]
    inside = reduce(Column.__or__, [(t >= a) & (t < b) for a, b in ranges]) if ranges else F.lit(False)
    return _dated(df.where(inside), time_column, kind)


def undated(df: DataFrame, time_column: str) -> DataFrame:
    """Rows without a readable day, which no window can hold: a null time, or text that is no padded date.

    For a date or timestamp a null check, which the Parquet reader answers from its statistics.
    """
    kind, t = time_type(df, time_column), column(time_column)
    return df.where(~F.coalesce(_is_iso(t), F.lit(False)) if kind == "string" else t.isNull())


def rolling_window(
    df: DataFrame, time_column: str, days: int, as_of: dt.date | None = None, zone: str | None = None
) -> DataFrame:
    """Rows of the last N days up to as_of; days of a zone need an as_of.

    Without as_of the window ends with the newest day in the data. That bound is a scalar
    subquery over the time column alone; its value still reaches the Parquet reader at run
    time, but it cannot prune partitions, so a production run names its as_of.
    """
    if as_of is not None:
        return between_days(df, time_column, *window_bounds(as_of, days), zone)
    if zone is not None:
        raise ValueError("a window of a zone's days needs an as_of")
    kind = time_type(df, time_column)
    first = F.date_sub(_newest(time_column, kind), check_days(days) - 1).cast(kind)
    return _dated(df.where(column(time_column) >= df.agg(first).scalar()), time_column, kind)


def _dated(df: DataFrame, time_column: str, kind: str) -> DataFrame:
    return df.where(_is_iso(column(time_column))) if kind == "string" else df


def _is_iso(text: Column) -> Column:
    # Only zero-padded dates sort as text the way they sort as dates.
    return F.substring(text, 1, 10) == text.try_cast("date").cast("string")


def _newest(time_column: str, kind: str) -> Column:
    t = column(time_column)
    return F.max(F.when(_is_iso(t), t.try_cast("date"))) if kind == "string" else F.to_date(F.max(t))


def newest_day(df: DataFrame, time_column: str) -> Column:
    """The newest day in the data, as a scalar subquery for use in another frame."""
    return df.agg(_newest(time_column, time_type(df, time_column))).scalar()
