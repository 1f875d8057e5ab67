"""Time helpers.  All of them keep the type of the input timestamp
(``timestamp`` or ``timestamp_ntz``); the session zone is UTC (see
``tape.session``), so both types bucket on the same wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(v, dtype: str = "timestamp") -> Column:
    """A wall-clock timestamp literal read in the session zone (UTC).  A naive
    ``datetime`` goes through ISO text, so the Python process's own time zone
    never shifts it."""
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        v = v.isoformat(sep=" ")
    return F.lit(v).cast(dtype)


def ts_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def epoch_micros(ts) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def epoch_millis(ts) -> Column:
    """Whole milliseconds since the epoch (truncating, like ``date_diff('millisecond')``)."""
    return F.unix_millis(col(ts).cast("timestamp"))


def millis_between(start, end) -> Column:
    """H7: ``end - start`` in whole milliseconds, counted on millisecond boundaries."""
    return epoch_millis(end) - epoch_millis(start)


def from_epoch_micros(us) -> Column:
    """Microseconds since the epoch → timestamp."""
    return F.timestamp_micros(col(us))


def tick_time_text(ts) -> Column:
    """The tick text form ``yyyy-MM-dd HH:mm:ss.SSSSSS``."""
    from tape.schemas import CSV_TIMESTAMP_FORMAT
    return F.date_format(col(ts), CSV_TIMESTAMP_FORMAT)


def micros_between(start, end) -> Column:
    """Exact difference in microseconds (the tick resolution)."""
    return epoch_micros(end) - epoch_micros(start)


def truncate(ts, unit: str, dtype: T.DataType | None = None) -> Column:
    """H2/H4: ``date_trunc`` that returns the input's timestamp type."""
    out = F.date_trunc(unit, col(ts))
    return out.cast(dtype) if dtype is not None else out


def bucket(ts, seconds: int, dtype: T.DataType | None = None) -> Column:
    """H3: floor to an epoch-aligned bucket of ``seconds`` (5 min = 300)."""
    if seconds in _UNITS.values() and seconds != 1:
        unit = {v: k for k, v in _UNITS.items()}[seconds]
        return truncate(ts, unit, dtype)
    width = seconds * 1_000_000
    us = epoch_micros(ts)
    out = F.timestamp_micros(us - F.pmod(us, F.lit(width)))
    return out.cast(dtype) if dtype is not None else out


def to_date(ts) -> Column:
    """H1/H9: calendar day of a tick (partition key)."""
    return F.to_date(col(ts))


def time_of_day(ts) -> Column:
    """H6: wall-clock time without the date, ``HH:mm:ss``."""
    return F.date_format(col(ts), "HH:mm:ss")


def hour_in(ts, lo: int, hi: int) -> Column:
    """``lo <= hour(ts) < hi``."""
    h = F.hour(col(ts))
    return (h >= lo) & (h < hi)


def _utc(v):
    """A bound as naive UTC: zoned datetimes and ISO text with an offset are
    converted, dates and anything else stay."""
    if isinstance(v, str):
        try:
            v = dt.datetime.fromisoformat(v)
        except ValueError:
            return v
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def time_filter(ts, start=None, end=None, date_col: str | None = None) -> Column:
    """B11 + O5: closed range on the timestamp, repeated on the day
    partition column so Parquet partition pruning applies.  Both bounds are
    taken in UTC, the zone of the ticks and of their days."""
    c = F.lit(True)
    for bound, at_least in ((_utc(start), True), (_utc(end), False)):
        if bound is None:
            continue
        value = ts_literal(bound, "timestamp_ntz") if isinstance(bound, dt.datetime) else F.lit(bound)
        c = c & (col(ts) >= value if at_least else col(ts) <= value)
        if date_col:
            day = F.lit(_day(bound))
            c = c & (F.col(date_col) >= day if at_least else F.col(date_col) <= day)
    return c


def _day(v):
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, str):
        return dt.date.fromisoformat(v[:10])
    return v


def weekdays(start, end) -> Column:
    """The Monday–Friday dates from ``start`` to ``end`` (inclusive) as an array."""
    days = F.sequence(col(start), col(end), F.expr("INTERVAL 1 DAY"))
    return F.filter(days, lambda d: F.weekday(d) < 5)


def session_bounds(day) -> tuple[Column, Column]:
    """Market open and close of a date column (UTC wall clock)."""
    from tape.schemas import SESSION_CLOSE, SESSION_OPEN
    d = col(day).cast("timestamp_ntz")
    o = d + F.make_dt_interval(F.lit(0), F.lit(SESSION_OPEN[0]), F.lit(SESSION_OPEN[1]))
    c = d + F.make_dt_interval(F.lit(0), F.lit(SESSION_CLOSE[0]), F.lit(SESSION_CLOSE[1]))
    return o, c
