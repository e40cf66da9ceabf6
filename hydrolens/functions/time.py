"""Time buckets and time filters.

The session runs in UTC. `as_of` is the report's "now": a datetime, a Column, or None for the wall
clock. Reports never read the clock by themselves, so a run can be repeated.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

Moment = Column | datetime | date | str | None
Range = tuple[Moment, Moment] | None

_UNITS = {"m": "minute", "min": "minute", "h": "hour", "d": "day", "w": "week", "mon": "month"}


def parse_width(width: str) -> tuple[int, str]:
    """'5m' or '5 minutes' -> (5, 'minute')."""
    found = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", width.lower())
    if not found:
        raise ValueError(f"not a bucket width: {width!r}")
    unit = _UNITS.get(found[2], found[2])
    if unit not in {"second", "minute", "hour", "day", "week", "month"}:
        raise ValueError(f"not a bucket unit: {width!r}")
    return int(found[1]), unit


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def micros_of(width: str) -> int:
    """Microseconds of a width of fixed length; months have none."""
    n, unit = parse_width(width)
    if unit not in _SECONDS:
        raise ValueError(f"not of fixed length: {width!r}")
    return n * _SECONDS[unit] * 1_000_000


def time_bucket(width: str, name: str, dtype: T.DataType) -> Column:
    """Start of the bucket that holds column `name`, in the column's own type.

    Minutes, hours and days are aligned to the epoch, weeks start on Monday, months on the 1st.
    """
    n, unit = parse_width(width)
    col = F.col(name)
    if unit == "month":
        if n != 1:
            raise ValueError("only single-month buckets are supported")
        # Through the date, so that no time zone comes into it where the type has none.
        return F.date_trunc("month", col) if isinstance(dtype, T.TimestampType) else F.trunc(col.cast("date"), "MM").cast(dtype)
    if isinstance(dtype, T.DateType):
        days = {"day": n, "week": 7 * n}.get(unit)
        if days is None:
            raise ValueError("a date has no buckets below a day")
        # 1970-01-01 was a Thursday, so Monday weeks are shifted by four days.
        shift = 4 if unit == "week" else 0
        return F.date_sub(col, F.pmod(F.unix_date(col) - shift, F.lit(days)).cast("int"))
    start = {"startTime": "4 days"} if unit == "week" else {}
    return F.window(col, f"{n} {unit}", **start).start.cast(dtype)


def bucketed(df: DataFrame, width: str, name: str) -> Column:
    """`time_bucket` with the type taken from the frame."""
    return time_bucket(width, name, df.schema[name].dataType)


def moment(value: Moment, dtype: T.DataType) -> Column:
    """A bound as a Column of the time column's type; None is the wall clock, read once here.

    A report may run several jobs over one input, which must all see the same bound. A datetime
    without a zone is taken as it reads, whatever the zone of the Python process.
    """
    if value is None:
        value = datetime.now(timezone.utc)
    if isinstance(value, datetime) and value.tzinfo is None:
        value = value.isoformat(sep=" ")
    return (value if isinstance(value, Column) else F.lit(value)).cast(dtype)


def in_range(df: DataFrame, name: str, rng: Range) -> DataFrame:
    """Closed interval on a time column; None keeps everything, as does an open end."""
    if rng is None:
        return df
    dtype = df.schema[name].dataType
    lo, hi = rng
    if lo is not None:
        df = df.where(F.col(name) >= moment(lo, dtype))
    if hi is not None:
        df = df.where(F.col(name) <= moment(hi, dtype))
    return df


def ago(as_of: Moment, interval: str, dtype: T.DataType) -> Column:
    """`as_of - interval`, e.g. ago(now, '10 minutes', type)."""
    base = moment(as_of, T.TimestampNTZType())
    return (base - F.expr(f"INTERVAL {interval}")).cast(dtype)


def since(df: DataFrame, name: str, as_of: Moment, interval: str) -> DataFrame:
    """Rows strictly newer than `as_of - interval`."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DateType):
        # A date is newer than a moment when its midnight is: compare as timestamps, but keep a
        # plain date bound beside it so that the scan can skip row groups and partitions.
        bound = ago(as_of, interval, T.TimestampNTZType())
        return df.where((F.col(name) >= F.to_date(bound)) & (F.col(name).cast("timestamp_ntz") > bound))
    return df.where(F.col(name) > ago(as_of, interval, dtype))


def latest(df: DataFrame, name: str, plus: str | None = None) -> Column:
    """Newest value of a time column, as a scalar subquery usable as `as_of`."""
    value = F.max(name).cast("timestamp_ntz")
    return df.agg((value + F.expr(f"INTERVAL {plus}") if plus else value).alias("as_of")).scalar()
