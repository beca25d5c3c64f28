"""Time expressions over ``timestamp_ntz`` columns.

Trip times carry no zone; keeping them NTZ makes every difference a plain wall-clock
difference (no daylight-saving effect) and keeps parquet min/max pushdown usable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ts_lit(value: str) -> Column:
    """A ``timestamp_ntz`` literal; folded to a constant, so it reaches PushedFilters."""
    return F.lit(value).cast("timestamp_ntz")


_SECONDS = T.DayTimeIntervalType(T.DayTimeIntervalType.SECOND, T.DayTimeIntervalType.SECOND)


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in seconds as double, keeping fractions (``epoch(b) - epoch(a)``).

    NTZ minus NTZ is a day-time interval computed on the wall-clock values, with no time
    zone involved; ``timestamp_diff`` would pass through the session zone and shift a
    time inside a daylight-saving gap by an hour.
    """
    start_c = F.col(start) if isinstance(start, str) else start
    end_c = F.col(end) if isinstance(end, str) else end
    return (end_c - start_c).cast(_SECONDS).cast("decimal(18,6)").cast("double")


def speed_mph(distance: str | Column, start: str | Column, end: str | Column) -> Column:
    """Average speed; a zero duration gives null instead of a division error."""
    dist = F.col(distance) if isinstance(distance, str) else distance
    hours = F.nullif(seconds_between(start, end), F.lit(0.0)) / F.lit(3600.0)
    return dist / hours


def day_name(ts: str | Column) -> Column:
    """Full English weekday name (``Monday``), not the 3-letter ``dayname``."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "EEEE")


def shift_years(ts: str | Column, years: int) -> Column:
    """``ts + INTERVAL 'n' YEAR``; Feb 29 clamps to Feb 28, type stays NTZ."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c + F.make_ym_interval(F.lit(years), F.lit(0))


def in_period(ts: str | Column, start: str, end: str, half_open: bool = False) -> Column:
    """``ts BETWEEN start AND end`` (end at midnight, as the reference), or
    ``start <= ts < end + 1 day`` when ``half_open``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if half_open:
        return (c >= ts_lit(start)) & (c < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return c.between(ts_lit(start), ts_lit(end))
