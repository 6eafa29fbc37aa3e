"""Date and time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = ("minute", "hour", "day")


def boundaries_between(unit: str, start: Column, end: Column) -> Column:
    """How many ``unit`` boundaries lie between two times.

    00:59 to 01:01 crosses one hour boundary, although only two minutes pass;
    cutting both sides down to the unit first gives that reading.
    """
    if unit not in _UNITS:
        raise ValueError(f"unit must be one of {_UNITS}, not {unit!r}")
    if unit == "day":
        return F.datediff(F.to_date(end), F.to_date(start))
    return F.timestamp_diff(unit.upper(), F.date_trunc(unit, start), F.date_trunc(unit, end))


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def clock_key(moment: Column) -> Column:
    """Key of the time dimension: hour * 100 + minute, as its generator writes it."""
    return F.hour(moment) * 100 + F.minute(moment)


def minute_of_day(moment: Column) -> Column:
    """hour * 60 + minute: the other reading of a time key (see README, quirks)."""
    return F.hour(moment) * 60 + F.minute(moment)
