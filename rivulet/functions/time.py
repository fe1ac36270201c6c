"""Time helpers. Event time is a timestamp column; days are UTC days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def to_millis(seconds: Column) -> Column:
    return seconds.cast("long") * 1000


def day_number(rt: Column) -> Column:
    """Days since the epoch."""
    return F.unix_date(rt.cast("date"))


def next_midnight(rt: Column) -> Column:
    return F.date_trunc("day", rt) + F.expr("interval 1 day")


def seconds(duration: str) -> float:
    """Length of an interval text such as ``"5 minutes"`` or ``"90 days"``."""
    # Seconds per unit.
    units = {
        "millisecond": 0.001,
        "second": 1,
        "minute": 60,
        "hour": 3600,
        "day": 86400,
        "week": 604800,
    }
    number, unit = duration.split()
    return float(number) * units[unit.rstrip("s")]


def micros(duration: str) -> int:
    return round(seconds(duration) * 1_000_000)


def epoch_micros(rt: Column) -> Column:
    return F.unix_micros(rt.cast("timestamp"))


def floor_div(value: Column, width: int) -> Column:
    """``value // width`` on longs, exact also for negative values."""
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


def interval(duration: str) -> Column:
    """The duration as a day-time interval, to add to a timestamp."""
    return F.make_dt_interval(secs=F.lit(seconds(duration)))
