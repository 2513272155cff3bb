"""Duration parsing shared by operators ("5 seconds", "1 hour", "10 min", "500 ms", "1 day")."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "ms": 0.001, "millisecond": 0.001, "milliseconds": 0.001,
    "s": 1, "sec": 1, "second": 1, "seconds": 1,
    "m": 60, "min": 60, "minute": 60, "minutes": 60,
    "h": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "day": 86400, "days": 86400,
}


def to_seconds(duration: str | int | float) -> float:
    """Seconds in a duration string; numbers are taken as seconds."""
    if isinstance(duration, (int, float)):
        return duration
    m = re.fullmatch(r"\s*(-?\d+(?:\.\d+)?)\s*([a-zA-Z]+)\s*", duration)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"bad duration {duration!r}")
    v = float(m.group(1)) * _UNITS[m.group(2).lower()]
    return int(v) if v == int(v) else v


def to_micros(duration: str | int | float) -> int:
    return int(round(to_seconds(duration) * 1_000_000))


def interval(duration: str | int | float) -> Column:
    """A day-time interval literal for timestamp arithmetic."""
    return F.make_dt_interval(secs=F.lit(to_seconds(duration)))
