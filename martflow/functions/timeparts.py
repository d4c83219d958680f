"""Timestamps, calendar parts and date parsing. All map-only expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output formats of the textual time dimension.
START_TIME_FORMAT = "dd-MM-yyyy HH:mm:ss"
PADDED_PARTS = {"hour": "HH", "day": "dd", "month": "MM", "year": "yyyy"}
# Fixed value: day number 0 of the SAS calendar.
SAS_EPOCH = "1960-01-01"

WEEKDAY_CONVENTIONS = ("monday0", "sunday0", "sunday1", "name")


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def from_epoch_ms(ms: Column, whole_seconds: bool = False) -> Column:
    """Epoch milliseconds as a zone-free timestamp.

    ``whole_seconds`` drops the milliseconds by flooring, which is what an
    integer division by 1000 does to a positive value.
    """
    if whole_seconds:
        return F.timestamp_add("SECOND", F.floor(ms / F.lit(1000)), _epoch())
    return F.timestamp_add("MILLISECOND", ms, _epoch())


def to_epoch_ms(ts: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", _epoch(), ts)


def format_start_time(ts: Column) -> Column:
    return F.date_format(ts, START_TIME_FORMAT)


def padded_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded text parts, keyed by name."""
    return {name: F.date_format(ts, pattern) for name, pattern in PADDED_PARTS.items()}


def weekday(ts: Column, convention: str = "monday0") -> Column:
    """Day of week: Monday=0, Sunday=0, Sunday=1, or the short English name."""
    if convention == "monday0":
        return F.weekday(ts)
    if convention == "sunday0":
        return F.dayofweek(ts) - F.lit(1)
    if convention == "sunday1":
        return F.dayofweek(ts)
    if convention == "name":
        return F.date_format(ts, "E")
    raise ValueError(f"weekday convention must be one of {WEEKDAY_CONVENTIONS}")


def clock_parts(ts: Column, weekday_as: str = "monday0") -> dict[str, Column]:
    """The columns of a time dimension other than its key."""
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": weekday(ts, weekday_as),
    }


def calendar_parts(date: Column, weekday_as: str = "sunday1") -> dict[str, Column]:
    """The columns of a date dimension other than its key."""
    parts = clock_parts(date, weekday_as)
    del parts["hour"]
    return parts | {"yearday": F.dayofyear(date)}


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to date; anything the pattern does not fit becomes null."""
    return F.try_to_date(text, pattern)


def sas_date(days: Column) -> Column:
    """Day count since the SAS epoch to date; null stays null."""
    return F.date_add(F.lit(SAS_EPOCH).cast("date"), days.cast("int"))
