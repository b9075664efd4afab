"""Time expressions. Event times are UTC, as TIMESTAMP or TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length of each interval unit in microseconds.
UNIT_MICROS = {
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros(interval: str) -> int:
    """``"10 minutes"`` as a number of microseconds."""
    amount, unit = interval.split()
    return round(float(amount) * UNIT_MICROS[unit.lower().rstrip("s")])


def interval(text: str) -> Column:
    """``"10 minutes"`` as a day-time interval column."""
    return F.expr(f"INTERVAL '{micros(text) / 1_000_000:.6f}' SECOND")


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def time_bucket(ts: Column | str, width: str) -> Column:
    """Number of the epoch-aligned bucket a time falls in."""
    return F.floor(epoch_micros(ts) / F.lit(micros(width))).cast("long")


def seconds_to_ntz(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def millis_to_ntz(millis: Column) -> Column:
    return F.timestamp_millis(millis).cast("timestamp_ntz")


def last_millisecond(end: Column) -> Column:
    """The row time of a window: one millisecond before its end."""
    return end - interval("1 millisecond")


def day_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def compact_day(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def ten_minute_label(ts: Column) -> Column:
    """``HH:mm`` with the last digit set to 0."""
    return F.concat(F.substring(F.date_format(ts, "HH:mm"), 1, 4), F.lit("0"))
