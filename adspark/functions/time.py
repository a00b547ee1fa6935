"""Date and time columns.

Differences count the calendar boundaries crossed (23:00 to 01:00 the next day is one day), which
is not what Spark's own ``timestampdiff`` does. They are computed from wall-clock fields, so the
session time zone plays no part.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

from adspark.functions.columns import as_col

EPOCH = "1970-01-01 00:00:00"


def ts_literal(value: str | datetime | date) -> Column:
    """A timestamp literal without time zone, foldable and therefore pushed to the scan."""
    return F.lit(str(value)).cast("timestamp_ntz")


def date_literal(value: str | date) -> Column:
    return F.lit(str(value)).cast("date")


def diff_units(unit: str, start: Column | str, end: Column | str) -> Column:
    """Boundaries of ``unit`` (day, hour, minute, second) crossed between ``start`` and ``end``."""
    start, end = as_col(start), as_col(end)
    total = F.date_diff(end, start).cast("long")
    for name, size, part in (("hour", 24, F.hour), ("minute", 60, F.minute), ("second", 60, F.second)):
        if unit == "day":
            break
        total = total * size + part(end) - part(start)
        if unit == name:
            break
    else:
        raise ValueError(f"unknown unit: {unit}")
    return total


def shift(unit: str, n: int, value: Column | str) -> Column:
    """``value`` moved by ``n`` units. Dates stay dates when moved by whole days, weeks or months."""
    return F.timestamp_add(unit.upper(), F.lit(n), as_col(value))


def shift_date(unit: str, n: int, value: Column | str) -> Column:
    value = F.to_date(as_col(value))
    if unit == "month":
        return F.add_months(value, n)
    return F.date_add(value, n * {"day": 1, "week": 7}[unit])


def day_of(value: Column | str) -> Column:
    return F.to_date(as_col(value))


def previous_day(value: Column | str, dow: str) -> Column:
    """The latest ``dow`` strictly before ``value``."""
    return F.next_day(F.date_sub(F.to_date(as_col(value)), 8), dow)


def quarter_start(value: Column | str) -> Column:
    return F.trunc(F.to_date(as_col(value)), "quarter")


def epoch_ts(value: Column | str) -> Column:
    """Epoch seconds (any numeric or numeric text, fractions dropped) as a timestamp."""
    seconds = F.floor(as_col(value).cast("double")).cast("long")
    return F.timestamp_add("SECOND", seconds, F.lit(EPOCH).cast("timestamp_ntz"))


def ts_from_parts(day: Column | str, time: Column | str) -> Column:
    """A date and a time of day (``HH:mm:ss``) as one timestamp."""
    clock = as_col(time).cast("string")
    return F.to_timestamp_ntz(F.concat_ws(" ", F.to_date(as_col(day)).cast("string"), clock))


def day_start(value: Column | str) -> Column:
    return F.to_date(as_col(value)).cast("timestamp_ntz")


def day_end(value: Column | str) -> Column:
    """23:59:59 of the day."""
    return F.timestamp_add("SECOND", F.lit(86399), day_start(value))


def fmt(value: Column | str, pattern: str) -> Column:
    return F.date_format(as_col(value), pattern)


def parse_ts(value: Column | str, pattern: str) -> Column:
    return F.to_timestamp_ntz(as_col(value), F.lit(pattern))


def duration(start: Column | str, end: Column | str) -> Column:
    """Elapsed time as a day-time interval."""
    return as_col(end) - as_col(start)
