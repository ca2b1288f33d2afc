"""Timestamp helpers for TIMESTAMP_NTZ columns.

Readings carry local wall-clock time without a zone. Everything here stays in
NTZ arithmetic so results never depend on the session time zone.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ_TEXT = "1970-01-01 00:00:00"


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a date, datetime or 'yyyy-MM-dd[ HH:mm:ss]'."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def day_lit(value) -> Column:
    """A DATE literal (date part of the given value)."""
    if isinstance(value, Column):
        return value.cast("date")
    return ntz(value).cast("date")


def day_start(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def next_day_start(day: Column) -> Column:
    return F.date_add(day, 1).cast("timestamp_ntz")


def whole_day(value) -> bool:
    """Whether a range end is open or a bare date (midnight)."""
    if value is None:
        return True
    if isinstance(value, Column):
        return False
    if isinstance(value, _dt.datetime):
        return value.time() == _dt.time(0)
    if isinstance(value, _dt.date):
        return True
    return re.fullmatch(r"\s*\d{4}-\d{1,2}-\d{1,2}([ T]00:00(:00(\.0+)?)?)?\s*", str(value)) is not None


def between_days(date: Column, start=None, end=None) -> Column:
    """Days of a DATE column from the day of ``start`` to the day of ``end``:
    implied by a range of times, and what a stored date column is pruned by."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (date >= day_lit(start))
    if end is not None:
        cond = cond & (date <= day_lit(end))
    return cond


def on_day(ts: Column, day) -> Column:
    """``cast(ts as date) = day`` written as a half-open range so the bounds
    reach the Parquet scan as pushed filters."""
    d = day_lit(day)
    return (ts >= day_start(d)) & (ts < next_day_start(d))


def in_range(ts: Column, start=None, end=None, end_inclusive_day: bool = False) -> Column:
    """Range test with the dashboard's semantics.

    ``start``/``end`` given as bare dates mean midnight, so ``BETWEEN`` keeps
    only the 00:00 reading of the end day (default). ``end_inclusive_day``
    keeps the whole end day instead (``ts < end + 1 day``).
    """
    cond = F.lit(True)
    if start is not None:
        cond = cond & (ts >= ntz(start))
    if end is not None:
        if end_inclusive_day:
            cond = cond & (ts < next_day_start(day_lit(end)))
        else:
            cond = cond & (ts <= ntz(end))
    return cond


def covering_days(ts: Column, start=None, end=None) -> Column:
    """Whole days from the day of ``start`` to the day of ``end``."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (ts >= day_start(day_lit(start)))
    if end is not None:
        cond = cond & (ts < next_day_start(day_lit(end)))
    return cond


def micros_since_epoch(ts: Column) -> Column:
    """Microseconds of an NTZ timestamp since 1970-01-01 (zone independent)."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ_TEXT).cast("timestamp_ntz"), ts)


def add_micros(ts: Column, micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, ts)


def micros_between(a: Column, b: Column) -> Column:
    """``b - a`` in microseconds (BIGINT)."""
    return F.timestamp_diff("MICROSECOND", a, b)
