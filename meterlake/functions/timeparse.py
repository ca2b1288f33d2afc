"""Reading-time text -> TIMESTAMP_NTZ, row by row.

Each value is parsed on its own (no per-column format guess):
* ``yyyy-MM-dd[( |T)HH:mm[:ss[.f]]]`` or with slashes is ISO, never day/month swapped;
* ``dd.MM.yyyy``, ``dd/MM/yyyy``, ``dd-MM-yyyy`` (+ optional time) is day-first,
  also with a year of two digits (69 to 99 are 1969 to 1999);
* ``Z`` or an offset after a time is taken off, the result being UTC;
* anything else, and impossible dates (month 13, 31 Feb), is NULL.
Bare numbers are never read as times; the workbook reader renders date-typed
cells as ISO text. A wall clock without offset is kept as is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TIME = r"(?:[ T]+(\d{1,2}):(\d{1,2})(?::(\d{1,2}(?:\.\d{1,9})?))?)?"
ISO_RE = r"^\s*(\d{4})([-/])(\d{1,2})\2(\d{1,2})" + _TIME + r"\s*$"
DAYFIRST_RE = r"^\s*(\d{1,2})[./-](\d{1,2})[./-](\d{4}|\d{2})" + _TIME + r"\s*$"
ZONE_RE = r"(:\d{1,2}(?:\.\d{1,9})?)\s*(?:Z|([+-])(\d{2}):?(\d{2}))\s*$"


def _num(parts: Column, i: int, typ: str = "int", default=None) -> Column:
    v = F.get(parts, i).try_cast(typ)
    return v if default is None else F.coalesce(v, F.lit(default).cast(typ))


def _build(parts: Column, y: int, mo: int, d: int) -> Column:
    # seconds = whole seconds + fraction (digit group 7, if any), microseconds kept
    frac = F.concat(F.lit("0."), F.get(parts, 6)).try_cast("decimal(16,6)")
    sec = _num(parts, 5, "decimal(16,6)", 0) + F.coalesce(frac, F.lit(0).cast("decimal(16,6)"))
    year = _num(parts, y)
    year = F.when(F.length(F.get(parts, y)) > 2, year).otherwise(year + F.when(year < 69, 2000).otherwise(1900))
    return F.try_make_timestamp_ntz(
        year, _num(parts, mo), _num(parts, d),
        _num(parts, 3, default=0), _num(parts, 4, default=0), sec)


def _once(c: Column, of) -> Column:
    """``of(c)`` with ``c`` computed once a row, however often ``of`` names it:
    a plain expression is computed again at every mention inside a branch."""
    return F.get(F.transform(F.array(c), of), 0)


def _wall(local: Column) -> Column:
    return _once(F.regexp_extract_all(local, F.lit(r"(\d+)"), 1), lambda parts: (
        F.when(local.rlike(ISO_RE), _build(parts, 0, 1, 2))
        .when(local.rlike(DAYFIRST_RE), _build(parts, 2, 1, 0))))


def parse_reading_time(text: Column) -> Column:
    """Anchored pattern tests decide the layout; the digit groups come from
    one ``regexp_extract_all`` pass, so a row costs a few regex evaluations
    (not one per date part)."""
    part = lambda i: F.coalesce(F.regexp_extract(text, ZONE_RE, i).try_cast("int"), F.lit(0))
    minutes = (part(3) * 60 + part(4)) * F.when(F.regexp_extract(text, ZONE_RE, 2) == "-", -1).otherwise(1)
    # the offset is subtracted only where one is given
    return F.when(text.rlike(ZONE_RE), _once(F.regexp_replace(text, ZONE_RE, "$1"), _wall) - F.make_dt_interval(mins=minutes)) \
        .otherwise(_wall(text))
