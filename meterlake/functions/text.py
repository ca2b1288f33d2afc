"""Text-cell helpers: stripping, missing tokens, number recognition, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (HALL_LABEL_PREFIX, HALL_PATTERN, MISSING_TOKENS,
                      SHEET_KEY_BAD_CHARS)

# Whitespace removed by Python's str.strip() that Spark's trim() keeps.
_WS = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

# Plain decimal numbers with optional exponent. Deliberately narrower than a
# double cast: rejects Java suffixes ("1d", "2f"), "NaN", hex and
# thousands/decimal commas.
NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def strip(c: Column) -> Column:
    """Leading/trailing whitespace removed, Unicode spaces included."""
    return F.regexp_replace(c, f"^{_WS}+|{_WS}+$", "")


def missing_to_null(c: Column) -> Column:
    """Missing-value tokens (exact match) become NULL."""
    return F.when(~c.isin(*MISSING_TOKENS), c)


def number_text(c: Column, decimal_comma: bool = False) -> Column:
    """The text as it is tested and cast: with ``decimal_comma`` a plain
    ``1,5`` becomes ``1.5`` (thousands separators are never accepted)."""
    if decimal_comma:
        return F.when(c.rlike(r"^\s*[+-]?\d+,\d+\s*$"), F.regexp_replace(c, ",", ".")).otherwise(c)
    return c


def is_number_text(c: Column, decimal_comma: bool = False) -> Column:
    return number_text(c, decimal_comma).rlike(NUMBER_RE)


def to_number(c: Column, decimal_comma: bool = False) -> Column:
    """Number text -> DOUBLE, anything else -> NULL (never NaN)."""
    t = number_text(c, decimal_comma)
    return F.when(t.rlike(NUMBER_RE), F.trim(t).try_cast("double"))


def safe_key(c: Column) -> Column:
    """Runs of characters outside [A-Za-z0-9_] -> '_', '_' stripped at both ends."""
    return F.regexp_replace(F.regexp_replace(c, SHEET_KEY_BAD_CHARS, "_"), r"^_+|_+$", "")


def file_stem(path_or_name: Column) -> Column:
    name = F.regexp_extract(path_or_name, r"([^/\\]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def file_name(path_or_name: Column) -> Column:
    return F.regexp_extract(path_or_name, r"([^/\\]*)$", 1)


def hall_id_of(file: Column) -> Column:
    """First ``H<digits>`` or ``NVP`` in the file name, else the file stem."""
    m = F.regexp_extract(file_name(file), HALL_PATTERN, 1)
    return F.when(m != "", m).otherwise(file_stem(file))


def hall_label_of(hall_id: Column) -> Column:
    return F.concat(F.lit(HALL_LABEL_PREFIX), hall_id)


def meter_id_of(hall_id: Column, sheet_key: Column) -> Column:
    return F.lower(F.concat(hall_id, F.lit("_"), sheet_key))
