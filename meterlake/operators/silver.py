"""Bronze records -> silver readings (fixed nine-column schema).

* the reading time is parsed row by row from the time cell's text
  (``functions.timeparse``): day-first for dotted/slashed dates, ISO for
  ``yyyy-MM-dd``; the wall clock is kept, stored as TIMESTAMP_NTZ;
* rows without a valid time are dropped (the count is observable, see
  ``pipeline.clean``);
* values stay NULL when missing (``fill_missing`` replaces them on request);
  NaN never reaches silver, so ``value > 0`` drops exactly NULL, 0 and
  negatives downstream;
* every output has exactly ``schema.SILVER``; absent columns become NULL and
  extra columns are dropped (``conform``).

All of it is per-row projection and filter: no shuffle, and it runs inside
the same stage as the scan that feeds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeparse import parse_reading_time
from ..schema import SILVER


def no_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def conform(df: DataFrame, schema=SILVER) -> DataFrame:
    """Exactly the columns of ``schema``, in order and type; missing -> NULL."""
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        c = F.col(src).cast(f.dataType) if src is not None else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(cols)


def drop_null(df: DataFrame, name: str) -> DataFrame:
    """Rows where column ``name`` is NULL removed, computing ``name`` once.

    Written as the explode of a zero-or-one element array. A plain
    ``where(name IS NOT NULL)`` would be pushed below the projection that
    defines ``name``, so the whole defining expression (here the time parse)
    would run twice per row, and once without common-subexpression
    elimination; measured about 3x slower on the silver step."""
    return df.withColumn(name, F.explode(F.array_compact(F.array(F.col(name)))))


def to_silver(bronze: DataFrame, *, fill_missing: float | None = None) -> DataFrame:
    """Bronze rows (schema.BRONZE) -> silver rows with a valid reading time."""
    value = no_nan(F.col("value"))
    if fill_missing is not None:
        value = F.coalesce(value, F.lit(float(fill_missing)))
    out = bronze.withColumn("timestamp", parse_reading_time(F.col("timestamp_raw")))
    out = drop_null(out, "timestamp").withColumn("value", value)
    return conform(out)
