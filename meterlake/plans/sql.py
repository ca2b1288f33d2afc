"""The dashboard questions as Spark SQL text with named parameters.

For users who write SQL: each text runs through ``spark.sql(text, args=...,
fact=..., dim_meter=...)``; the gold DataFrames are bound as the table names
``{fact}``, ``{dim_hall}`` and ``{dim_meter}`` (PySpark registers them for the
call), values are bound as parameters (never pasted into the text).

Parameters: ``hall`` (NULL = every hall), ``start`` / ``end`` as
``'yyyy-MM-dd[ HH:mm:ss]'`` text (a bare date is midnight; ``BETWEEN`` keeps
only the 00:00 reading of the end day, as the dashboard does), ``day``,
``top_n``. Catalyst folds the parameter tests, so a given hall reaches the
scan as a partition filter; a fact stored with its reading dates is bound with
the days that the parameters name, by which its scan skips row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import between_days
from ..operators.gold import Gold
from ..schema import READING_DATE

HALLS = """
SELECT DISTINCT hall_id FROM {dim_hall} WHERE hall_id IS NOT NULL ORDER BY hall_id
"""

# Readings of the question, with their day; every text below starts from one of these.
_IN_RANGE = """
  SELECT hall_id, meter_id, value, CAST(timestamp AS DATE) AS reading_day
  FROM {fact}
  WHERE value > 0 AND timestamp >= CAST(:start AS TIMESTAMP_NTZ) AND timestamp <= CAST(:end AS TIMESTAMP_NTZ)
    AND hall_id = COALESCE(:hall, hall_id)
"""
_ON_DAY = """
  SELECT hall_id, meter_id, value, timestamp, CAST(timestamp AS DATE) AS reading_day
  FROM {fact}
  WHERE value > 0 AND hall_id = COALESCE(:hall, hall_id)
    AND CAST(timestamp AS DATE) = COALESCE(CAST(:day AS DATE), CAST(timestamp AS DATE))
"""
# Meters are summed before they get their names: one row per meter and day meets the dimension.
_NAMED = """
  SELECT s.hall_id, s.reading_day, s.meter_id, n.meter_name, SUM(s.used) AS used
  FROM per_meter s LEFT JOIN {dim_meter} n USING (meter_id)
  GROUP BY s.hall_id, s.reading_day, s.meter_id, n.meter_name
"""

DAILY_TOTALS = f"""
WITH per_meter AS (
  SELECT hall_id, reading_day, meter_id, SUM(value) AS used
  FROM ({_IN_RANGE}) GROUP BY ALL),
named AS ({_NAMED})
SELECT hall_id, reading_day AS day, meter_id, NVL(meter_name, meter_id) AS meter_name, used AS daily_total
FROM named ORDER BY hall_id, day, meter_id
"""

TOP_DAY = f"""
WITH per_day AS (
  SELECT hall_id, reading_day, SUM(value) AS used FROM ({_IN_RANGE}) GROUP BY ALL)
SELECT hall_id, reading_day AS day, used AS daily_total
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY hall_id ORDER BY used DESC, reading_day) AS place FROM per_day)
WHERE place = 1
"""

MACHINE_BREAKDOWN = f"""
WITH per_meter AS (
  SELECT hall_id, reading_day, meter_id, SUM(value) AS used FROM ({_ON_DAY}) GROUP BY ALL),
named AS ({_NAMED}),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY hall_id, reading_day
                               ORDER BY used DESC, meter_id, NVL(meter_name, meter_id)) AS place
  FROM named)
SELECT hall_id, reading_day AS day, meter_id, NVL(meter_name, meter_id) AS meter_name, used AS total_consumption
FROM ranked WHERE place <= :top_n
"""

MACHINE_TIMESERIES = f"""
SELECT hall_id, meter_id, timestamp, value AS consumption FROM ({_ON_DAY})
WHERE meter_id = COALESCE(:meter_id, meter_id) ORDER BY hall_id, meter_id, timestamp
"""

TEXTS = {
    "halls": HALLS,
    "daily_totals": DAILY_TOTALS,
    "top_day": TOP_DAY,
    "machine_breakdown": MACHINE_BREAKDOWN,
    "machine_timeseries": MACHINE_TIMESERIES,
}

DEFAULTS = {"hall": None, "start": "0001-01-01", "end": "9999-12-31", "day": None,
            "top_n": 5, "meter_id": None}


def run(spark: SparkSession, gold: Gold, name: str, **params) -> DataFrame:
    """Run one of ``TEXTS`` over the gold tables with the given parameters."""
    text = TEXTS[name]
    names = [p for p in DEFAULTS if f":{p}" in text]
    args = {p: params.get(p, DEFAULTS[p]) for p in names}
    if "top_n" in args:
        args["top_n"] = int(args["top_n"])
    fact = gold.fact
    if READING_DATE in fact.columns:
        one = params.get("day")
        fact = fact.where(between_days(F.col(READING_DATE), one or params.get("start"), one or params.get("end")))
    return spark.sql(text, args=args or None, fact=fact, dim_hall=gold.dim_hall,
                     dim_meter=gold.dim_meter)
