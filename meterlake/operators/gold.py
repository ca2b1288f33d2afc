"""Silver -> gold star schema (fact at reading grain, hall and meter dims)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gold:
    fact: DataFrame
    dim_hall: DataFrame
    dim_meter: DataFrame
    # A stored table with at least one row per hall, used to size per-hall
    # broadcasts when dim_hall is itself derived (None: use dim_hall).
    hall_bound: DataFrame | None = None
    # Stored sums per hall, day and meter (``meter_day`` of the same fact), from
    # which questions about whole days are answered; None: always from the fact.
    rollup: DataFrame | None = None


def fact_measurement(silver: DataFrame) -> DataFrame:
    """Bare projection at reading grain (no aggregation)."""
    return silver.select("hall_id", "meter_id", "timestamp", "value")


def dim_hall(silver: DataFrame) -> DataFrame:
    # DISTINCT runs as partial + final hash aggregate: each task shrinks its
    # rows to the distinct pairs before the shuffle, so the shuffle carries
    # (tasks x halls) rows, not readings.
    return silver.select("hall_id", "hall_label").distinct()


def dim_meter(silver: DataFrame) -> DataFrame:
    """DISTINCT over all four columns: a meter seen with two names or
    descriptions yields two rows (see ``dim_meter_dupes``)."""
    return silver.select("hall_id", "meter_id", "meter_name", "meter_desc").distinct()


def meter_day(fact: DataFrame) -> DataFrame:
    """The fact summed per hall, day and meter (schema.METER_DAY). The readings
    at midnight are summed apart as well: a range whose end is a bare date
    keeps only them of its last day."""
    v, at_midnight = F.col("value"), F.col("timestamp") == F.col("timestamp").cast("date").cast("timestamp_ntz")
    pos = F.when(v > 0, v)
    return fact.groupBy("hall_id", F.to_date("timestamp").alias("day"), "meter_id").agg(
        F.count(F.lit(1)).alias("n_readings"), F.count(pos).alias("n_positive"),
        F.sum(v).alias("sum_all"), F.sum(pos).alias("sum_positive"),
        F.count(F.when(at_midnight, pos)).alias("n_midnight"), F.sum(F.when(at_midnight, pos)).alias("sum_midnight"))


def build_gold(silver: DataFrame) -> Gold:
    return Gold(fact_measurement(silver), dim_hall(silver), dim_meter(silver))


def dim_meter_dupes(dim: DataFrame) -> DataFrame:
    """Meters with more than one dim row; each such meter fans out in the
    fact -> dim join and its sums are multiplied."""
    return (dim.groupBy("meter_id")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("meter_name").alias("n_names"))
            .where(F.col("n_rows") > 1))


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row frame (``count(*)``)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
