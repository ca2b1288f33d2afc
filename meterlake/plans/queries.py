"""The dashboard's analytic queries as DataFrame plans.

Every query takes the gold tables and optional parameters. ``hall=None``
answers for every hall at once (``hall_id`` is always an output column), and
``start``/``end``/``day`` of ``None`` mean unbounded. Filters are written as
plain comparisons on the fact columns so they reach the Parquet scan
(partition pruning on ``hall_id``, row-group pruning on ``timestamp``).

Scale notes
-----------
* Sums are pre-aggregated at (hall, day, meter) grain *before* the dim join:
  SUM distributes over the fan-out of a duplicated dim row, so the result is
  exact, and the join then sees one row per meter-day instead of one per
  reading. Partial aggregation runs map-side, so a hall holding a third of
  the readings costs a third of the scan but not a third of the shuffle.
* The meter dim is broadcast behind a size check of its own statistics
  (``operators.sizing``); beyond the limit the join is left to AQE.
* Gold that was written carries a stored rollup per (hall, day, meter); sums
  over whole days are read from it instead of the fact (``meter_sums``).
* Top-k per group uses ``row_number`` windows over aggregated rows, which
  Spark runs with a partial group limit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import (add_micros, between_days, day_lit, in_range, micros_between,
                                  micros_since_epoch, on_day, whole_day)
from ..operators.gold import Gold
from ..operators.sizing import checked_broadcast
from ..schema import DEFAULT_INTERVAL_MINUTES, DEFAULT_TOP_N, READING_DATE


def reading_day() -> Column:
    """Calendar day of the reading (NTZ: no zone conversion)."""
    return F.to_date("timestamp")


def _fact(gold: Gold, hall=None, positive_only: bool = True, meter_id=None,
          start=None, end=None) -> DataFrame:
    """The fact's rows of a hall and meter; the days of ``start`` and ``end``
    bound the scan where the fact is stored with its dates (the caller still
    filters the times)."""
    f = gold.fact
    if READING_DATE in f.columns and (start is not None or end is not None):
        f = f.where(between_days(F.col(READING_DATE), start, end))
    if hall is not None:
        f = f.where(F.col("hall_id") == F.lit(hall))
    if meter_id is not None:
        f = f.where(F.col("meter_id") == F.lit(meter_id))
    if positive_only:
        # value > 0 also drops NULL (and NaN never reaches gold: silver maps it
        # to NULL), as in the reference.
        f = f.where(F.col("value") > 0)
    return f


def _with_names(meter_sums: DataFrame, dim_meter: DataFrame, keys: list[str],
                total: str) -> DataFrame:
    """Left-join meter sums to the meter dim on meter_id only and regroup by
    the raw dim name (NULL is its own group); the output name falls back to
    the meter id."""
    names = checked_broadcast(dim_meter.select("meter_id", F.col("meter_name").alias("_dim_name")))
    j = meter_sums.join(names, "meter_id", "left")
    g = j.groupBy(*keys, "meter_id", "_dim_name").agg(F.sum("_s").alias(total))
    return g.select(*keys, "meter_id",
                    F.coalesce("_dim_name", "meter_id").alias("meter_name"), total)


def rollup_days(gold: Gold, hall=None, start=None, end=None, *,
                end_inclusive_day: bool = False) -> DataFrame | None:
    """Rows of the stored rollup for the days from ``start`` to ``end``, with
    ``_cut``: of this last day only midnight lies in the range. None where the
    rollup cannot answer (there is none, or an end lies inside a day)."""
    if gold.rollup is None or not (whole_day(start) and whole_day(end)):
        return None
    r = gold.rollup
    if hall is not None:
        r = r.where(F.col("hall_id") == F.lit(hall))
    if start is not None:
        r = r.where(F.col("day") >= day_lit(start))
    cut = F.lit(False)
    if end is not None:
        r = r.where(F.col("day") <= day_lit(end))
        if not end_inclusive_day:
            cut = F.col("day") == day_lit(end)
    return r.withColumn("_cut", cut)


def meter_sums(gold: Gold, hall=None, start=None, end=None, *, positive_only: bool = True,
               end_inclusive_day: bool = False, day=None) -> DataFrame:
    """(hall_id, day, meter_id, _s): sums of the readings in the range or on
    ``day``, from the stored rollup where it can tell, else from the fact."""
    if day is not None:
        start, end, end_inclusive_day = day, day, True
    cut_needed = end is not None and not end_inclusive_day
    r = rollup_days(gold, hall, start, end, end_inclusive_day=end_inclusive_day)
    if r is not None and not (cut_needed and not positive_only):
        if not positive_only:
            return r.select("hall_id", "day", "meter_id", F.col("sum_all").alias("_s"))
        n = F.when(F.col("_cut"), F.col("n_midnight")).otherwise(F.col("n_positive"))
        s = F.when(F.col("_cut"), F.col("sum_midnight")).otherwise(F.col("sum_positive"))
        return r.where(n > 0).select("hall_id", "day", "meter_id", s.alias("_s"))
    ts = F.col("timestamp")
    f = _fact(gold, hall, positive_only, start=start, end=end).where(
        on_day(ts, day) if day is not None else in_range(ts, start, end, end_inclusive_day))
    return (f.groupBy("hall_id", reading_day().alias("day"), "meter_id")
            .agg(F.sum("value").alias("_s")))


# QY-1 -----------------------------------------------------------------------
def hall_list(gold: Gold) -> DataFrame:
    return (gold.dim_hall.select("hall_id").where(F.col("hall_id").isNotNull())
            .distinct().orderBy(F.asc_nulls_last("hall_id")))


# QY-2 -----------------------------------------------------------------------
def daily_totals(gold: Gold, hall=None, start=None, end=None, *,
                 positive_only: bool = True, end_inclusive_day: bool = False,
                 dim_meter: DataFrame | None = None, ordered: bool = True) -> DataFrame:
    """Total per (day, meter) in the range, named from the meter dim. Pass
    ``ordered=False`` where another step reads it (Spark keeps such a sort)."""
    sums = meter_sums(gold, hall, start, end, positive_only=positive_only,
                      end_inclusive_day=end_inclusive_day)
    out = _with_names(sums, gold.dim_meter if dim_meter is None else dim_meter,
                      ["hall_id", "day"], "daily_total")
    return out.orderBy(F.asc_nulls_last("hall_id"), F.asc_nulls_last("day"), "meter_id") if ordered else out


# QY-3 -----------------------------------------------------------------------
def day_totals(gold: Gold, hall=None, start=None, end=None, *,
               end_inclusive_day: bool = False) -> DataFrame:
    if rollup_days(gold, hall, start, end) is not None:
        sums = meter_sums(gold, hall, start, end, end_inclusive_day=end_inclusive_day)
        return sums.groupBy("hall_id", "day").agg(F.sum("_s").alias("daily_total"))
    f = _fact(gold, hall, start=start, end=end).where(in_range(F.col("timestamp"), start, end, end_inclusive_day))
    return f.groupBy("hall_id", reading_day().alias("day")).agg(F.sum("value").alias("daily_total"))


def top_day(gold: Gold, hall=None, start=None, end=None, *,
            end_inclusive_day: bool = False) -> DataFrame:
    """Highest day per hall (ties: earliest day). One row per hall with data."""
    t = day_totals(gold, hall, start, end, end_inclusive_day=end_inclusive_day)
    w = Window.partitionBy("hall_id").orderBy(F.desc("daily_total"), F.asc("day"))
    return (t.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
            .select("hall_id", "day", "daily_total"))


# QY-4 / QY-5 / QY-13 --------------------------------------------------------
def meter_breakdown(gold: Gold, hall=None, day=None, top_n: int = DEFAULT_TOP_N, *,
                    positive_only: bool = True,
                    dim_meter: DataFrame | None = None) -> DataFrame:
    """Top-N meters by total of a day (every day when ``day`` is None).

    ``rank`` is 1-based; ``is_top`` marks rank 1 (the highlighted bar). Ties
    are broken by meter id, then name.
    """
    sums = meter_sums(gold, hall, positive_only=positive_only, day=day)
    t = _with_names(sums, gold.dim_meter if dim_meter is None else dim_meter,
                    ["hall_id", "day"], "total_consumption")
    w = Window.partitionBy("hall_id", "day").orderBy(
        F.desc("total_consumption"), F.asc("meter_id"), F.asc("meter_name"))
    return (t.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .where(F.col("rank") <= int(top_n))
            .withColumn("is_top", F.col("rank") == 1))


# QY-6 -----------------------------------------------------------------------
def meter_timeseries(gold: Gold, hall=None, meter_id=None, day=None, *,
                     positive_only: bool = True, ordered: bool = True) -> DataFrame:
    """Readings of a meter on a day in time order (every series when the
    parameters are None; then ordered by hall, meter, time)."""
    f = _fact(gold, hall, positive_only, meter_id, day, day)
    if day is not None:
        f = f.where(on_day(F.col("timestamp"), day))
    out = f.select("hall_id", "meter_id", reading_day().alias("day"), "timestamp",
                   F.col("value").alias("consumption"))
    return out.orderBy("hall_id", "meter_id", "timestamp") if ordered else out


# QY-7 -----------------------------------------------------------------------
def peak_interval(series: DataFrame, keys=("hall_id", "meter_id", "day"),
                  default_minutes: int = DEFAULT_INTERVAL_MINUTES) -> DataFrame:
    """Peak interval of each series.

    step  = most frequent gap between successive readings (smallest on ties),
            ``default_minutes`` when a series has fewer than two readings;
    start = time of the first maximum in time order; end = start + step.
    Input columns: ``keys``, ``timestamp``, ``consumption``. Readings are first
    aggregated by time, so the window sees distinct times only, however often a
    time repeats: ``n`` readings at one time are ``n - 1`` gaps of zero.
    """
    keys = list(keys)
    times = series.groupBy(*keys, "timestamp").agg(
        F.count("*").alias("_n"), F.max("consumption").alias("_v"))
    before = F.lag("timestamp").over(Window.partitionBy(*keys).orderBy("timestamp"))
    gap = micros_between(before, F.col("timestamp"))
    one = F.struct(gap.alias("us"), F.when(gap.isNull(), 0).otherwise(1).cast("bigint").alias("n"))
    zero = F.struct(F.lit(0).cast("bigint").alias("us"), (F.col("_n") - 1).alias("n"))
    first_max = F.struct(F.col("_v").alias("value"), (-micros_since_epoch(F.col("timestamp"))).alias("early"),
                         F.col("timestamp").alias("at"))
    gaps = times.select(*keys, first_max.alias("_peak"), F.when(F.col("_n") > 1, F.array(one, zero)).otherwise(F.array(one)).alias("_g"))
    gaps = gaps.select(*keys, "_peak", F.explode("_g").alias("_g"))
    per_gap = gaps.groupBy(*keys, F.col("_g.us").alias("_us")).agg(F.sum("_g.n").alias("_n"), F.max("_peak").alias("_peak"))
    agg = per_gap.groupBy(*keys).agg(
        F.max(F.when(F.col("_us").isNotNull(), F.struct("_n", (-F.col("_us")).alias("neg")))).alias("_mode"),
        F.max("_peak").alias("_peak"))
    step = F.coalesce(-F.col("_mode.neg"), F.lit(int(default_minutes) * 60_000_000))
    return agg.select(
        *keys,
        F.col("_peak.at").alias("peak_start"),
        add_micros(F.col("_peak.at"), step).alias("peak_end"),
        F.col("_peak.value").alias("peak_value"),
        F.floor(step / F.lit(1_000_000)).cast("bigint").alias("step_seconds"),
    )


__all__ = [
    "hall_list", "daily_totals", "day_totals", "top_day", "meter_breakdown",
    "meter_timeseries", "peak_interval", "reading_day",
]
