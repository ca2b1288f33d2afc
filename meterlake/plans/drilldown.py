"""Peak drill-down (day -> meter -> interval) for every hall in one plan.

The dashboard runs three queries per hall, each waiting for the previous
answer. Here the three steps are one DataFrame plan, answered for all halls
at once:

1. fact rows of the covered days are aggregated once at (hall, day, meter)
   grain with two sums: inside the requested range (step 1) and the whole day
   (step 2 filters by the winning day, not by the range);
2. a window adds each day's total to its meters, ``dense_rank`` keeps the
   meters of the best day per hall and ``row_number`` the best of them. Both
   rankings run a partial group limit before their shuffle, so of a hot hall
   each task sends the meters of one day at most;
3. readings of each hall's winning (meter, day) are selected by a join of the
   fact with the one-row-per-hall winner table (broadcast behind a check of
   the hall dimension, otherwise sized by AQE at run time) and reduced to the
   peak interval, carrying the winner columns along.

The fact is scanned twice: once for the aggregate, which is used once, and
once, filtered, for step 3. Over written gold the aggregate is read from the
stored rollup where the range is one of whole days, and only step 3 reads the fact. Over derived gold a derived dimension may read the
fact's source again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import covering_days, in_range, next_day_start, day_start
from ..operators.gold import Gold
from ..operators.sizing import checked_broadcast
from .queries import _fact, _with_names, peak_interval, reading_day, rollup_days


def per_hall_broadcast(df: DataFrame, halls: DataFrame) -> DataFrame:
    """``df`` has at most one row per hall: broadcast it when the hall
    dimension's size (x 8 for the wider rows) is under the broadcast limit.
    Without this the fact side of the series join would be shuffled whole:
    the per-hall table's static estimate derives from the fact, and AQE
    measures it only after the fact's shuffle has run."""
    return checked_broadcast(df, bound=halls, row_factor=8)


def _halls(gold: Gold) -> DataFrame:
    return gold.dim_hall if gold.hall_bound is None else gold.hall_bound


WIN_COLS = ["hall_id", "top_day", "top_day_total", "top_meter_id", "top_meter_name",
            "top_meter_total"]


def winners(gold: Gold, hall=None, start=None, end=None, *,
            end_inclusive_day: bool = False,
            dim_meter: DataFrame | None = None) -> DataFrame:
    """Steps 1 and 2: (hall_id, top_day, top_day_total, top_meter_id,
    top_meter_name, top_meter_total), one row per hall with data.

    The (hall, day, meter) aggregate is the only pass over the fact and is
    read once: the day's total rides along as a window sum, so the best day's
    meters are kept without joining a day table back."""
    days = rollup_days(gold, hall, start, end, end_inclusive_day=end_inclusive_day)
    if days is not None:
        in_day = F.when(F.col("_cut"), F.when(F.col("n_midnight") > 0, F.col("sum_midnight"))).otherwise(
            F.col("sum_positive"))
        agg = days.where("n_positive > 0").select(
            "hall_id", F.col("day").alias("top_day"), "meter_id", in_day.alias("_range_s"),
            F.col("sum_positive").alias("_s"))
    else:
        ts = F.col("timestamp")
        f = _fact(gold, hall, start=start, end=end).where(covering_days(ts, start, end))
        agg = (f.groupBy("hall_id", reading_day().alias("top_day"), "meter_id")
               .agg(F.sum(F.when(in_range(ts, start, end, end_inclusive_day), F.col("value")))
                    .alias("_range_s"),
                    F.sum("value").alias("_s")))

    # every meter of a day carries the same total, so rank 1 is one whole day
    day_total = F.sum("_range_s").over(Window.partitionBy("hall_id", "top_day"))
    w1 = Window.partitionBy("hall_id").orderBy(F.desc("top_day_total"), F.asc("top_day"))
    on_best = (agg.withColumn("top_day_total", day_total)
               .where(F.col("top_day_total").isNotNull())
               .withColumn("_rank", F.dense_rank().over(w1)).where("_rank = 1")
               .select("hall_id", "top_day", "top_day_total", "meter_id", "_s"))
    named = _with_names(on_best, gold.dim_meter if dim_meter is None else dim_meter,
                        ["hall_id", "top_day", "top_day_total"], "top_meter_total")
    w2 = Window.partitionBy("hall_id").orderBy(
        F.desc("top_meter_total"), F.asc("meter_id"), F.asc("meter_name"))
    return (named.withColumn("_rn", F.row_number().over(w2)).where("_rn = 1")
            .select("hall_id", "top_day", "top_day_total",
                    F.col("meter_id").alias("top_meter_id"),
                    F.col("meter_name").alias("top_meter_name"), "top_meter_total"))


def winner_series(gold: Gold, win: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Positive readings of each hall's winning meter on its winning day;
    ``carry`` names winner columns to keep on every reading."""
    f = _fact(gold)
    carry = [c for c in (carry or []) if c != "hall_id"]
    w = per_hall_broadcast(
        win.select(F.col("hall_id").alias("_h"), F.col("top_meter_id").alias("_m"),
                   F.col("top_day").alias("_d"), *carry), _halls(gold))
    ts = F.col("timestamp")
    cond = ((F.col("hall_id") == F.col("_h")) & (F.col("meter_id") == F.col("_m"))
            & (ts >= day_start(F.col("_d"))) & (ts < next_day_start(F.col("_d"))))
    return f.join(w, cond).select(
        "hall_id", *carry, "meter_id", "timestamp", F.col("value").alias("consumption"))


def peak_drilldown(gold: Gold, hall=None, start=None, end=None, *,
                   end_inclusive_day: bool = False,
                   dim_meter: DataFrame | None = None) -> DataFrame:
    """All three answers per hall plus the peak interval of step 3.

    The winner columns ride along the series into the peak computation
    (they are constant per hall), so no join back is needed. Every winner
    has at least one positive reading on its day (it was chosen from them),
    so every hall with a winner has a peak row."""
    win = winners(gold, hall, start, end, end_inclusive_day=end_inclusive_day,
                  dim_meter=dim_meter)
    series = winner_series(gold, win, carry=WIN_COLS).drop("meter_id")
    return peak_interval(series, keys=WIN_COLS)


def peak_band(gold: Gold, drill: DataFrame) -> DataFrame:
    """Series of each hall's winning meter with ``in_peak`` marking the
    readings inside [peak_start, peak_end) (the bounds ride along the join
    that selects the series)."""
    s = winner_series(gold, drill, carry=["peak_start", "peak_end"])
    return (s.withColumn("in_peak", (F.col("timestamp") >= F.col("peak_start"))
                         & (F.col("timestamp") < F.col("peak_end")))
            .select("hall_id", "meter_id", "timestamp", "consumption", "in_peak"))


def _two(c) -> F.Column:
    return F.lpad(c.cast("string"), 2, "0")


def kpi_strings(drill: DataFrame) -> DataFrame:
    """The KPI row as text: day ``dd.MM.yyyy``, interval ``HH:mm-HH:mm``
    (``—`` when absent), totals with thousands separators. Built from date
    parts, never through a session-zone conversion."""
    d = F.col("top_day")
    day_text = F.concat(_two(F.dayofmonth(d)), F.lit("."), _two(F.month(d)), F.lit("."),
                        F.lpad(F.year(d).cast("string"), 4, "0"))

    def hhmm(c):
        return F.concat(_two(F.hour(c)), F.lit(":"), _two(F.minute(c)))

    interval = F.coalesce(F.concat(hhmm(F.col("peak_start")), F.lit("-"),
                                   hhmm(F.col("peak_end"))), F.lit("—"))
    pv = F.col("peak_value")

    def num(c, digits):
        # Only the noise of summation order is rounded off, never a decimal.
        return F.format_number(F.round(F.col(c) if isinstance(c, str) else c, 9), digits)

    return drill.select(
        "hall_id",
        day_text.alias("peak_day_text"),
        F.col("top_meter_name").alias("top_machine_text"),
        interval.alias("peak_interval_text"),
        F.concat(num("top_day_total", 1), F.lit(" kW total")).alias("peak_day_sub"),
        F.concat(num("top_meter_total", 1), F.lit(" kW")).alias("top_machine_sub"),
        F.when(pv.isNotNull() & (pv != 0), F.concat(num(pv, 2), F.lit(" kW")))
         .otherwise(F.lit("")).alias("peak_interval_sub"),
    )
