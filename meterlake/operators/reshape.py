"""Report frames behind the charts: top-N + Other, day pivot, day peaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DEFAULT_TOP_N


def top_n_other(daily: DataFrame, top_n: int = DEFAULT_TOP_N, key: str = "meter_name",
                keys=("hall_id",)) -> DataFrame:
    """Keep the ``top_n`` names by total over the whole frame (per hall) and
    fold the rest into ``Other``; returns (keys, day, meter_group, daily_total).

    Grouping is by *name* (meters sharing a name merge), ties by name.
    """
    keys = list(keys)
    # One row per (keys, name, day) with the name's total and first day. Both
    # branches below read these rows from one exchange by (keys, name), so what
    # lies under it runs once; names are ranked by one row each.
    own = Window.partitionBy(*keys, key)
    named = (daily.groupBy(*keys, key, "day").agg(F.sum("daily_total").alias("_d"))
             .withColumn("_t", F.sum("_d").over(own)).withColumn("_first", F.min("day").over(own)))
    w = Window.partitionBy(*keys).orderBy(F.desc("_t"), F.asc(key))
    top = (named.where(F.col("day") == F.col("_first")).withColumn("_rn", F.row_number().over(w))
           .where(F.col("_rn") <= int(top_n))
           .select(*[F.col(k).alias(f"_{k}") for k in (*keys, key)], F.lit(True).alias("_hit")))
    # a null-safe join: "is not null" pushed down one branch only would make the
    # branches differ and the exchange run twice
    same = F.lit(True)
    for k in (*keys, key):
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    j = named.join(top, same, "left")
    grp = F.when(F.col("_hit") & F.col(key).isNotNull(), F.col(key)).otherwise(F.lit("Other"))
    return (j.groupBy(*keys, "day", grp.alias("meter_group"))
            .agg(F.sum("_d").alias("daily_total")))


def daily_pivot(long: DataFrame, values: list, column: str = "meter_group",
                index=("hall_id", "day"), measure: str = "daily_total",
                other: str | None = None) -> DataFrame:
    """Day x ``column`` sums, 0 where a combination is missing, by day.

    ``values`` is the explicit column list (bounded output schema, and no
    extra job to discover the distinct values). Rows of any other value,
    NULL too, are summed in the column ``other``; without one they fail the
    query rather than vanish from it.
    """
    index = list(index)
    listed = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    rest = (F.lit(other) if other is not None else
            F.raise_error(F.concat(F.lit(f"value of {column} without a pivot column: "),
                                   F.coalesce(F.col(column).cast("string"), F.lit("NULL")))).cast("string"))
    names = [*values] if other is None or other in values else [*values, other]
    folded = long.select(*index, F.when(listed, F.col(column).cast("string")).otherwise(rest).alias("_to"),
                         F.col(measure).alias("_m"))
    p = folded.groupBy(*index).pivot("_to", [str(v) for v in names]).agg(F.sum("_m"))
    return p.na.fill(0.0, subset=[str(v) for v in names]).orderBy(*index)


def daily_peak(daily: DataFrame, top_day: DataFrame | None = None,
               keys=("hall_id",)) -> DataFrame:
    """Per hall: the day with the highest row total (earliest on ties), its
    total, and ``marked_total`` = total on ``top_day``'s day if that day has
    a row, else the highest total. Computed on the long form (no pivot)."""
    keys = list(keys)
    t = daily.groupBy(*keys, "day").agg(F.sum("daily_total").alias("_dt"))
    if top_day is None:
        t = t.withColumn("_marked", F.lit(False))
    else:
        # the marked day rides along as a flag, so the day totals are used once
        t = t.join(top_day.select(*keys, "day").distinct().withColumn("_marked", F.lit(True)), [*keys, "day"], "left")
    peak = t.groupBy(*keys).agg(
        F.max_by("day", F.struct(F.col("_dt"), -F.unix_date("day"))).alias("peak_day"),
        F.max("_dt").alias("peak_total"),
        F.max(F.when(F.col("_marked"), F.col("_dt"))).alias("_on_top"))
    return peak.withColumn("marked_total", F.coalesce("_on_top", "peak_total")).drop("_on_top")
