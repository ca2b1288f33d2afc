"""

``queries()[name](spark, sf_dir)`` builds a DataFrame over the driver's test
tables; ``oracle_sql()[name]`` is the same question in DuckDB SQL over the
same Parquet tables. Groups (see FIXTURES.md for the stand-ins):

* F1 (events as 15-minute readings): dashboard queries, drill-down, report
  frames, gold tables, dim fan-out;
* F2 (line items as daily readings per supplier): top day, drill-down;
* F3 (events laid out as workbook cells): every grid -> bronze -> silver step,
  the drill-down over the whole chain in one plan (``silver_drilldown``) and
  through written lake layers (``lake_drilldown``), and the per-stage row
  metrics of that run (``run_metrics``);
* ``sql_*``: the same questions as parameterized Spark SQL text;
* ``op1_*`` .. ``op10_*`` and ``pipeline``: training-data operators, added only
  where their subpackage can be imported.

Floating sums are rounded to 2 decimals on both sides (readings carry 2
decimals; the rounding only hides summation-order noise).
"""

from __future__ import annotations

import contextlib
import os
import re
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from meterlake.operators import gold as G  # noqa: E402
from meterlake.operators import grid as GR  # noqa: E402
from meterlake.operators import silver as SV  # noqa: E402
from meterlake.operators import reshape as R  # noqa: E402
from meterlake.plans import drilldown as D  # noqa: E402
from meterlake.plans import pipeline as P  # noqa: E402
from meterlake.plans import queries as Q  # noqa: E402
from meterlake.plans import sql as QS  # noqa: E402
from meterlake.sources import lake as L  # noqa: E402
from meterlake.sources import fixtures as FX  # noqa: E402
from meterlake.sources import union as U  # noqa: E402
from meterlake.sources import versions as V  # noqa: E402
from meterlake.sources import workbook as WB  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the registered queries (fixed values of the test data).
EDGE_RANGE = ("2024-01-03", "2024-01-30")
F1_METERS = [f"Meter {i}" for i in range(7)]
F1_HALLS = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]


def _r2(df: DataFrame) -> DataFrame:
    return df.select([F.round(F.col(f.name), 2).alias(f.name)
                      if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                      for f in df.schema.fields])


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the whole peak drill-down for every hall, one plan."""
    return _r2(D.peak_drilldown(FX.readings_gold(spark, SMOKE_DIR)))


# ----------------------------------------------------------------- queries
def _f1(spark, d):
    return FX.readings_gold(spark, d)


def q_hall_list(spark, d):
    return Q.hall_list(_f1(spark, d))


def q_daily_totals(spark, d):
    return _r2(Q.daily_totals(_f1(spark, d)))


def q_daily_totals_range_edge(spark, d):
    g = _f1(spark, d)
    a = Q.daily_totals(g, None, *EDGE_RANGE, ordered=False).withColumn("end_mode", F.lit("between"))
    b = (Q.daily_totals(g, None, *EDGE_RANGE, end_inclusive_day=True, ordered=False)
         .withColumn("end_mode", F.lit("whole_day")))
    return _r2(a.unionByName(b))


def q_top_day(spark, d):
    return _r2(Q.top_day(_f1(spark, d)))


def q_top_day_all_halls(spark, d):
    return _r2(Q.top_day(FX.readings_large_gold(spark, d)))


def q_meter_breakdown(spark, d):
    return _r2(Q.meter_breakdown(_f1(spark, d)))


def q_meter_breakdown_unfiltered(spark, d):
    return _r2(Q.meter_breakdown(_f1(spark, d), positive_only=False))


def q_meter_timeseries(spark, d):
    return _r2(Q.meter_timeseries(_f1(spark, d)))


def q_peak_interval(spark, d):
    return _r2(Q.peak_interval(Q.meter_timeseries(_f1(spark, d), ordered=False)))


def q_peak_drilldown(spark, d):
    return _r2(D.peak_drilldown(_f1(spark, d)))


def q_peak_drilldown_range(spark, d):
    return _r2(D.peak_drilldown(_f1(spark, d), None, *EDGE_RANGE))


def q_peak_drilldown_large(spark, d):
    return _r2(D.peak_drilldown(FX.readings_large_gold(spark, d)))


def q_top_n_other(spark, d):
    return _r2(R.top_n_other(Q.daily_totals(_f1(spark, d), ordered=False)))


def q_daily_pivot(spark, d):
    daily = Q.daily_totals(_f1(spark, d), ordered=False)
    return _r2(R.daily_pivot(daily, F1_HALLS, column="hall_id", index=("day",)))


def q_daily_pivot_meters(spark, d):
    """Day x meter name per hall; meters without a name go to Other."""
    daily = Q.daily_totals(_f1(spark, d), ordered=False)
    return _r2(R.daily_pivot(daily, F1_METERS, column="meter_name", other="Other"))


def q_daily_peak_absent_day(spark, d):
    """The marked day lies outside the frame: the highest total is marked."""
    g = _f1(spark, d)
    later = Q.top_day(g).withColumn("day", F.date_add("day", 3650))
    return _r2(R.daily_peak(Q.daily_totals(g, ordered=False), later))


def q_peak_drilldown_whole_day(spark, d):
    return _r2(D.peak_drilldown(_f1(spark, d), None, *EDGE_RANGE, end_inclusive_day=True))


def q_daily_peak(spark, d):
    g = _f1(spark, d)
    return _r2(R.daily_peak(Q.daily_totals(g, ordered=False), Q.top_day(g)))


def q_peak_band(spark, d):
    g = _f1(spark, d)
    return _r2(D.peak_band(g, D.peak_drilldown(g)))


def q_kpi_strings(spark, d):
    return D.kpi_strings(D.peak_drilldown(_f1(spark, d)))


def q_fact_measurement(spark, d):
    return _r2(_f1(spark, d).fact)


def q_dim_hall(spark, d):
    return _f1(spark, d).dim_hall


def q_dim_meter(spark, d):
    return _f1(spark, d).dim_meter


def q_dim_meter_dupes(spark, d):
    return G.dim_meter_dupes(FX.fanout_dim(_f1(spark, d)))


def q_fanout_join(spark, d):
    g = _f1(spark, d)
    return _r2(Q.meter_breakdown(g, positive_only=False, dim_meter=FX.fanout_dim(g)))


# events as workbook cells -> bronze -> silver -> gold.
def _cells(spark, d):
    return FX.cells(spark, d)


def q_sheet_meta(spark, d):
    return GR.sheet_meta(_cells(spark, d))


def q_numeric_rule(spark, d):
    return GR.column_stats(_cells(spark, d)).drop("sheet_name")


def q_header_patch(spark, d):
    return GR.column_info(_cells(spark, d)).select(
        "src_file", "sheet_idx", "col_no", "sheet_name", "name", "has_data")


def _sheets(spark, d):
    return GR.sheet_table(GR.column_profile(_cells(spark, d)))


def q_role_columns(spark, d):
    return GR.sheet_roles(_sheets(spark, d))


def q_ids(spark, d):
    return GR.sheet_ids(GR.nonempty_sheets(_sheets(spark, d)))


def q_last_writer(spark, d):
    return GR.last_writer(GR.sheet_ids(GR.nonempty_sheets(_sheets(spark, d))))


def _bronze(spark, d):
    return GR.cells_to_bronze(_cells(spark, d))


def q_grid_records(spark, d):
    b = _bronze(spark, d)
    return _r2(b.withColumn("cells", GR.cells_text(F.col("cells"))))


def q_parse_timestamps(spark, d):
    return _r2(SV.to_silver(_bronze(spark, d)))


def q_fill_missing(spark, d):
    return _r2(SV.to_silver(_bronze(spark, d), fill_missing=0.0))


def q_conform_schema(spark, d):
    foreign = (FX.readings(spark, d).drop("meter_desc", "interval_minutes")
               .withColumn("props", F.lit("x")))
    return _r2(SV.conform(foreign))


def q_silver_drilldown(spark, d):
    return _r2(D.peak_drilldown(G.build_gold(SV.to_silver(_bronze(spark, d)))))


def q_lake_drilldown(spark, d):
    """End to end through the lake: cells -> bronze -> silver -> gold written
    under the shared checkpoint folder, then the drill-down over gold."""
    root = L.scratch_root(spark, "lake")
    P.run(spark, _cells(spark, d), root)
    return _r2(D.peak_drilldown(L.read_gold(spark, root)))


# The same questions as parameterized Spark SQL text (plans/sql.py).
def q_sql_halls(spark, d):
    return QS.run(spark, _f1(spark, d), "halls")


def q_sql_daily_totals(spark, d):
    return _r2(QS.run(spark, _f1(spark, d), "daily_totals", start=EDGE_RANGE[0], end=EDGE_RANGE[1]))


def q_sql_top_day(spark, d):
    return _r2(QS.run(spark, FX.readings_large_gold(spark, d), "top_day"))


def q_sql_machine_breakdown(spark, d):
    return _r2(QS.run(spark, _f1(spark, d), "machine_breakdown", top_n=5))


# The parameterised forms that the dashboard calls.
ONE_HALL, ONE_METER, ONE_DAY = "CLICK", "click_m1", "2024-01-10"


def q_daily_totals_hall(spark, d):
    return _r2(Q.daily_totals(_f1(spark, d), ONE_HALL, *EDGE_RANGE))


def q_meter_breakdown_day(spark, d):
    return _r2(Q.meter_breakdown(_f1(spark, d), ONE_HALL, ONE_DAY, top_n=3).drop("is_top", "rank"))


def q_meter_timeseries_one(spark, d):
    return _r2(Q.meter_timeseries(_f1(spark, d), ONE_HALL, ONE_METER, ONE_DAY))


def q_daily_totals_empty(spark, d):
    return _r2(Q.daily_totals(_f1(spark, d), "NO SUCH HALL"))


def q_sql_machine_timeseries(spark, d):
    return _r2(QS.run(spark, _f1(spark, d), "machine_timeseries", hall=ONE_HALL, meter_id=ONE_METER, day=ONE_DAY))


def q_fact_count(spark, d):
    return G.row_count(_f1(spark, d).fact)


def q_run_metrics(spark, d):
    """Row counts the pipeline observed at each stage, read from its run log."""
    root = L.scratch_root(spark, "lake")
    P.run(spark, _cells(spark, d), root)
    return L.run_metrics(spark, root).select("metric", "value")


# Written gold: clustered fact, daily rollup, published versions.
def _f1_lake(spark, d):
    root = L.scratch_root(spark, "lake")
    L.write_gold(_f1(spark, d), root)
    return L.read_gold(spark, root)


def q_lake_meter_breakdown_day(spark, d):
    return _r2(Q.meter_breakdown(_f1_lake(spark, d), ONE_HALL, ONE_DAY, top_n=3).drop("is_top", "rank"))


def q_lake_meter_timeseries_one(spark, d):
    return _r2(Q.meter_timeseries(_f1_lake(spark, d), ONE_HALL, ONE_METER, ONE_DAY))


def q_lake_daily_totals_range_edge(spark, d):
    """Both kinds of range end, answered from the rollup."""
    g = _f1_lake(spark, d)
    a = Q.daily_totals(g, None, *EDGE_RANGE, ordered=False).withColumn("end_mode", F.lit("between"))
    b = (Q.daily_totals(g, None, *EDGE_RANGE, end_inclusive_day=True, ordered=False)
         .withColumn("end_mode", F.lit("whole_day")))
    return _r2(a.unionByName(b))


def q_lake_peak_drilldown_range(spark, d):
    return _r2(D.peak_drilldown(_f1_lake(spark, d), None, *EDGE_RANGE))


SECOND_ARRIVAL = ["Export_H1_zz.xlsx", "Export_H8_view.xlsx"]


def q_lake_two_arrivals(spark, d):
    """The workbooks in two arrivals: the second one replaces a sheet of H1,
    brings H8, and leaves the files of all other halls as they are."""
    root = L.scratch_root(spark, "lake")
    cells = _cells(spark, d)
    second = F.col("src_file").isin(SECOND_ARRIVAL)
    P.refresh(spark, cells.where(~second), root)
    before = V.published(spark, root).halls("gold/fact_measurement")
    P.refresh(spark, cells.where(second), root)
    after = V.published(spark, root).halls("gold/fact_measurement")
    halls = spark.createDataFrame([(h.partition("=")[2], before.get(h) != f) for h, f in after.items()],
                                  "hall_id string, rewritten boolean")
    return _r2(D.peak_drilldown(L.read_gold(spark, root)).join(halls, "hall_id"))


def q_lake_archive(spark, d):
    """Files archived in two arrivals: a later file of a hall and name replaces
    the first, all others stay; bytes come back as they were digested."""
    root = L.scratch_root(spark, "lake")
    for first in (True, False):
        WB.archive(FX.day_exports(spark, d, first), root)
    return WB.read_archive(spark, root).select(
        "hall_id", "src_file", F.hour("modificationTime").alias("exported_hour"), "length", "sha256",
        (F.sha2("content", 256) == F.col("sha256")).alias("intact"))


def q_run_outcomes(spark, d):
    """The run log of a run without cells, one that fails and one that ends."""
    root = L.scratch_root(spark, "lake")
    cells = _cells(spark, d)
    P.run(spark, cells.where("row_no < 0"), root)
    broken = F.col("src_file").contains("purchase") & (F.col("row_no") == 2) & (F.col("col_no") == 0)
    message = F.raise_error(F.concat(F.lit("unreadable workbook "), F.col("src_file")))
    with contextlib.suppress(Exception):
        P.run(spark, cells.withColumn("value", F.when(broken, message.cast("string")).otherwise(F.col("value"))), root)
    P.run(spark, cells, root)
    return L.run_outcomes(spark, root).select(
        "run_no", "status", "failed_task", F.nullif(F.regexp_extract("error", r"unreadable workbook (\w+\.xlsx)", 1), F.lit("")).alias("workbook"),
        F.col("metrics")["silver_rows"].alias("silver_rows"))


def q_foreign_hall_folders(spark, d):
    """Silver in a foreign layout, <hall>/<file>.parquet without the hall
    column, read back with the hall from the folder."""
    base = L.scratch_root(spark, "halls")
    r = FX.readings(spark, d)
    for hall in F1_HALLS:
        r.where(F.col("hall_id") == hall).drop("hall_id", "meter_desc").write.parquet(f"{base}/{hall}")
    return _r2(L.read_hall_folders(spark, base))


def q_gold_single_files(spark, d):
    """Gold exported as one file a table, read without a folder layout."""
    base = L.scratch_root(spark, "files")
    g = _f1(spark, d)
    for name in ("fact", "dim_hall", "dim_meter"):
        getattr(g, name).coalesce(1).write.parquet(f"{base}/{name}")
    return _r2(Q.meter_breakdown(L.read_gold_files(spark, *(f"{base}/{n}" for n in ("fact", "dim_hall", "dim_meter")))))


def q_gold_union_by_name(spark, d):
    """Fact files whose schemas drifted: doubles, whole numbers, decimals under
    another letter case, another column order, and no value at all."""
    base = L.scratch_root(spark, "drift")
    g = _f1(spark, d)
    v = F.col("value")
    drift = {
        "CLICK": ["hall_id", "meter_id", "timestamp", "value"],
        "ERROR": ["value", "timestamp", F.lit("x").alias("note"), "meter_id", "hall_id"],
        "PURCHASE": ["hall_id", "meter_id", "timestamp", F.floor(v).cast("bigint").alias("value")],
        "SIGNUP": ["hall_id", "meter_id", "timestamp"],
        "VIEW": [v.cast("decimal(18,2)").alias("VALUE"), "hall_id", "meter_id", "timestamp"],
    }
    for hall, cols in drift.items():
        g.fact.where(F.col("hall_id") == hall).select(*cols).write.parquet(f"{base}/fact/{hall.lower()}")
    g.dim_hall.write.parquet(f"{base}/dim_hall")
    g.dim_meter.write.parquet(f"{base}/dim_meter")
    return _r2(Q.daily_totals(U.read_gold_union(spark, *(f"{base}/{n}" for n in ("fact", "dim_hall", "dim_meter")))))


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "hall_list": q_hall_list,
        "daily_totals": q_daily_totals,
        "daily_totals_range_edge": q_daily_totals_range_edge,
        "top_day": q_top_day,
        "top_day_all_halls": q_top_day_all_halls,
        "meter_breakdown": q_meter_breakdown,
        "meter_breakdown_unfiltered": q_meter_breakdown_unfiltered,
        "meter_timeseries": q_meter_timeseries,
        "peak_interval": q_peak_interval,
        "peak_drilldown": q_peak_drilldown,
        "peak_drilldown_range": q_peak_drilldown_range,
        "peak_drilldown_large": q_peak_drilldown_large,
        "top_n_other": q_top_n_other,
        "daily_pivot": q_daily_pivot,
        "daily_pivot_meters": q_daily_pivot_meters,
        "daily_peak": q_daily_peak,
        "daily_peak_absent_day": q_daily_peak_absent_day,
        "peak_drilldown_whole_day": q_peak_drilldown_whole_day,
        "peak_band": q_peak_band,
        "kpi_strings": q_kpi_strings,
        "daily_totals_hall": q_daily_totals_hall,
        "meter_breakdown_day": q_meter_breakdown_day,
        "meter_timeseries_one": q_meter_timeseries_one,
        "daily_totals_empty": q_daily_totals_empty,
        "sql_machine_timeseries": q_sql_machine_timeseries,
        "fact_count": q_fact_count,
        "fact_measurement": q_fact_measurement,
        "dim_hall": q_dim_hall,
        "dim_meter": q_dim_meter,
        "dim_meter_dupes": q_dim_meter_dupes,
        "fanout_join": q_fanout_join,
        "sheet_meta": q_sheet_meta,
        "numeric_rule": q_numeric_rule,
        "header_patch": q_header_patch,
        "role_columns": q_role_columns,
        "ids": q_ids,
        "last_writer": q_last_writer,
        "grid_records": q_grid_records,
        "parse_timestamps": q_parse_timestamps,
        "fill_missing": q_fill_missing,
        "conform_schema": q_conform_schema,
        "silver_drilldown": q_silver_drilldown,
        "lake_drilldown": q_lake_drilldown,
        "run_metrics": q_run_metrics,
        "lake_meter_breakdown_day": q_lake_meter_breakdown_day,
        "lake_meter_timeseries_one": q_lake_meter_timeseries_one,
        "lake_daily_totals_range_edge": q_lake_daily_totals_range_edge,
        "lake_peak_drilldown_range": q_lake_peak_drilldown_range,
        "lake_two_arrivals": q_lake_two_arrivals,
        "lake_archive": q_lake_archive,
        "run_outcomes": q_run_outcomes,
        "foreign_hall_folders": q_foreign_hall_folders,
        "gold_single_files": q_gold_single_files,
        "gold_union_by_name": q_gold_union_by_name,
        "sql_halls": q_sql_halls,
        "sql_daily_totals": q_sql_daily_totals,
        "sql_top_day": q_sql_top_day,
        "sql_machine_breakdown": q_sql_machine_breakdown,
    }


# -------------------------------------------------------------- oracle SQL
# events as readings; F2: line items as readings. Gold tables as CTEs.
_F1 = """
silver AS (
  SELECT upper(event_type) AS hall_id,
         'Hall ' || upper(event_type) AS hall_label,
         lower(event_type) || '_m' || CAST(user_id % 8 AS VARCHAR) AS meter_id,
         CASE WHEN user_id % 8 <> 7 THEN 'Meter ' || CAST(user_id % 8 AS VARCHAR) END AS meter_name,
         '' AS meter_desc,
         time_bucket(INTERVAL '15 minutes', ts) AS "timestamp",
         CASE WHEN event_id % 20 = 0 THEN CAST(0 AS DOUBLE)
              WHEN event_id % 20 = 1 THEN CAST(NULL AS DOUBLE)
              ELSE value END AS value,
         15 AS interval_minutes,
         'events.parquet' AS src_file
  FROM events),
fact AS (SELECT hall_id, meter_id, "timestamp", value FROM silver),
dim_hall AS (SELECT DISTINCT hall_id, hall_label FROM silver),
dim_meter AS (SELECT DISTINCT hall_id, meter_id, meter_name, meter_desc FROM silver)"""

_F2 = """
silver AS (
  SELECT r_name AS hall_id, 'Hall ' || r_name AS hall_label,
         lower(r_name) || '_s' || CAST(l_suppkey AS VARCHAR) AS meter_id,
         s_name AS meter_name, '' AS meter_desc,
         l_shipdate AS "timestamp", l_quantity AS value,
         1440 AS interval_minutes, 'lineitem.parquet' AS src_file
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
fact AS (SELECT hall_id, meter_id, "timestamp", value FROM silver),
dim_hall AS (SELECT DISTINCT hall_id, hall_label FROM silver),
dim_meter AS (SELECT DISTINCT hall_id, meter_id, meter_name, meter_desc FROM silver)"""

_FANOUT = """
dim_fan AS (SELECT * FROM dim_meter
            UNION ALL SELECT 'CLICK', 'click_m1', 'Meter 1 (alt)', '')"""


def _daily_sql(where: str = "f.value > 0", dim: str = "dim_meter") -> str:
    return f"""
  SELECT f.hall_id, CAST(f."timestamp" AS DATE) AS day, f.meter_id,
         COALESCE(d.meter_name, f.meter_id) AS meter_name,
         SUM(f.value) AS daily_total
  FROM fact f LEFT JOIN {dim} d ON f.meter_id = d.meter_id
  WHERE {where}
  GROUP BY f.hall_id, CAST(f."timestamp" AS DATE), f.meter_id, d.meter_name"""


def _breakdown_sql(where: str = "f.value > 0", dim: str = "dim_meter", top_n: int = 5) -> str:
    # Sums per meter first, then the name join: equal to summing after the
    # join (SUM distributes over a duplicated dim row), but the duplicated
    # rows get bit-identical totals, so their tie-break by name is stable.
    return f"""
  SELECT hall_id, day, meter_id, meter_name, ROUND(total_consumption, 2) AS total_consumption,
         rank, rank = 1 AS is_top
  FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY hall_id, day
                                 ORDER BY total_consumption DESC, meter_id, meter_name) AS rank
    FROM (
      SELECT s.hall_id, s.day, s.meter_id, COALESCE(d.meter_name, s.meter_id) AS meter_name,
             SUM(s.s) AS total_consumption
      FROM (SELECT f.hall_id, CAST(f."timestamp" AS DATE) AS day, f.meter_id, SUM(f.value) AS s
            FROM fact f WHERE {where}
            GROUP BY f.hall_id, CAST(f."timestamp" AS DATE), f.meter_id) s
      LEFT JOIN {dim} d ON s.meter_id = d.meter_id
      GROUP BY s.hall_id, s.day, s.meter_id, d.meter_name))
  WHERE rank <= {int(top_n)}"""


_TOP_DAY = """
  SELECT hall_id, day, ROUND(daily_total, 2) AS daily_total FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY hall_id ORDER BY daily_total DESC, day) AS rn
    FROM (SELECT hall_id, CAST("timestamp" AS DATE) AS day, SUM(value) AS daily_total
          FROM fact WHERE value > 0 GROUP BY 1, 2))
  WHERE rn = 1"""


def _peak_sql(series: str, keys: str) -> str:
    """Peak interval over CTE ``series`` (keys, timestamp, consumption)."""
    return f"""
g AS (SELECT *, epoch_us("timestamp")
               - epoch_us(LAG("timestamp") OVER (PARTITION BY {keys} ORDER BY "timestamp")) AS gap
      FROM {series}),
gc AS (SELECT {keys}, gap, COUNT(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY {keys}, gap),
st AS (SELECT {keys}, gap AS step_us FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY n DESC, gap) AS rn FROM gc)
       WHERE rn = 1),
pk AS (SELECT {keys}, "timestamp" AS peak_start, consumption AS peak_value FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys}
                                      ORDER BY consumption DESC, "timestamp") AS rn FROM {series})
       WHERE rn = 1),
peak AS (SELECT pk.*, pk.peak_start + to_microseconds(COALESCE(st.step_us, 900000000)) AS peak_end,
                CAST(COALESCE(st.step_us, 900000000) // 1000000 AS BIGINT) AS step_seconds
         FROM pk LEFT JOIN st USING ({keys}))"""


def _drill_sql(gold: str, where_range: str = "TRUE", where_days: str = "TRUE") -> str:
    """Three-step drill-down, per hall, as the dashboard runs it."""
    return f"""WITH {gold},
days AS (SELECT hall_id, CAST("timestamp" AS DATE) AS day, SUM(value) AS daily_total
         FROM fact WHERE value > 0 AND {where_range} GROUP BY 1, 2),
best_day AS (SELECT hall_id, day AS top_day, daily_total AS top_day_total FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY hall_id ORDER BY daily_total DESC, day) AS rn
    FROM days) WHERE rn = 1),
meters AS (SELECT f.hall_id, f.meter_id, COALESCE(d.meter_name, f.meter_id) AS meter_name,
                  SUM(f.value) AS total
           FROM fact f JOIN best_day b ON f.hall_id = b.hall_id
                                      AND CAST(f."timestamp" AS DATE) = b.top_day
           LEFT JOIN dim_meter d ON f.meter_id = d.meter_id
           WHERE f.value > 0
           GROUP BY f.hall_id, f.meter_id, d.meter_name),
best_meter AS (SELECT hall_id, meter_id AS top_meter_id, meter_name AS top_meter_name,
                      total AS top_meter_total FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY hall_id ORDER BY total DESC, meter_id, meter_name) AS rn
    FROM meters) WHERE rn = 1),
win AS (SELECT * FROM best_day JOIN best_meter USING (hall_id)),
series AS (SELECT f.hall_id, f."timestamp", f.value AS consumption
           FROM fact f JOIN win w ON f.hall_id = w.hall_id AND f.meter_id = w.top_meter_id
                                 AND CAST(f."timestamp" AS DATE) = w.top_day
           WHERE f.value > 0),
{_peak_sql("series", "hall_id")},
drill AS (SELECT win.*, peak.peak_start, peak.peak_end, peak.peak_value, peak.step_seconds
          FROM win LEFT JOIN peak USING (hall_id))"""


_DRILL_COLS = """hall_id, top_day, ROUND(top_day_total, 2) AS top_day_total, top_meter_id,
  top_meter_name, ROUND(top_meter_total, 2) AS top_meter_total, peak_start, peak_end,
  ROUND(peak_value, 2) AS peak_value, step_seconds"""


# the cells table built in SQL, the grid steps as plain SQL over it, and
# the silver rows expected straight from the events (independent of the grid
# logic).
_F3_CELLS = """
ev3 AS (
  SELECT event_id, ts, value, event_type, CAST(user_id % 8 AS INTEGER) AS slot,
         'Export_H' || CASE event_type WHEN 'click' THEN '1' WHEN 'error' THEN '2'
                       WHEN 'purchase' THEN '3' WHEN 'signup' THEN '7' WHEN 'view' THEN '8' END
           || '_' || event_type || '.xlsx' AS src_file
  FROM events),
dsrc AS (
  SELECT event_id, ts, value, src_file, slot AS sheet_idx, slot AS layout FROM ev3
  UNION ALL
  SELECT event_id, ts, value, 'Export_H1_zz.xlsx', 0, 0 FROM ev3
  WHERE event_type = 'view' AND slot = 0),
sh AS (SELECT DISTINCT src_file, sheet_idx, layout FROM dsrc),
sh2 AS (SELECT src_file, sheet_idx, 'Z ' || (100 + layout) || ' (m)' AS sheet_name, layout FROM sh
        UNION ALL
        SELECT src_file, 1, 'Leer', 0 FROM sh
        WHERE src_file = 'Export_H1_zz.xlsx' AND sheet_idx = 0),
head AS (
  SELECT src_file, sheet_idx, sheet_name, 2 AS row_no, 0 AS col_no, '570' AS value, 'n' AS kind FROM sh2
  UNION ALL SELECT src_file, sheet_idx, sheet_name, 2, 1, 'Z ' || (100 + layout), 's' FROM sh2
  UNION ALL SELECT src_file, sheet_idx, sheet_name, 2, 2, 'Lade ' || layout, 's' FROM sh2 WHERE layout <> 3
  UNION ALL SELECT src_file, sheet_idx, sheet_name, 3, 0, ' Zeitbereich', 's' FROM sh2 WHERE layout % 2 = 1
  UNION ALL SELECT src_file, sheet_idx, sheet_name, 3, 1,
                   CASE WHEN layout = 4 THEN 'Leistung' WHEN layout % 2 = 1 THEN 'Wirkleistung [30 m]'
                        ELSE 'Wirkleistung [15 m]' END, 's' FROM sh2
  UNION ALL SELECT src_file, sheet_idx, sheet_name, 4, 0,
                   CASE WHEN layout = 2 THEN 'Datum/Zeit' ELSE 'Zeitbereich' END, 's'
            FROM sh2 WHERE layout % 2 = 0
  UNION ALL SELECT src_file, sheet_idx, sheet_name, 4, 1, ' Wert ', 's' FROM sh2),
body AS (
  SELECT src_file, sheet_idx, 'Z ' || (100 + layout) || ' (m)' AS sheet_name, 5 + event_id AS row_no,
         0 AS col_no,
         CASE WHEN event_id % 50 = 2 THEN 'Summe' ELSE strftime(ts, '%d.%m.%Y %H:%M:%S') END AS value,
         's' AS kind
  FROM dsrc
  UNION ALL
  SELECT src_file, sheet_idx, 'Z ' || (100 + layout) || ' (m)', 5 + event_id, 1,
         CASE WHEN event_id % 20 = 1 THEN '#N/A' WHEN layout = 6 AND event_id % 3 = 0 THEN 'x'
              ELSE printf('%.2f', value) END,
         CASE WHEN event_id % 20 = 1 OR (layout = 6 AND event_id % 3 = 0) THEN 's' ELSE 'n' END
  FROM dsrc),
cells AS (SELECT * FROM head UNION ALL SELECT * FROM body)"""

_NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INTERVAL_RE = r"\[(\d+)\s*m\]"

_F3_GRID = _F3_CELLS + f""",
top AS (SELECT * FROM cells WHERE row_no IN (2, 3) AND kind = 's' AND trim(value) <> ''),
r2 AS (SELECT src_file, sheet_idx, value,
              row_number() OVER (PARTITION BY src_file, sheet_idx ORDER BY col_no) AS k
       FROM top WHERE row_no = 2),
r3 AS (SELECT src_file, sheet_idx,
              arg_min(value, col_no) FILTER (WHERE regexp_matches(value, '{_INTERVAL_RE}')) AS hit,
              arg_max(value, col_no) AS last,
              bool_or(lower(trim(value)) = 'zeitbereich') AS patch
       FROM top WHERE row_no = 3 GROUP BY src_file, sheet_idx),
tops AS (SELECT DISTINCT src_file, sheet_idx FROM top),
meta AS (
  SELECT t.src_file, t.sheet_idx, n1.value AS meter_name, n2.value AS meter_desc,
         COALESCE(r3.hit, r3.last, '') AS interval_label,
         COALESCE(TRY_CAST(NULLIF(regexp_extract(COALESCE(r3.hit, r3.last, ''), '{_INTERVAL_RE}', 1), '')
                  AS INTEGER), 15) AS interval_minutes,
         COALESCE(r3.patch, FALSE) AS header_patch
  FROM tops t
  LEFT JOIN r2 n1 ON n1.src_file = t.src_file AND n1.sheet_idx = t.sheet_idx AND n1.k = 1
  LEFT JOIN r2 n2 ON n2.src_file = t.src_file AND n2.sheet_idx = t.sheet_idx AND n2.k = 2
  LEFT JOIN r3 ON r3.src_file = t.src_file AND r3.sheet_idx = t.sheet_idx),
dc AS (SELECT src_file, sheet_idx, sheet_name, row_no, col_no, kind,
              CASE WHEN value IN ('#N/A', '#N/A.NA', 'N/A', 'NA', 'NaN', 'None', '') THEN NULL
                   ELSE value END AS value
       FROM cells WHERE row_no > 4),
stats AS (SELECT src_file, sheet_idx, col_no, count(value) AS n_present,
                 count(CASE WHEN regexp_matches(value, '{_NUM_RE}') THEN 1 END) AS n_numeric
          FROM dc GROUP BY src_file, sheet_idx, col_no),
stats2 AS (SELECT *, n_present > 0
                     AND n_numeric >= greatest(1, CAST(floor(0.8::DOUBLE * n_present) AS BIGINT)) AS numeric
           FROM stats),
hc AS (SELECT src_file, sheet_idx, col_no, value AS h FROM cells WHERE row_no = 4),
sheetnames AS (SELECT DISTINCT src_file, sheet_idx, sheet_name FROM cells),
cols0 AS (
  SELECT COALESCE(h.src_file, s.src_file) AS src_file, COALESCE(h.sheet_idx, s.sheet_idx) AS sheet_idx,
         COALESCE(h.col_no, s.col_no) AS col_no, h.h, COALESCE(s.numeric, FALSE) AS numeric,
         s.src_file IS NOT NULL AS has_data
  FROM hc h FULL JOIN stats2 s
    ON h.src_file = s.src_file AND h.sheet_idx = s.sheet_idx AND h.col_no = s.col_no),
cols1 AS (
  SELECT c.*, CASE WHEN c.col_no = 0 AND COALESCE(m.header_patch, FALSE) THEN 'Zeitbereich'
                   WHEN c.h IS NOT NULL THEN trim(c.h)
                   ELSE 'col_' || c.col_no END AS name0
  FROM cols0 c LEFT JOIN meta m ON c.src_file = m.src_file AND c.sheet_idx = m.sheet_idx),
info AS (
  SELECT c.src_file, c.sheet_idx, c.col_no, n.sheet_name, c.numeric, c.has_data,
         CASE WHEN row_number() OVER (PARTITION BY c.src_file, c.sheet_idx, c.name0 ORDER BY c.col_no) = 1
              THEN c.name0 ELSE c.name0 || '_' || c.col_no END AS name
  FROM cols1 c JOIN sheetnames n ON c.src_file = n.src_file AND c.sheet_idx = n.sheet_idx),
roles0 AS (
  SELECT src_file, sheet_idx,
         min(CASE WHEN lower(trim(name)) = 'zeitbereich' THEN col_no END) AS t_exact,
         min(CASE WHEN contains(lower(trim(name)), 'zeit') OR contains(lower(trim(name)), 'time')
                    OR contains(lower(trim(name)), 'date') OR contains(lower(trim(name)), 'timestamp')
                  THEN col_no END) AS t_hint,
         min(CASE WHEN lower(trim(name)) = 'wert' THEN col_no END) AS value_col
  FROM info GROUP BY src_file, sheet_idx),
roles AS (
  SELECT r.src_file, r.sheet_idx, COALESCE(r.t_exact, r.t_hint) AS time_col, r.value_col,
         t.name AS time_name, v.name AS value_name, v.numeric AS value_numeric
  FROM roles0 r
  LEFT JOIN info t ON t.src_file = r.src_file AND t.sheet_idx = r.sheet_idx
                  AND t.col_no = COALESCE(r.t_exact, r.t_hint)
  LEFT JOIN info v ON v.src_file = r.src_file AND v.sheet_idx = r.sheet_idx AND v.col_no = r.value_col),
ne AS (SELECT DISTINCT i.src_file, i.sheet_idx, i.sheet_name FROM info i WHERE i.has_data),
ids0 AS (SELECT *, regexp_extract(src_file, '(H\\d+|NVP)', 1) AS m,
                trim(regexp_replace(sheet_name, '[^A-Za-z0-9_]+', '_', 'g'), '_') AS sheet_key
         FROM ne),
ids AS (SELECT src_file, sheet_idx, sheet_name,
               CASE WHEN m <> '' THEN m ELSE regexp_replace(src_file, '\\.[^.]*$', '') END AS hall_id,
               'Hall ' || CASE WHEN m <> '' THEN m ELSE regexp_replace(src_file, '\\.[^.]*$', '') END
                 AS hall_label,
               sheet_key,
               lower(CASE WHEN m <> '' THEN m ELSE regexp_replace(src_file, '\\.[^.]*$', '') END
                     || '_' || sheet_key) AS meter_id
        FROM ids0),
lw AS (SELECT hall_id, sheet_key, src_file, sheet_idx FROM (
         SELECT *, row_number() OVER (PARTITION BY hall_id, sheet_key
                                      ORDER BY src_file DESC, sheet_idx DESC) AS rn FROM ids)
       WHERE rn = 1),
side AS (SELECT i.src_file, i.sheet_idx, i.col_no, i.name, i.numeric, r.time_col, r.value_col
         FROM info i LEFT JOIN roles r ON i.src_file = r.src_file AND i.sheet_idx = r.sheet_idx),
rec AS (
  SELECT d.src_file, d.sheet_idx, d.row_no,
         string_agg(s.name || '=' || COALESCE(d.value, ''), ';'
                    ORDER BY s.name || '=' || COALESCE(d.value, '')) AS cells,
         max(CASE WHEN d.col_no = s.time_col THEN d.value END) AS timestamp_raw,
         max(CASE WHEN d.col_no = s.time_col THEN d.kind END) AS timestamp_kind,
         max(CASE WHEN d.col_no = s.value_col AND s.numeric AND regexp_matches(d.value, '{_NUM_RE}')
                  THEN TRY_CAST(trim(d.value) AS DOUBLE) END) AS value
  FROM dc d JOIN side s ON d.src_file = s.src_file AND d.sheet_idx = s.sheet_idx AND d.col_no = s.col_no
  GROUP BY d.src_file, d.sheet_idx, d.row_no),
prov AS (
  SELECT i.src_file, i.sheet_idx, i.hall_id, i.sheet_key, i.hall_label, i.meter_id,
         COALESCE(NULLIF(m.meter_name, ''), i.sheet_name) AS meter_name,
         COALESCE(m.meter_desc, '') AS meter_desc,
         COALESCE(m.interval_minutes, 15) AS interval_minutes
  FROM lw JOIN ids i ON lw.hall_id = i.hall_id AND lw.sheet_key = i.sheet_key
                    AND lw.src_file = i.src_file AND lw.sheet_idx = i.sheet_idx
  LEFT JOIN meta m ON m.src_file = i.src_file AND m.sheet_idx = i.sheet_idx),
bronze AS (
  SELECT p.hall_id, p.sheet_key, p.hall_label, p.meter_id, p.meter_name, p.meter_desc,
         p.interval_minutes, r.src_file, r.sheet_idx, r.row_no, r.timestamp_raw, r.timestamp_kind,
         r.value, r.cells
  FROM rec r JOIN prov p ON r.src_file = p.src_file AND r.sheet_idx = p.sheet_idx)"""

# Silver rows as the fixture defines them, computed from the events alone.
_F3_VERDICT = """
verdict AS (
  SELECT src_file, sheet_idx,
         count(*) FILTER (WHERE event_id % 20 <> 1) AS n_present,
         count(*) FILTER (WHERE event_id % 20 <> 1 AND NOT (layout = 6 AND event_id % 3 = 0))
           AS n_numeric
  FROM dsrc GROUP BY src_file, sheet_idx)"""

_F3_SILVER_SELECT = """
  SELECT regexp_extract(src_file, 'H[0-9]+') AS hall_id,
         'Hall ' || regexp_extract(src_file, 'H[0-9]+') AS hall_label,
         lower(regexp_extract(src_file, 'H[0-9]+')) || '_z_' || (100 + layout) || '_m' AS meter_id,
         'Z ' || (100 + layout) AS meter_name,
         CASE WHEN layout = 3 THEN '' ELSE 'Lade ' || layout END AS meter_desc,
         date_trunc('second', ts) AS "timestamp",
         CASE WHEN event_id % 20 = 1 OR (layout = 6 AND event_id % 3 = 0) THEN NULL
              WHEN v.n_present > 0
                   AND v.n_numeric >= greatest(1, CAST(floor(0.8::DOUBLE * v.n_present) AS BIGINT))
              THEN round(value, 2) END AS value,
         CASE WHEN layout % 2 = 1 THEN 30 ELSE 15 END AS interval_minutes,
         src_file
  FROM dsrc d JOIN verdict v USING (src_file, sheet_idx)
  WHERE event_id % 50 <> 2
    AND NOT (src_file = 'Export_H1_click.xlsx' AND sheet_idx = 0
             AND EXISTS (SELECT 1 FROM dsrc z WHERE z.src_file = 'Export_H1_zz.xlsx'))"""

_F3_SILVER = _F3_CELLS + "," + _F3_VERDICT + f""",
silver AS ({_F3_SILVER_SELECT}),
fact AS (SELECT hall_id, meter_id, "timestamp", value FROM silver),
dim_hall AS (SELECT DISTINCT hall_id, hall_label FROM silver),
dim_meter AS (SELECT DISTINCT hall_id, meter_id, meter_name, meter_desc FROM silver)"""


def own_oracle_sql() -> dict[str, str]:
    edge_a, edge_b = EDGE_RANGE
    halls = ", ".join(
        f"COALESCE(ROUND(SUM(CASE WHEN hall_id = '{h}' THEN daily_total END), 2), 0) AS \"{h}\""
        for h in F1_HALLS)
    named = ", ".join(f"'{m}'" for m in F1_METERS)
    meters = ", ".join(
        f"COALESCE(ROUND(SUM(CASE WHEN {test} THEN daily_total END), 2), 0) AS \"{m}\""
        for m, test in [*((m, f"meter_name = '{m}'") for m in F1_METERS),
                        ("Other", f"meter_name NOT IN ({named})")])
    sql = {
        "hall_list": f"""WITH {_F1}
  SELECT DISTINCT hall_id FROM dim_hall WHERE hall_id IS NOT NULL ORDER BY hall_id""",

        "daily_totals": f"""WITH {_F1}, t AS ({_daily_sql()})
  SELECT hall_id, day, meter_id, meter_name, ROUND(daily_total, 2) AS daily_total FROM t""",

        "daily_totals_range_edge": f"""WITH {_F1},
  a AS ({_daily_sql(f"f.value > 0 AND f.timestamp BETWEEN TIMESTAMP '{edge_a}' AND TIMESTAMP '{edge_b}'")}),
  b AS ({_daily_sql(f"f.value > 0 AND f.timestamp >= TIMESTAMP '{edge_a}' AND f.timestamp < TIMESTAMP '{edge_b}' + INTERVAL 1 DAY")})
  SELECT hall_id, day, meter_id, meter_name, ROUND(daily_total, 2) AS daily_total, 'between' AS end_mode FROM a
  UNION ALL
  SELECT hall_id, day, meter_id, meter_name, ROUND(daily_total, 2) AS daily_total, 'whole_day' AS end_mode FROM b""",

        "top_day": f"WITH {_F1} {_TOP_DAY}",
        "top_day_all_halls": f"WITH {_F2} {_TOP_DAY}",

        "meter_breakdown": f"WITH {_F1} {_breakdown_sql()}",
        "meter_breakdown_unfiltered": f"WITH {_F1} {_breakdown_sql('TRUE')}",

        "meter_timeseries": f"""WITH {_F1}
  SELECT hall_id, meter_id, CAST("timestamp" AS DATE) AS day, "timestamp",
         ROUND(value, 2) AS consumption
  FROM fact WHERE value > 0 ORDER BY hall_id, meter_id, "timestamp\"""",

        "peak_interval": f"""WITH {_F1},
series AS (SELECT hall_id, meter_id, CAST("timestamp" AS DATE) AS day, "timestamp",
                  value AS consumption FROM fact WHERE value > 0),
{_peak_sql("series", "hall_id, meter_id, day")}
  SELECT hall_id, meter_id, day, peak_start, peak_end, ROUND(peak_value, 2) AS peak_value,
         step_seconds FROM peak""",

        "peak_drilldown": _drill_sql(_F1) + f" SELECT {_DRILL_COLS} FROM drill",
        "peak_drilldown_range": _drill_sql(
            _F1, f"\"timestamp\" BETWEEN TIMESTAMP '{edge_a}' AND TIMESTAMP '{edge_b}'")
            + f" SELECT {_DRILL_COLS} FROM drill",
        "peak_drilldown_whole_day": _drill_sql(
            _F1, f"\"timestamp\" >= TIMESTAMP '{edge_a}' AND "
                 f"\"timestamp\" < TIMESTAMP '{edge_b}' + INTERVAL 1 DAY")
            + f" SELECT {_DRILL_COLS} FROM drill",
        "peak_drilldown_large": _drill_sql(_F2) + f" SELECT {_DRILL_COLS} FROM drill",

        "top_n_other": f"""WITH {_F1}, daily AS ({_daily_sql()}),
  tot AS (SELECT hall_id, meter_name, SUM(daily_total) AS t FROM daily GROUP BY 1, 2),
  top AS (SELECT hall_id, meter_name FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY hall_id ORDER BY t DESC, meter_name) AS rn
      FROM tot) WHERE rn <= 5)
  SELECT d.hall_id, d.day,
         CASE WHEN t.meter_name IS NOT NULL THEN d.meter_name ELSE 'Other' END AS meter_group,
         ROUND(SUM(d.daily_total), 2) AS daily_total
  FROM daily d LEFT JOIN top t ON d.hall_id = t.hall_id AND d.meter_name = t.meter_name
  GROUP BY 1, 2, 3""",

        "daily_pivot": f"""WITH {_F1}, daily AS ({_daily_sql()})
  SELECT day, {halls} FROM daily GROUP BY day ORDER BY day""",

        "daily_pivot_meters": f"""WITH {_F1}, daily AS ({_daily_sql()})
  SELECT hall_id, day, {meters} FROM daily GROUP BY hall_id, day""",

        "daily_peak_absent_day": f"""WITH {_F1}, daily AS ({_daily_sql()}),
  t AS (SELECT hall_id, day, SUM(daily_total) AS dt FROM daily GROUP BY 1, 2)
  SELECT hall_id, day AS peak_day, ROUND(dt, 2) AS peak_total, ROUND(dt, 2) AS marked_total FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY hall_id ORDER BY dt DESC, day) AS rn FROM t)
  WHERE rn = 1""",

        "daily_peak": f"""WITH {_F1}, daily AS ({_daily_sql()}),
  t AS (SELECT hall_id, day, SUM(daily_total) AS dt FROM daily GROUP BY 1, 2),
  pk AS (SELECT hall_id, day AS peak_day, dt AS peak_total FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY hall_id ORDER BY dt DESC, day) AS rn FROM t)
      WHERE rn = 1),
  td AS ({_TOP_DAY}),
  on_top AS (SELECT t.hall_id, t.dt FROM t JOIN td ON t.hall_id = td.hall_id AND t.day = td.day)
  SELECT pk.hall_id, pk.peak_day, ROUND(pk.peak_total, 2) AS peak_total,
         ROUND(COALESCE(on_top.dt, pk.peak_total), 2) AS marked_total
  FROM pk LEFT JOIN on_top USING (hall_id)""",

        "peak_band": _drill_sql(_F1) + """
  SELECT s.hall_id, w.top_meter_id AS meter_id, s."timestamp", ROUND(s.consumption, 2) AS consumption,
         s."timestamp" >= d.peak_start AND s."timestamp" < d.peak_end AS in_peak
  FROM series s JOIN win w USING (hall_id) JOIN drill d USING (hall_id)""",

        "kpi_strings": _drill_sql(_F1) + """
  SELECT hall_id,
         strftime(top_day, '%d.%m.%Y') AS peak_day_text,
         top_meter_name AS top_machine_text,
         COALESCE(strftime(peak_start, '%H:%M') || '-' || strftime(peak_end, '%H:%M'), '—')
           AS peak_interval_text,
         format('{:,.1f}', ROUND(top_day_total, 9)) || ' kW total' AS peak_day_sub,
         format('{:,.1f}', ROUND(top_meter_total, 9)) || ' kW' AS top_machine_sub,
         CASE WHEN peak_value IS NOT NULL AND peak_value <> 0
              THEN format('{:,.2f}', ROUND(peak_value, 9)) || ' kW' ELSE '' END AS peak_interval_sub
  FROM drill""",

        "fact_measurement": f"""WITH {_F1}
  SELECT hall_id, meter_id, "timestamp", ROUND(value, 2) AS value FROM fact""",
        "dim_hall": f"WITH {_F1} SELECT * FROM dim_hall",
        "dim_meter": f"WITH {_F1} SELECT * FROM dim_meter",
        "dim_meter_dupes": f"""WITH {_F1}, {_FANOUT}
  SELECT meter_id, COUNT(*) AS n_rows, COUNT(DISTINCT meter_name) AS n_names
  FROM dim_fan GROUP BY meter_id HAVING COUNT(*) > 1""",
        "fanout_join": f"WITH {_F1}, {_FANOUT} {_breakdown_sql('TRUE', 'dim_fan')}",

        "sheet_meta": f"WITH {_F3_GRID} SELECT * FROM meta",
        "numeric_rule": f"WITH {_F3_GRID} SELECT * FROM stats2",
        "header_patch": f"""WITH {_F3_GRID}
  SELECT src_file, sheet_idx, col_no, sheet_name, name, has_data FROM info""",
        "role_columns": f"WITH {_F3_GRID} SELECT * FROM roles",
        "ids": f"WITH {_F3_GRID} SELECT * FROM ids",
        "daily_totals_hall": f"""WITH {_F1},
  a AS ({_daily_sql(f"f.value > 0 AND f.hall_id = '{ONE_HALL}' AND f.timestamp BETWEEN TIMESTAMP '{edge_a}' AND TIMESTAMP '{edge_b}'")})
  SELECT hall_id, day, meter_id, meter_name, ROUND(daily_total, 2) AS daily_total FROM a""",
        "meter_breakdown_day": f"""WITH {_F1}
  SELECT hall_id, day, meter_id, meter_name, total_consumption
  FROM ({_breakdown_sql(f"f.value > 0 AND f.hall_id = '{ONE_HALL}' AND CAST(f.timestamp AS DATE) = DATE '{ONE_DAY}'", top_n=3)})""",
        "meter_timeseries_one": f"""WITH {_F1}
  SELECT hall_id, meter_id, CAST("timestamp" AS DATE) AS day, "timestamp", ROUND(value, 2) AS consumption
  FROM fact WHERE value > 0 AND hall_id = '{ONE_HALL}' AND meter_id = '{ONE_METER}'
    AND CAST("timestamp" AS DATE) = DATE '{ONE_DAY}'""",
        "daily_totals_empty": f"""WITH {_F1}, a AS ({_daily_sql("f.value > 0 AND f.hall_id = 'NO SUCH HALL'")})
  SELECT hall_id, day, meter_id, meter_name, ROUND(daily_total, 2) AS daily_total FROM a""",
        "sql_machine_timeseries": f"""WITH {_F1}
  SELECT hall_id, meter_id, "timestamp", ROUND(value, 2) AS consumption
  FROM fact WHERE value > 0 AND hall_id = '{ONE_HALL}' AND meter_id = '{ONE_METER}'
    AND CAST("timestamp" AS DATE) = DATE '{ONE_DAY}'""",
        "fact_count": f"WITH {_F1} SELECT count(*) AS n_rows FROM fact",
        "last_writer": f"WITH {_F3_GRID} SELECT * FROM lw",
        "grid_records": f"""WITH {_F3_GRID}
  SELECT hall_id, sheet_key, hall_label, meter_id, meter_name, meter_desc, interval_minutes,
         src_file, sheet_idx, row_no, timestamp_raw, timestamp_kind, ROUND(value, 2) AS value, cells
  FROM bronze""",
        "fill_missing": f"WITH {_F3_SILVER} SELECT * REPLACE (COALESCE(value, 0.0) AS value) FROM silver",
        "parse_timestamps": f"WITH {_F3_SILVER} SELECT * FROM silver",
        "conform_schema": f"""WITH {_F1}
  SELECT hall_id, hall_label, meter_id, meter_name, CAST(NULL AS VARCHAR) AS meter_desc, "timestamp",
         ROUND(value, 2) AS value, CAST(NULL AS INTEGER) AS interval_minutes, src_file
  FROM silver""",
        "silver_drilldown": _drill_sql(_F3_SILVER) + f" SELECT {_DRILL_COLS} FROM drill",
        "lake_drilldown": _drill_sql(_F3_SILVER) + f" SELECT {_DRILL_COLS} FROM drill",
        "run_metrics": f"""WITH {_F3_GRID},{_F3_VERDICT},
exp AS ({_F3_SILVER_SELECT}),
n AS (SELECT (SELECT count(*) FROM cells) AS cells_rows,
             (SELECT count(*) FROM (SELECT DISTINCT src_file, sheet_idx, col_no FROM cells))
               AS columns_rows,
             (SELECT count(*) FROM bronze) AS bronze_rows,
             (SELECT count(*) FROM exp) AS silver_rows,
             (SELECT count(*) FROM (SELECT DISTINCT hall_id, CAST("timestamp" AS DATE), meter_id FROM exp)) AS meter_day_rows,
             (SELECT count(*) FROM (SELECT DISTINCT hall_id, hall_label FROM exp)) AS dim_hall_rows,
             (SELECT count(*) FROM (SELECT DISTINCT hall_id, meter_id, meter_name, meter_desc
                                    FROM exp)) AS dim_meter_rows)
  SELECT * FROM (VALUES ('cells_rows'), ('columns_rows'), ('bronze_rows'), ('bronze_read'),
                        ('silver_rows'), ('silver_dropped'), ('fact_rows'), ('dim_hall_rows'),
                        ('dim_meter_rows'), ('meter_day_rows')) AS m(metric),
         LATERAL (SELECT CAST(CASE m.metric
             WHEN 'cells_rows' THEN cells_rows WHEN 'columns_rows' THEN columns_rows
             WHEN 'bronze_rows' THEN bronze_rows WHEN 'bronze_read' THEN bronze_rows
             WHEN 'silver_rows' THEN silver_rows WHEN 'silver_dropped' THEN bronze_rows - silver_rows
             WHEN 'fact_rows' THEN silver_rows WHEN 'dim_hall_rows' THEN dim_hall_rows
             WHEN 'meter_day_rows' THEN meter_day_rows
             ELSE dim_meter_rows END AS BIGINT) AS value FROM n)""",
        "sql_halls": f"""WITH {_F1}
  SELECT DISTINCT hall_id FROM dim_hall WHERE hall_id IS NOT NULL ORDER BY hall_id""",
        "sql_daily_totals": f"""WITH {_F1},
  a AS ({_daily_sql(f"f.value > 0 AND f.timestamp BETWEEN TIMESTAMP '{edge_a}' AND TIMESTAMP '{edge_b}'")})
  SELECT hall_id, day, meter_id, meter_name, ROUND(daily_total, 2) AS daily_total FROM a""",
        "sql_top_day": f"WITH {_F2} {_TOP_DAY}",
        "sql_machine_breakdown": f"""WITH {_F1}
  SELECT hall_id, day, meter_id, meter_name, total_consumption FROM ({_breakdown_sql()})""",
    }
    # the same questions over written gold
    for name in ("meter_breakdown_day", "meter_timeseries_one", "daily_totals_range_edge", "peak_drilldown_range"):
        sql[f"lake_{name}"] = sql[name]
    halls = ", ".join("'" + re.search(r"H\d+", f)[0] + "'" for f in SECOND_ARRIVAL)
    sql["lake_two_arrivals"] = _drill_sql(_F3_SILVER) + f" SELECT {_DRILL_COLS}, hall_id IN ({halls}) AS rewritten FROM drill"
    hall_no = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FX.F3_HALL_NO.items())
    sql["lake_archive"] = f"""WITH files AS (
  SELECT 'H' || CASE event_type {hall_no} END AS hall_id, CAST(ts AS DATE) AS day, max(hour(ts)) AS last_hour,
         string_agg(event_id || ';' || user_id || ';' || event_type, chr(10) ORDER BY event_id) AS txt
  FROM events GROUP BY event_type, CAST(ts AS DATE))
  SELECT hall_id, 'Export_' || hall_id || '_' || CAST(day AS VARCHAR) || '.xlsx' AS src_file,
         CASE WHEN last_hour >= {FX.F5_FIRST_EXPORT} THEN 0 ELSE {FX.F5_FIRST_EXPORT} END AS exported_hour,
         CAST(octet_length(encode(txt)) AS BIGINT) AS length, sha256(txt) AS sha256, true AS intact FROM files"""
    sql["run_outcomes"] = f"""WITH {_F3_CELLS},{_F3_VERDICT},
exp AS ({_F3_SILVER_SELECT})
  SELECT CAST(1 AS BIGINT) AS run_no, 'skipped' AS status, CAST(NULL AS VARCHAR) AS failed_task,
         CAST(NULL AS VARCHAR) AS workbook, CAST(0 AS BIGINT) AS silver_rows
  UNION ALL SELECT 2, 'failed', 'ingest', (SELECT DISTINCT src_file FROM cells WHERE contains(src_file, 'purchase')), NULL
  UNION ALL SELECT 3, 'success', NULL, NULL, (SELECT count(*) FROM exp)"""
    sql["foreign_hall_folders"] = f"""WITH {_F1}
  SELECT hall_id, hall_label, meter_id, meter_name, CAST(NULL AS VARCHAR) AS meter_desc, "timestamp",
         ROUND(value, 2) AS value, interval_minutes, src_file FROM silver"""
    sql["gold_single_files"] = sql["meter_breakdown"]
    drifted = _F1.replace("fact AS (SELECT hall_id, meter_id, \"timestamp\", value FROM silver)", """fact AS (
  SELECT hall_id, meter_id, "timestamp", CASE hall_id WHEN 'PURCHASE' THEN floor(value)
         WHEN 'SIGNUP' THEN NULL WHEN 'VIEW' THEN CAST(CAST(value AS DECIMAL(18, 2)) AS DOUBLE) ELSE value END AS value FROM silver)""")
    sql["gold_union_by_name"] = sql["daily_totals"].replace(_F1, drifted)
    return sql


def _training_data() -> tuple[dict[str, Callable], dict[str, str]]:
    """Queries and SQL of the training-data operators and their pipeline, where
    these are there. A package that they need and that is missing is an error."""
    try:
        import corpus_pipeline
        from meterlake.llm import registry
    except ImportError as e:
        if e.name != "corpus_pipeline" and not (e.name or "").startswith("meterlake.llm"):
            raise
        return {}, {}
    sql = dict(registry.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**registry.QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**own_queries(), **_training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {**own_oracle_sql(), **_training_data()[1]}
