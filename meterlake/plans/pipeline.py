"""Batch pipeline: cells -> bronze -> silver -> gold, with a run log.

Each layer is written to the lake and the next one reads it back, so a
layer is computed once, its lineage ends at the written table (an executor
lost later never re-runs the earlier layers), and a rerun can start from any
written layer. Row counts come from observations on the writes.

Steps mirror the reference's tasks (ingest, clean, derive, notify); a failure
is logged with the failing step and re-raised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import hall_id_of
from ..operators.gold import build_gold
from ..operators.grid import bronze_from, column_profile
from ..operators.silver import to_silver
from ..schema import CELLS
from ..session import observed
from ..sources import lake, workbook


def stage_cells(cells: DataFrame, root: str) -> dict:
    """Write this run's cells to ``cells/`` (replaced each run). The grid
    steps read the cells several times; reading a written table keeps the
    decoder (or any upstream plan) to a single pass and ends the lineage."""
    return lake.write_table(cells, lake.layer_path(root, "cells"), [], "cells")


def ingest(cells: DataFrame, root: str, *, decimal_comma: bool = False) -> dict:
    """cells -> staged cells -> column profile -> bronze (one partition per
    hall and sheet key). Three jobs, each reading what the previous one
    wrote: the cells are scanned once for the profile and once for the
    records; all sheet metadata comes from the small profile table."""
    spark = cells.sparkSession
    m = stage_cells(cells, root)
    staged = spark.read.schema(CELLS).parquet(lake.layer_path(root, "cells"))
    m.update(lake.write_table(column_profile(staged, decimal_comma=decimal_comma),
                         lake.layer_path(root, "columns"), [], "columns"))
    profile = spark.read.parquet(lake.layer_path(root, "columns"))
    m.update(lake.write_bronze(bronze_from(staged, profile, decimal_comma=decimal_comma), root))
    return m


def clean(spark: SparkSession, root: str, *, fill_missing: float | None = None,
          halls: list | None = None) -> dict:
    """bronze (all partitions, earlier runs included) -> silver per hall; with
    ``halls`` only these are read and replaced. ``silver_dropped`` counts rows
    without a valid reading time."""
    obs = Observation("bronze_in")
    b = lake.read_bronze(spark, root, halls).observe(obs, F.count(F.lit(1)).alias("rows"))
    m = lake.write_silver(to_silver(b, fill_missing=fill_missing), root, halls)
    m["bronze_read"] = int(observed(obs).get("rows") or 0)
    m["silver_dropped"] = m["bronze_read"] - m["silver_rows"]
    return m


def derive(spark: SparkSession, root: str, *, halls: list | None = None) -> dict:
    """silver -> gold star schema (fact, two dims, daily rollup), published as
    one version; with ``halls`` only these are read and replaced."""
    return lake.write_gold(build_gold(lake.read_silver(spark, root, halls)), root, halls)


def halls_of(files: DataFrame, column: str = "src_file") -> list[str]:
    """The halls that files belong to (bounded by the number of halls)."""
    rows = files.select(hall_id_of(F.col(column)).alias("hall_id")).distinct().collect()
    return sorted(r["hall_id"] for r in rows)


def refresh(spark: SparkSession, cells: DataFrame, root: str, *, halls: list | None = None,
            decimal_comma: bool = False, fill_missing: float | None = None) -> dict:
    """Cells of newly arrived workbooks into the lake: their bronze partitions,
    then silver and gold of the halls they belong to (``halls``, found in the
    cells when not given). Other halls are neither read nor written."""
    m = ingest(cells, root, decimal_comma=decimal_comma)
    if halls is None:
        halls = halls_of(spark.read.schema(CELLS).parquet(lake.layer_path(root, "cells")))
    if not lake.layer_exists(spark, root, "bronze"):
        return m
    m.update(clean(spark, root, fill_missing=fill_missing, halls=halls))
    m.update(derive(spark, root, halls=halls))
    return m


def run(spark: SparkSession, cells: DataFrame, root: str, *, decimal_comma: bool = False,
        fill_missing: float | None = None, log: bool = True, counted: dict | None = None) -> dict:
    """Whole batch run. Returns the metrics (``counted`` are those of steps
    before it); status ``skipped`` when a layer has no rows (nothing downstream
    is written then)."""
    metrics: dict = dict(counted or {})
    task = "ingest"
    status = "success"
    try:
        metrics.update(ingest(cells, root, decimal_comma=decimal_comma))
        if not lake.layer_exists(spark, root, "bronze"):
            status = "skipped"
        else:
            task = "clean"
            metrics.update(clean(spark, root, fill_missing=fill_missing))
            if metrics["silver_rows"] == 0 and lake.read_silver(spark, root).isEmpty():
                status = "skipped"
            else:
                task = "derive"
                metrics.update(derive(spark, root))
    except Exception as e:
        if log:
            lake.append_run_log(spark, root, "failed", failed_task=task,
                                error=f"{type(e).__name__}: {e}", metrics=metrics)
        raise
    if log:
        lake.append_run_log(spark, root, status, metrics=metrics)
    metrics["status"] = status
    return metrics


def run_workbooks(spark: SparkSession, files: DataFrame, root: str, **kw) -> dict:
    """Workbook files (``binaryFile`` rows) -> archive + whole pipeline.
    Status ``skipped`` when there is no workbook."""
    if files.isEmpty():
        if kw.get("log", True):
            lake.append_run_log(spark, root, "skipped", metrics={"files_rows": 0})
        return {"files_rows": 0, "status": "skipped"}
    m = workbook.archive(files, root)
    with workbook.few_files_per_batch(spark):
        # the cells are written inside ``run`` (stage_cells) under this setting
        return run(spark, workbook.cells_of(files), root, counted=m, **kw)


def run_folder(spark: SparkSession, path: str, root: str, **kw) -> dict:
    """Every workbook under ``path`` (batch: all files, each run)."""
    try:
        files = workbook.list_workbooks(spark, path)
    except ValueError as e:
        if kw.get("log", True):
            lake.append_run_log(spark, root, "failed", failed_task="list", error=f"{type(e).__name__}: {e}")
        raise
    return run_workbooks(spark, files, root, **kw)
