"""Lake layers on a shared file system (local, HDFS, s3a://...).

Layout under one root:

* ``bronze/hall_id=<h>/sheet_key=<k>/``  one partition per (hall, sheet key);
  a rerun replaces exactly the partitions it writes (dynamic overwrite),
  partitions of earlier runs stay
* ``silver/v=<version>/hall_id=<h>/``     fixed nine-column schema
* ``gold/<table>/v=<version>/hall_id=<h>/`` for the tables fact_measurement,
  dim_hall, dim_meter and meter_day (the daily rollup)
* ``versions/``                          which version folder of silver and
  gold holds each hall (``sources.versions``): a write is seen only once it is
  published, the four gold tables together
* ``files/hall_id=<h>/file=<name>/``     archived workbooks (bytes + digest)
* ``run_log/``                           one appended row per run

Reads always pass an explicit schema: partition values are never type-inferred
(a hall called ``007`` stays a string), and a missing column reads as NULL.

Writes go through ``rebalance`` on the partition columns: AQE cuts a hot
partition (one hall holding a third of the rows) into several evenly sized
tasks and merges small ones, so no task writes a third of the data and a
hall does not end up as thousands of tiny files.

Row counts of every write are gathered with ``Observation`` during the write
itself (no second pass over the data).
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.gold import Gold, meter_day
from ..schema import (BRONZE, DIM_HALL, DIM_METER, FACT, FACT_STORED, METER_DAY, READING_DATE, RUN_LOG,
                      SILVER)
from ..session import checkpoint_root, observed
from . import versions


def layer_path(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def scratch_root(spark: SparkSession, name: str = "lake") -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    return layer_path(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def write_table(df: DataFrame, path: str, partition_by: list[str], name: str,
           mode: str = "overwrite", extra: dict | None = None,
           rebalance: bool = True, cluster: list | None = None, order: list | None = None,
           options: dict | None = None) -> dict:
    """Write with observed row count; returns ``{name_rows: n}``, and what
    ``extra`` observes, by name. ``cluster`` deals the rows to files by ranges
    of these columns and sorts them inside (the first are the partition
    columns); otherwise the rows are rebalanced, and sorted by ``order``."""
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for k, c in (extra or {}).items():
        aggs.append(c.alias(k))
    if cluster:
        # observed behind the exchange: its sampling runs what lies before it twice
        out = df.repartitionByRange(*cluster).observe(obs, *aggs).sortWithinPartitions(*cluster)
    else:
        out = df.observe(obs, *aggs)
        # rebalance: AQE sizes the written files (splits a hot partition value,
        # merges small ones); without partition columns it only evens file sizes
        if rebalance:
            out = out.hint("rebalance", *partition_by)
        if order:
            out = out.sortWithinPartitions(*order)
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic").options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    got = {"rows": 0, **observed(obs)}
    return {f"{name}_{k}": v if isinstance(v, list) else int(v or 0) for k, v in got.items()}


# ------------------------------------------------------------------- bronze
def write_bronze(bronze: DataFrame, root: str) -> dict:
    """Bronze records, partitioned by (hall_id, sheet_key). Keys that are
    empty (a sheet title without letters or digits) are stored as ``_``; an
    empty partition value would read back as NULL."""
    key = F.when(F.col("sheet_key") == "", F.lit("_")).otherwise(F.col("sheet_key"))
    df = bronze.withColumn("sheet_key", key)
    return write_table(df, layer_path(root, "bronze"), ["hall_id", "sheet_key"], "bronze")


def read_bronze(spark: SparkSession, root: str, halls: list | None = None) -> DataFrame:
    """Bronze of all halls, or of ``halls`` only (the other partitions are
    pruned by value)."""
    b = spark.read.schema(BRONZE).parquet(layer_path(root, "bronze"))
    return b if halls is None else b.where(F.col("hall_id").isin(list(halls)))


# ------------------------------------------------- published layers, by hall
# Layer -> schema of what readers see.
PUBLISHED_LAYERS = {"silver": SILVER, "gold/fact_measurement": FACT_STORED, "gold/dim_hall": DIM_HALL,
                    "gold/dim_meter": DIM_METER, "gold/meter_day": METER_DAY}

# Row groups of the fact: small enough that a day of a hall is a few of them.
FACT_OPTIONS = {"parquet.block.size": str(16 * 1024 * 1024), "parquet.bloom.filter.enabled#meter_id": "true"}


def _write_version(df: DataFrame, root: str, layer: str, folder: str, name: str, **kw) -> tuple[dict, list]:
    """Write one layer to its version folder: metrics and the halls written
    (bounded by the number of halls; null and empty ones are one folder)."""
    halls = F.collect_set(F.coalesce(F.col("hall_id"), F.lit("")))
    m = write_table(df, layer_path(root, layer, folder), ["hall_id"], name, extra={"halls": halls}, **kw)
    return m, m.pop(f"{name}_halls", None) or []


def write_silver(silver: DataFrame, root: str, halls: list | None = None) -> dict:
    """Publish silver of all halls, or of ``halls`` only: a hall that has no
    rows left loses its old ones, all others keep their files."""
    spark = silver.sparkSession
    now = versions.published(spark, root)
    folder = versions.new_folder(now)
    m, written = _write_version(silver, root, "silver", folder, "silver")
    versions.publish(spark, root, now, {"silver": (folder, written)}, halls)
    return m


def read_silver(spark: SparkSession, root: str, halls: list | None = None) -> DataFrame:
    return versions.read(spark, root, "silver", SILVER, halls)


def read_hall_folders(spark: SparkSession, path: str, schema=SILVER) -> DataFrame:
    """Foreign layout ``<path>/<hall>/<file>.parquet`` (no ``key=value``
    folders): the hall is the first folder under ``path`` and overrides any
    ``hall_id`` column; columns absent from the files read as NULL and the
    result has exactly ``schema``."""
    from ..operators.silver import conform
    base = path.rstrip("/").split("/")[-1]
    df = (spark.read.schema(schema).option("recursiveFileLookup", "true")
          .option("pathGlobFilter", "*.parquet").parquet(path))
    hall = F.regexp_extract(F.col("_metadata.file_path"), re.escape(base) + r"/([^/]+)/", 1)
    return conform(df.withColumn("hall_id", hall), schema)


# --------------------------------------------------------------------- gold
def write_gold(gold: Gold, root: str, halls: list | None = None) -> dict:
    """Write the star schema and publish it as one version; with ``halls`` the
    frames hold these halls, and only they are replaced.

    The fact is clustered: ranges of (hall, day, meter, time), sorted inside
    the files, so that the day of a hall lies in few files and row groups and
    a meter's readings of a day lie side by side. It is stored with the date of
    the reading, by which scans skip (``schema.FACT_STORED``). The daily rollup
    is summed from the fact just written."""
    spark = gold.fact.sparkSession
    now = versions.published(spark, root)
    folder = versions.new_folder(now)
    m, changes = {}, {}

    def write(table: str, df: DataFrame, name: str, **kw) -> list:
        got, written = _write_version(df, root, f"gold/{table}", folder, name, **kw)
        m.update(got)
        changes[f"gold/{table}"] = (folder, written)
        return written

    def write_fact() -> None:
        fact = gold.fact.select(*FACT.names, F.to_date("timestamp").alias(READING_DATE))
        written = write("fact_measurement", fact, "fact", options=FACT_OPTIONS,
                        cluster=[F.col(c) for c in ("hall_id", READING_DATE, "meter_id", "timestamp")])
        stored = spark.createDataFrame([], FACT) if not written else versions.read_folders(
            spark, layer_path(root, "gold/fact_measurement"), [folder], FACT)
        write("meter_day", meter_day(stored), "meter_day", order=["hall_id", "day", "meter_id"])

    # the dimensions need nothing of the fact: their jobs fill the gaps between its
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(write_fact), pool.submit(write, "dim_hall", gold.dim_hall, "dim_hall"),
                pool.submit(write, "dim_meter", gold.dim_meter, "dim_meter")]
    for j in jobs:
        j.result()
    versions.publish(spark, root, now, changes, halls)
    return m


def read_gold(spark: SparkSession, root: str) -> Gold:
    """The last published gold, all of its tables of one publication."""
    state = versions.published(spark, root)
    fact, dim_hall, dim_meter, rollup = (
        versions.read(spark, root, f"gold/{t}", PUBLISHED_LAYERS[f"gold/{t}"], state=state)
        for t in ("fact_measurement", "dim_hall", "dim_meter", "meter_day"))
    return Gold(fact, dim_hall, dim_meter, rollup=rollup)


def read_gold_files(spark: SparkSession, fact_path: str, dim_hall_path: str,
                    dim_meter_path: str) -> Gold:
    """Gold from three separate Parquet files or folders (any layout, nested
    ones too, e.g. single exported files), with the gold schemas; dims ordered
    by hall."""
    def rd(path, schema):
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path).select(*[f.name for f in schema.fields])
    return Gold(rd(fact_path, FACT),
                rd(dim_hall_path, DIM_HALL).orderBy(F.asc_nulls_last("hall_id")),
                rd(dim_meter_path, DIM_METER).orderBy(F.asc_nulls_last("hall_id"),
                                                      F.asc_nulls_last("meter_id")))


# ------------------------------------------------------------------ run log
def append_run_log(spark: SparkSession, root: str, status: str, *,
                   failed_task: str | None = None, error: str | None = None,
                   metrics: dict | None = None, run_at: _dt.datetime | None = None) -> None:
    """One row per run: time, status, failed task, error text, row metrics."""
    run_at = run_at or _dt.datetime.now()
    row = [(run_at, status, failed_task, str(error) if error else None,
            {k: int(v) for k, v in (metrics or {}).items()})]
    (spark.createDataFrame(row, RUN_LOG).coalesce(1)
     .write.mode("append").parquet(layer_path(root, "run_log")))


def read_run_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(layer_path(root, "run_log"))


def run_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The run log as rows: (run_at, status, metric, value)."""
    log = read_run_log(spark, root)
    return log.select("run_at", "status", F.explode("metrics").alias("metric", "value"))


def run_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """The run log with every run's number, in order of time: (run_no, run_at,
    status, failed_task, error, metrics). One row a run, so the window is small."""
    log = read_run_log(spark, root)
    n = F.row_number().over(Window.orderBy("run_at")).cast("long")
    return log.select(n.alias("run_no"), "run_at", "status", "failed_task", "error", "metrics")


def layer_exists(spark: SparkSession, root: str, *parts: str) -> bool:
    return _exists(spark, layer_path(root, *parts))


__all__ = [
    "layer_path", "scratch_root", "write_table", "write_bronze", "read_bronze", "write_silver",
    "read_silver", "read_hall_folders", "write_gold", "read_gold_files", "read_gold", "append_run_log",
    "read_run_log", "run_metrics", "run_outcomes", "layer_exists",
]
