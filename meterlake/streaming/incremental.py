"""Process only newly arrived workbooks, then stop (ST-1).

A ``binaryFile`` file stream remembers in its checkpoint which files it has
already seen; ``trigger(availableNow=True)`` takes everything new at start
time (in bounded micro-batches) and ends the query. A micro-batch archives its
files, in one pass, and notes them in ``arrivals/``; its counts are observed on
the stream and come back through a query listener. After the stream, all
arrivals that no finished call has taken are ingested together, from their own
folders of the archive; silver and gold of the halls they belong to are rebuilt
and published; and only then are they noted in ``taken/``. What a call reads
and writes depends on its arrivals and their halls, not on the rest of the
lake.

So the last writer of a (hall, sheet key) is the greatest file name of the
call, however its files fell into micro-batches (across calls the later call
wins), and a call that fails after the stream has committed is made good by
the next one, which finds its arrivals still open.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..plans import pipeline
from ..sources import lake, workbook

BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

ARRIVALS = T.StructType([T.StructField(n, T.StringType()) for n in ("hall_id", "file", "token")])


# Workbooks that one ingest job takes (their folder names are listed by the
# driver), and how long to wait for the last event of an ended stream.
FILES_PER_ROUND = 20_000
LISTENER_SECONDS = 60


def new_workbooks(spark: SparkSession, path: str, max_files_per_batch: int = 1000) -> DataFrame:
    workbook.check_names(spark, path)
    return (spark.readStream.format("binaryFile").schema(BINARY_FILE)
            .option("pathGlobFilter", workbook.XLSX_GLOB)
            .option("recursiveFileLookup", "false")
            .option("maxFilesPerTrigger", str(max_files_per_batch))
            .load(path))


def _open_arrivals(spark: SparkSession, root: str) -> DataFrame | None:
    """Arrivals that no finished call has taken (None: nothing ever arrived)."""
    if not lake.layer_exists(spark, root, "arrivals"):
        return None
    came = spark.read.schema(ARRIVALS).parquet(lake.layer_path(root, "arrivals"))
    if not lake.layer_exists(spark, root, "taken"):
        return came
    return came.join(spark.read.schema(ARRIVALS).parquet(lake.layer_path(root, "taken")), ["token"], "left_anti").select(
        *ARRIVALS.fieldNames())


class BatchCounts(StreamingQueryListener):
    """Observed counts of every micro-batch of the query called ``name``."""

    def __init__(self, name: str):
        self.name, self.run, self.batches, self.ended = name, None, {}, threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = p.observedMetrics.get("arrived") if p.name == self.name else None
        if row is not None and row["files"]:
            self.batches[p.batchId] = {"files": int(row["files"]), "bytes": int(row["bytes"] or 0)}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.ended.set()


def _arrive(spark: SparkSession, path: str, root: str, ckpt: str, max_files_per_batch: int) -> dict:
    """Archive and note what is new. Returns batches, files and bytes as the
    listener saw them, and as they were written."""
    seen: dict = {"batches": 0, "files_rows": 0, "files_bytes": 0}

    def batch(files: DataFrame, batch_id: int) -> None:
        m, names = workbook.archive_named(files, root)
        if not names:
            return
        for k, v in m.items():
            seen[k] += v
        came = spark.createDataFrame([(h, f, uuid.uuid4().hex) for h, f in names], ARRIVALS)
        came.coalesce(1).write.mode("append").parquet(lake.layer_path(root, "arrivals"))
        seen["batches"] += 1

    counts = BatchCounts(f"workbooks-{uuid.uuid4().hex}")
    spark.streams.addListener(counts)
    try:
        arrived = new_workbooks(spark, path, max_files_per_batch).observe(
            "arrived", F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        q = (arrived.writeStream.queryName(counts.name).foreachBatch(batch)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        counts.ended.wait(LISTENER_SECONDS)
    finally:
        spark.streams.removeListener(counts)
    observed = {k: sum(b[k] for b in counts.batches.values()) for k in ("files", "bytes")}
    if (observed["files"], observed["bytes"]) != (seen["files_rows"], seen["files_bytes"]):
        raise RuntimeError(f"micro-batches brought {observed}, but {seen} was archived")
    return seen


def _rounds(todo: DataFrame, most: int) -> Iterator[list[tuple[str, str]]]:
    """Arrivals in order of file name, at most ``most`` at a time (a later
    round overwrites, as the greater file name does)."""
    rows = todo.select("hall_id", "file").distinct().orderBy("file", "hall_id").toLocalIterator()
    while part := list(islice(rows, most)):
        yield [(r["hall_id"], r["file"]) for r in part]


def ingest_available(spark: SparkSession, path: str, root: str, *,
                     checkpoint: str | None = None, max_files_per_batch: int = 1000,
                     refresh_downstream: bool = True) -> dict:
    """Ingest the workbooks that arrived since the last finished call; then
    rebuild silver and gold of their halls when there were any. Returns summed
    metrics; a failure is logged with its step and raised."""
    ckpt = checkpoint or lake.layer_path(root, "_stream_checkpoint")
    totals: dict = {"batches": 0}
    task = "archive"
    try:
        totals.update(_arrive(spark, path, root, ckpt, max_files_per_batch))
        todo = _open_arrivals(spark, root)
        work = todo is not None and not todo.isEmpty()
        if work:
            # the list is written first: what is taken at the end is what was read here
            taking = lake.layer_path(root, "taking")
            todo.write.mode("overwrite").parquet(taking)
            todo = spark.read.schema(ARRIVALS).parquet(taking)
            task = "ingest"
            halls: set = set()
            for names in _rounds(todo, FILES_PER_ROUND):
                with workbook.few_files_per_batch(spark):
                    m = pipeline.ingest(workbook.cells_of(workbook.archived(spark, root, names)), root)
                for k, v in m.items():
                    totals[k] = totals.get(k, 0) + v
                halls.update(h for h, _ in names)
            if refresh_downstream and lake.layer_exists(spark, root, "bronze"):
                task = "clean"
                totals.update(pipeline.clean(spark, root, halls=sorted(halls)))
                task = "derive"
                totals.update(pipeline.derive(spark, root, halls=sorted(halls)))
            todo.write.mode("append").parquet(lake.layer_path(root, "taken"))
    except Exception as e:
        lake.append_run_log(spark, root, "failed", failed_task=task, error=f"{type(e).__name__}: {e}",
                            metrics={k: v for k, v in totals.items() if isinstance(v, int)})
        raise
    lake.append_run_log(spark, root, "success" if work else "skipped",
                        metrics={k: v for k, v in totals.items() if isinstance(v, int)})
    return totals
