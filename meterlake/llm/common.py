"""Helpers shared by the operators: scratch tables on shared storage, row
keys, and Arrow batches cut by bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import checkpoint_root

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# The white space of every contract: space and U+0009..U+000D.
SPACES = " \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()

LONG_MIN = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Folders made since the innermost open ``scratch_removed`` began.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder on the storage that the driver and all executors share."""
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    if _made.get() is not None:
        _made.get().append(path)
    return path


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders; those that are not there are passed over."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[list[str]]:
    """Scratch folders made inside are deleted at the end, also after a
    failure. Take a folder out of the list to keep it. What is read later must
    not stand on the others: write it inside, to a folder that is kept."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        remove(spark, made)


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written to shared storage (``path``, or a new folder) and read
    again: lineage is cut, and a lost executor costs only its running tasks."""
    path = path or scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def signed(x: int) -> int:
    """An unsigned 64-bit value as Spark's signed long."""
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two longs that name a row: its id (null apart from all ids but the
    least long) and its text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(LONG_MIN)).alias("_k1"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_k2")]


def keep_rows(docs: DataFrame, keep: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` named in ``keep`` (columns _k1, _k2); of rows alike in
    id and text one stays. The drop reuses the join's partitioning."""
    k1, k2 = row_key(id_col, text_col)
    keyed = docs.select("*", k1, k2)
    out = keyed.join(keep.select("_k1", "_k2").distinct(), ["_k1", "_k2"], "left_semi")
    return out.dropDuplicates(["_k1", "_k2"]).select(*docs.columns)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``most``; a larger
    single item is a range of its own."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
