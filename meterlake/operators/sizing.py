"""Broadcast behind a size check.

Static planning never broadcasts in our sessions (its estimates can be far
too small, e.g. after an ``explode``), and AQE only measures a side after
the other side's shuffle has already run. Where a join pairs a large input
(the fact, the cells) with a table whose size is bounded by a stored table
(a dimension, the column profile), ``checked_broadcast`` marks the small
side for broadcast when that stored table's rows, counted and measured
unpacked, are under the broadcast limit, so the large side is never shuffled
for the join; beyond the limit, or when the bound is itself a derived plan, the
join is left to AQE (sort-merge, measured conversion, skew splitting). File
sizes only rule a broadcast out: a repetitive table can take hundreds of times
its compressed size in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT = 32 * 1024 * 1024


def size_estimate(df: DataFrame) -> int:
    """Optimizer size statistics of ``df`` in bytes (file sizes for a stored
    table; a derived plan's estimate otherwise)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Bytes of a row in memory besides the contents of its texts, per row and per column.
ROW_BYTES, COLUMN_BYTES = 32, 16
_FIXED = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp",
          "timestamp_ntz"}


def unpacked_bytes(df: DataFrame) -> int:
    """Bytes of all rows of ``df`` in memory: fixed bytes per row and column
    plus the measured length of every other column. One row comes back."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("long")
             for c, kind in df.dtypes if kind not in _FIXED]
    own = sum(texts, F.lit(ROW_BYTES + COLUMN_BYTES * len(df.columns)).cast("long"))
    return int(df.agg(F.sum(own)).first()[0] or 0)


def broadcast_limit(df: DataFrame) -> int:
    v = df.sparkSession.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    try:
        n = int(v) if v else -1
    except ValueError:
        n = -1
    return n if n > 0 else DEFAULT_LIMIT


# Logical nodes of a plan that only reads stored files (names as Spark
# prints them): its size statistics come from the files.
_STORED_NODES = {"Relation", "LogicalRelation", "Project", "Filter", "SubqueryAlias", "Sort",
                 "ResolvedHint"}


def is_stored(df: DataFrame) -> bool:
    """True when ``df`` is a stored table read with projections, filters and
    sorts only (cheap to size: no derived plan is optimized)."""
    def ok(p) -> bool:
        if p.nodeName() not in _STORED_NODES:
            return False
        ch = p.children()
        return all(ok(ch.apply(i)) for i in range(ch.size()))
    return ok(df._jdf.queryExecution().analyzed())


def checked_broadcast(df: DataFrame, bound: DataFrame | None = None,
                      row_factor: int = 1) -> DataFrame:
    """``df`` marked for broadcast when ``bound`` (a stored table with at
    least as many rows as ``df``; ``df`` itself by default) is under the
    broadcast limit after ``row_factor`` x its unpacked size; ``df`` unchanged
    otherwise, and always when ``bound`` is a derived plan (its size is not
    known until AQE measures it)."""
    b = df if bound is None else bound
    if not is_stored(b):
        return df
    limit = broadcast_limit(df)
    if size_estimate(b) > limit or unpacked_bytes(b) * max(1, int(row_factor)) > limit:
        return df
    return F.broadcast(df)
