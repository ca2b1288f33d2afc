"""Published versions of the layers that readers see (silver, gold).

Every write of a layer goes to a folder of its own,
``<layer>/v=<number>-<token>/hall_id=<h>/``, and is seen by nobody until it is
published. ``versions/`` holds one row per publication: its number and, for
every layer and hall, the folder that holds the hall's rows. Readers take the
row with the greatest number, so a publication is one appended row: a reader
sees all of it or none of it, and a write that fails half-way leaves what was
published before whole. A publication may replace some halls only; the folders
of all other halls are named again and their files are not touched.

The list of halls is part of every publication (a row per hall and layer, some
hundred bytes each). One writer publishes at a time, as the layers have one
pipeline.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUBLISHED = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("published_at", T.TimestampNTZType(), False),
    T.StructField("entries", T.ArrayType(T.StructType([
        T.StructField("layer", T.StringType()), T.StructField("hall", T.StringType()),
        T.StructField("folder", T.StringType())])), False),
])

# Fixed values of partition folder names: the folder of null and empty values,
# and the characters that are written as % and two hex digits.
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")


def partition_folder(column: str, value: str | None) -> str:
    """The folder that Spark writes a partition value to."""
    text = ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else DEFAULT_PARTITION
    return f"{column}={text}"


@dataclass(frozen=True)
class Published:
    """What readers see: layer -> hall folder -> version folder."""
    version: int = 0
    entries: dict = field(default_factory=dict)

    def halls(self, layer: str) -> dict:
        return self.entries.get(layer, {})


def _path(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def published(spark: SparkSession, root: str) -> Published:
    """The last publication under ``root`` (version 0: nothing yet)."""
    from .lake import layer_exists
    if not layer_exists(spark, root, "versions"):
        return Published()
    rows = spark.read.schema(PUBLISHED).parquet(_path(root, "versions"))
    last = rows.orderBy(F.desc("version"), F.desc("published_at")).limit(1).collect()
    if not last:
        return Published()
    entries: dict = {}
    for e in last[0]["entries"]:
        entries.setdefault(e["layer"], {})[e["hall"]] = e["folder"]
    return Published(last[0]["version"], entries)


def new_folder(now: Published) -> str:
    """A version folder name that no write has used."""
    return f"v={now.version + 1:08d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, root: str, now: Published, changes: dict, halls: list | None = None) -> int:
    """Make written folders visible on top of ``now``. ``changes``: layer ->
    (version folder, hall values written to it). With ``halls`` these halls are
    replaced (those without rows disappear), otherwise the whole layer. Returns
    the number."""
    entries = {layer: dict(own) for layer, own in now.entries.items()}
    for layer, (folder, written) in changes.items():
        own = {} if halls is None else entries.get(layer, {})
        for h in halls or []:
            own.pop(partition_folder("hall_id", h), None)
        own.update({partition_folder("hall_id", h): folder for h in written})
        entries[layer] = own
    flat = [(layer, hall, folder) for layer, own in sorted(entries.items()) for hall, folder in sorted(own.items())]
    row = [(now.version + 1, _dt.datetime.now(), flat)]
    spark.createDataFrame(row, PUBLISHED).coalesce(1).write.mode("append").parquet(_path(root, "versions"))
    return now.version + 1


def read(spark: SparkSession, root: str, layer: str, schema: T.StructType, halls: list | None = None,
         state: Published | None = None) -> DataFrame:
    """A published layer with exactly ``schema``; with ``halls`` only their
    folders are listed."""
    own = (state or published(spark, root)).halls(layer)
    if halls is not None:
        wanted = {partition_folder("hall_id", h) for h in halls}
        own = {h: f for h, f in own.items() if h in wanted}
    if not own:
        return spark.createDataFrame([], schema)
    return read_folders(spark, _path(root, layer), [f"{folder}/{hall}" for hall, folder in sorted(own.items())], schema)


def read_folders(spark: SparkSession, base: str, folders: list[str], schema: T.StructType) -> DataFrame:
    df = (spark.read.schema(schema).option("basePath", base)
          .parquet(*[f"{base}/{f}" for f in folders]))
    return df.select(*[f.name for f in schema.fields])


def drop_unpublished(spark: SparkSession, root: str, layers: list[str], keep: int = 2) -> list[str]:
    """Delete the version folders that none of the last ``keep`` publications
    names (superseded ones, and those of writes that failed). Run it when no
    write and no reader of an older publication is under way."""
    rows = spark.read.schema(PUBLISHED).parquet(_path(root, "versions"))
    named = {(e["layer"], e["folder"]) for r in rows.orderBy(F.desc("version")).limit(keep).collect() for e in r["entries"]}
    jvm = spark.sparkContext._jvm
    gone = []
    for layer in layers:
        p = jvm.org.apache.hadoop.fs.Path(_path(root, layer))
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            continue
        for s in fs.listStatus(p):
            folder = s.getPath().getName()
            if folder.startswith("v=") and (layer, folder) not in named:
                fs.delete(s.getPath(), True)
                gone.append(f"{layer}/{folder}")
    return gone


__all__ = ["PUBLISHED", "Published", "partition_folder", "published", "new_folder", "publish", "read", "read_folders",
           "drop_unpublished"]
