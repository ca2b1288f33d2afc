"""Parquet files of drifting schemas read as one table, by column name.

Files written over time by different tools need not agree: columns come in
another order or letter case, are missing, or have another type (a ``value``
column of whole numbers is written as an integer). The footer of every file is
read once (in parallel, one short read a file), files of equal schema are
scanned together, and their columns are cast to the widest type that any file
has and matched by name; a column that a file lacks is null. Widths go from
integers over decimals to doubles, from dates to timestamps, and anything else
that disagrees becomes text; no value is lost. Folder names are not columns.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.gold import Gold
from ..operators.silver import conform
from ..schema import DIM_HALL, DIM_METER, FACT

FOOTER_THREADS = 16

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
_TIMES = [T.DateType(), T.TimestampNTZType(), T.TimestampType()]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for line in (_WHOLE, _TIMES):
        if a in line and b in line:
            return line[max(line.index(a), line.index(b))]
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if any(isinstance(x, (T.FloatType, T.DoubleType)) for x in (a, b)):
            return T.DoubleType()
        scale = max(getattr(x, "scale", 0) for x in (a, b))
        whole = max(x.precision - x.scale if isinstance(x, T.DecimalType) else _DIGITS[x.simpleString()] for x in (a, b))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    return T.StringType()


def files_by_schema(spark: SparkSession, *paths: str) -> list[tuple[T.StructType, list[str]]]:
    """Parquet files under ``paths`` (files or folders, nested ones too),
    grouped by the schema in their footer."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet").load(list(paths)))
    files = sorted(r["path"] for r in listed.select("path").collect())
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        schemas = list(pool.map(lambda f: spark.read.option("recursiveFileLookup", "true").parquet(f).schema, files))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for f, s in zip(files, schemas):
        groups.setdefault(s.json(), (s, []))[1].append(f)
    return list(groups.values())


def read_union(spark: SparkSession, *paths: str) -> DataFrame | None:
    """All files under ``paths`` as one table; None where there is no file.
    Columns are in the order in which they are first met."""
    groups = files_by_schema(spark, *paths)
    if not groups:
        return None
    types: dict[str, T.DataType] = {}
    names: dict[str, str] = {}
    for schema, _ in groups:
        for f in schema.fields:
            k = f.name.lower()
            names.setdefault(k, f.name)
            types[k] = wider(types[k], f.dataType) if k in types else f.dataType
    parts = []
    for schema, files in groups:
        own = {f.name.lower(): f.name for f in schema.fields}
        df = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*files)
        parts.append(df.select(*[(F.col(f"`{own[k]}`") if k in own else F.lit(None)).cast(t).alias(names[k])
                                 for k, t in types.items()]))
    return reduce(DataFrame.union, parts)


def read_gold_union(spark: SparkSession, fact_path: str, dim_hall_path: str, dim_meter_path: str) -> Gold:
    """Gold tables from folders of files whose schemas drifted, with the gold
    schemas. A value that is no number fails the query."""
    def rd(path: str, schema: T.StructType) -> DataFrame:
        df = read_union(spark, path)
        return spark.createDataFrame([], schema) if df is None else conform(df, schema)
    return Gold(rd(fact_path, FACT), rd(dim_hall_path, DIM_HALL), rd(dim_meter_path, DIM_METER))


__all__ = ["wider", "files_by_schema", "read_union", "read_gold_union"]
