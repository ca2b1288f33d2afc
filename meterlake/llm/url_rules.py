"""URL allow and block rules by a sort-merge range join.

A rule (host, path prefix) fits its host, all subdomains, and every path that
starts with its path. The canonical key of a host and path is the host's
labels in reverse order, a zero byte, and the path; a rule is the interval of
keys that begin with its own. A url is one probe for each host suffix it has.
Rule starts, probes and rule ends are range-partitioned and sorted by key;
intervals are nested or apart, so a sweep that counts open rules knows the top
of the stack: at depth d it is the last rule that was opened at depth d.

What a range partition inherits (its depth, and the last rule opened at each
depth) is a few rows for each partition; they enter it as rows that sort first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import ascii_lower, stage

# (verdict, host, path prefix) of the registered query.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# The verdict of a url that no rule fits.
DEFAULT = "allow"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def with_host_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``host`` and ``path`` added; both empty for null or without ``://``."""
    part = lambda n: F.coalesce(F.regexp_extract(F.col(url_col), "(?s)^.*?://([^/?#]*)([^?#]*)", n), F.lit(""))
    return pages.withColumn("host", ascii_lower(part(1))).withColumn("path", part(2))


def _key(host, path):
    return F.encode(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("\0"), path), "UTF-8")


def sweep(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, hit) for each distinct url and host suffix that a rule
    fits; hit is the longest rule for that suffix. Of rules alike in host and
    path, block holds."""
    own = rules.select(ascii_lower(F.coalesce("host", F.lit(""))).alias("rh"), F.coalesce("path", F.lit("")).alias("rp"), "verdict")
    own = own.groupBy("rh", "rp").agg(F.max("verdict").alias("verdict"))
    rule = F.struct(F.length(F.concat("rh", "rp")).alias("length"), F.length("rh").alias("labels"),
                    "verdict", F.concat("rh", "rp").alias("rule"))
    key = _key(F.col("rh"), F.col("rp"))
    none = F.lit(None).cast("string")
    marks = own.select(F.explode(F.array(
        F.struct(key.alias("key"), F.lit(0).alias("kind"), F.lit(1).alias("step")),
        F.struct(F.concat(key, F.unhex(F.lit("FF"))).alias("key"), F.lit(2).alias("kind"), F.lit(-1).alias("step")))).alias("m"),
        rule.alias("hit")).select("m.key", "m.kind", none.alias("host"), none.alias("path"), "m.step",
                                  F.when(F.col("m.kind") == 0, F.col("hit")).alias("hit"))
    # a host suffix of more labels than any rule's host has cannot be one
    deepest = own.agg(F.max(F.size(F.split("rh", r"\.", -1)))).first()[0] or 1
    labels = F.split("host", r"\.", -1)
    tail = urls.select("host", "path", F.slice(labels, F.greatest(F.size(labels) - (deepest - 1), F.lit(1)), deepest).alias("tail"))
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size("tail")),
                                   lambda i: F.array_join(F.slice("tail", i, F.size("tail")), ".")))
    probes = tail.select("host", "path", suffix.alias("suffix")).select(
        _key(F.col("suffix"), F.col("path")).alias("key"), F.lit(1).alias("kind"), "host", "path", F.lit(0).alias("step"),
        F.lit(None).cast(marks.schema["hit"].dataType).alias("hit"))
    order = ["key", "kind", "host"]
    # written, for its ranges come from a sample and must be the same for every later read
    events = stage(marks.union(probes).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "events")
    so_far = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    start = F.lit(b"").alias("key")
    inherited = events.groupBy("part").agg(F.sum("step").alias("s")).select(
        start, F.lit(-1).alias("kind"), none.alias("host"), none.alias("path"),
        F.coalesce(F.sum("s").over(earlier), F.lit(0)).cast("int").alias("step"),
        F.lit(None).cast(marks.schema["hit"].dataType).alias("hit"), "part")
    deep = events.unionByName(inherited).withColumn("depth", F.sum("step").over(so_far)).filter("kind in (0, 1)")
    opened = deep.groupBy("part", "depth").agg(F.max(F.when(F.col("kind") == 0, F.struct("key", "hit"))).alias("last"))
    before = Window.partitionBy("depth").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    handed = opened.select(start, F.lit(-1).alias("kind"), none.alias("host"), none.alias("path"), F.lit(0).alias("step"),
                           F.last("last.hit", ignorenulls=True).over(before).alias("hit"), "part", "depth")
    level = Window.partitionBy("part", "depth").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    top = deep.unionByName(handed.withColumn("depth", F.col("depth").cast("long"))).withColumn(
        "hit", F.last("hit", ignorenulls=True).over(level))
    return top.filter("kind = 1 and depth > 0").select("host", "path", "hit")


def judge(pages: DataFrame, rules: DataFrame, columns: list[str], url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``columns``, host, path, rule and verdict of every row. The longest
    fitting rule (host and path together) wins, then that with the longer
    host, then block; without one, rule is null and the verdict ``default``.
    Urls are judged once each, however often they occur."""
    rows = with_host_path(pages.select(*columns, F.col(url_col).alias("_url")), "_url").drop("_url")
    urls = rows.select("host", "path").distinct()
    best = sweep(urls, rules).groupBy("host", "path").agg(F.max("hit").alias("hit"))
    return rows.join(best, ["host", "path"], "left").select(
        *columns, "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
