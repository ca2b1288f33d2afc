"""Mixing sources to target weights by Poisson replication.

A document of source s is repeated N times, N Poisson with mean rate(s) =
weight(s) * target size / size(s), found by inverting the distribution at a
number in [0, 1) that a seeded hash of the document's id gives; so a document
gets its count without any state, and again after a lost executor. Copies are
exploded and shuffled globally by a second hash.

The size of a document is its code points plus one, so no source has size 0.
Sources compare as they are; null is a source of its own. A null text counts
as empty, rows alike in id get the same count, a null id is replaced by its
text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import stage

SEED = 20240
# Without given weights a source weighs its size to this power.
TEMPER = 0.5
# Mean repetitions over the whole corpus (by size).
EPOCHS = 1.0
# Rows of the table of distributions that may be broadcast (about 10 MB).
BROADCAST_ROWS = 200_000


def unit(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from a seeded MD5 of the parts."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(docs: DataFrame, source_col: str = "source", text_col: str = "text",
          weights: dict[str, float] | None = None, temper: float = TEMPER, epochs: float = EPOCHS) -> DataFrame:
    """(source, docs, size, weight, rate). With ``weights`` given, sources
    without one get rate 0."""
    size = F.length(F.coalesce(F.col(text_col), F.lit(""))) + 1
    per = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.count("*").alias("docs"), F.sum(size).cast("double").alias("size"))
    if weights is None:
        raw = F.pow("size", F.lit(temper))
    else:
        given = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        raw = F.coalesce(F.try_element_at(given, F.coalesce("source", F.lit(""))), F.lit(0.0))
    per = stage(per.withColumn("raw", raw), "sources")
    total = per.agg(F.sum("raw").alias("raw"), F.sum("size").alias("size")).first()
    if not total["raw"]:
        return per.select("source", "docs", "size", F.lit(0.0).alias("weight"), F.lit(0.0).alias("rate"))
    weight = F.col("raw") / F.lit(total["raw"])
    return per.select("source", "docs", "size", weight.alias("weight"),
                      (weight * F.lit(total["size"] * epochs) / F.col("size")).alias("rate"))


def distributions(per_source: DataFrame) -> DataFrame:
    """(source, cdf): P(N <= k) for k = 0, 1, .. to where it is 1 in doubles."""
    rated = per_source.filter("rate > 0")
    ks = rated.select("source", "rate", F.explode(F.expr(
        "sequence(0L, cast(ceil(rate + 12 * sqrt(rate) + 40) as long))")).alias("k"))
    so_far = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    log_factorial = F.sum(F.log(F.greatest(F.col("k"), F.lit(1)).cast("double"))).over(so_far)
    p = F.exp(F.col("k") * F.log("rate") - F.col("rate") - log_factorial)
    cdf = ks.select("source", "k", p.alias("p")).select("source", "k", F.sum("p").over(so_far).alias("c"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda x: x["c"])
    return cdf.groupBy("source").agg(listed.alias("cdf"))


def mix(docs: DataFrame, columns: list[str], id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", seed: int = SEED, **params) -> DataFrame:
    """``columns`` of every copy and ``copy`` (from 1), in a global random
    order: rows go to partitions by a hash and are sorted by it inside. The
    docs are joined with their source's distribution by broadcast where that
    table is counted to be small, else by a join that splits a hot source."""
    per = stage(distributions(rates(docs, source_col, text_col, **params)), "distributions")
    rows = per.agg(F.sum(F.size("cdf"))).first()[0] or 0
    if rows <= BROADCAST_ROWS:
        per = F.broadcast(per)
    own = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.coalesce(F.col(text_col), F.lit(""))))
    d = docs.select(*columns, F.col(source_col).alias("_s"), F.md5(own).alias("_own"),
                    unit(seed, own).alias("_u"))
    j = d.join(per, d["_s"].eqNullSafe(per["source"])).withColumn("_n", F.expr("size(filter(cdf, c -> c <= _u))"))
    out = j.filter("_n > 0").select(*[d[c] for c in columns], "_own", F.explode(F.expr("sequence(1L, cast(_n as long))")).alias("copy"))
    out = out.withColumn("_order", F.xxhash64(F.lit(seed), "_own", "copy"))
    return out.repartition("_order").sortWithinPartitions("_order").select(*columns, "copy")
