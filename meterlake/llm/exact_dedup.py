"""Exact duplicates of texts that arrive in batches.

Each finished batch is an immutable snapshot: its distinct digests lie in
buckets of the digest, and every bucket has a static binary-fuse filter. A
new batch is first grouped by itself, one row per digest and task before the
shuffle; its distinct digests are screened by the filters of each snapshot
before it. Only positives are joined with the snapshot's exact buckets. Bytes
are compared where there is something to compare: the texts of positives and
of groups with several rows of a batch go to their digest's bucket, where the
least and the greatest normalised text must be the same text (one pair of texts
per task and digest is shuffled, however many copies there are). A digest
whose texts differ is split by text. Texts that stand alone are not moved.

Texts are equal when alike after deleting U+0020 and U+0009..U+000D. Null
counts as empty, and empty texts are equal to each other. Of equal texts the
row with the most code points stays, then that with the smallest id (null
last).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import SPACES, row_key, stage
from meterlake.llm.fuse import BinaryFuse8
from meterlake.operators.sizing import checked_broadcast

# Digests in a bucket on average; a bucket is what one task loads at a time.
BUCKET_DIGESTS = 100_000
BATCHES = 2


def normalised(text_col: str) -> Column:
    return F.translate(F.coalesce(F.col(text_col), F.lit("")), SPACES, "")


def _better() -> Column:
    """Orders rows of one text: most code points, then smallest id, null last."""
    return F.struct((-F.col("chars")).alias("fewer"), F.col("id").isNull().alias("no_id"),
                    F.col("id").alias("id"), F.col("_k1").alias("_k1"), F.col("_k2").alias("_k2"))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min(_better()).alias("best"), F.count("*").alias("size"))


def _key(col: str = "digest") -> Column:
    return F.xxhash64(col)


def build_filters(digests: DataFrame, buckets: int) -> DataFrame:
    """(bucket, filter) of a snapshot's digests."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        f = BinaryFuse8.build(pdf["key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "filter": [f.to_bytes()]})

    keyed = digests.select(_key().alias("key")).select("key", F.pmod("key", F.lit(buckets)).cast("int").alias("bucket"))
    return keyed.groupBy("bucket").applyInPandas(build, "bucket int, filter binary")


def screen(digests: DataFrame, filters: DataFrame, buckets: int, copies: int = 1) -> DataFrame:
    """The ``digests`` that a snapshot's filters cannot exclude. Where the new
    batch is larger than the snapshot, each filter is asked in ``copies``."""
    def ask(new: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(new):
            return new[["digest"]].iloc[:0]
        hit = BinaryFuse8.from_bytes(own["filter"].iloc[0]).maybe(new["key"].to_numpy().view(np.uint64))
        return new.loc[hit, ["digest"]]

    keyed = digests.select("digest", _key().alias("key")).withColumn(
        "bucket", F.pmod("key", F.lit(buckets)).cast("int")).withColumn(
        "copy", F.pmod(F.xxhash64(F.lit("copy"), "key"), F.lit(copies)).cast("int"))
    spread = filters.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return keyed.groupBy("bucket", "copy").cogroup(spread.groupBy("bucket", "copy")).applyInPandas(ask, "digest binary")


class Snapshot:
    """An immutable set of text groups with its filters, on shared storage."""

    def __init__(self, groups: DataFrame):
        self.groups = stage(groups, "snapshot")
        self.buckets = max(1, -(-self.groups.count() // BUCKET_DIGESTS))
        self.filters = stage(build_filters(self.groups.select("digest"), self.buckets), "filters")

    def matches(self, new: DataFrame) -> DataFrame:
        """Of the ``new`` groups, the digests that are in this snapshot."""
        copies = max(1, -(-new.count() // (self.buckets * BUCKET_DIGESTS)))
        positive = screen(new.select("digest"), self.filters, self.buckets, copies)
        return positive.join(self.groups.select("digest"), "digest", "left_semi")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """(_k1, _k2, id, chars, digest, batch) per row."""
    return docs.select(
        *row_key(id_col, text_col), F.col(id_col).cast("long").alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("chars"),
        F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"),
    ).withColumn("batch", F.pmod(F.xxhash64("_k1", "_k2"), F.lit(batches)).cast("int"))


def _merge(groups: DataFrame) -> DataFrame:
    return groups.groupBy("digest").agg(F.min("best").alias("best"), F.sum("size").alias("size"))


def dedup_groups(rows: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(digest, best, size) over all batches, one after the other."""
    known: list[DataFrame] = []
    snapshots: list[Snapshot] = []
    for n in range(batches):
        new = stage(_groups(rows.filter(F.col("batch") == n)), "batch")
        repeats = None
        for s in snapshots:
            m = s.matches(new)
            repeats = m if repeats is None else repeats.union(m)
        if repeats is None:
            fresh = new
        else:
            repeats = stage(repeats.distinct(), "repeats")
            fresh = new.join(repeats, "digest", "left_anti")
            known.append(new.join(repeats, "digest", "left_semi").withColumn("again", F.lit(True)))
        if n < batches - 1:
            snapshots.append(Snapshot(fresh))
            fresh = snapshots[-1].groups
        known.append(fresh.withColumn("again", F.lit(False)))
    every = known[0]
    for k in known[1:]:
        every = every.union(k)
    again = every.filter("again")
    if batches == 1:
        return every.drop("again")
    # only groups met again in a later batch are merged with their first
    met = again.select("digest").distinct()
    first = every.filter("not again")
    merged = _merge(again.drop("again").union(first.join(met, "digest", "left_semi").drop("again")))
    return merged.union(first.join(met, "digest", "left_anti").drop("again"))


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """One row per row of ``docs``: _k1, _k2, id, digest, keep (its k1, k2 and
    id), size. Rows alike in id and text are all reported."""
    rows = stage(digests(docs, id_col, text_col, batches), "digests")
    groups = stage(dedup_groups(rows, batches), "groups")
    # a digest with one row has nothing to be compared with: those with several, positives of
    # the filters among them, pick their texts. Digests of 32 bytes are broadcast below the limit.
    several = stage(groups.filter("size > 1").select("digest"), "several")
    texts = docs.select(F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"),
                        normalised(text_col).alias("text"), *row_key(id_col, text_col))
    # combined before the shuffle: no task reads the copies of a hot text
    checked = texts.join(checked_broadcast(several), "digest", "left_semi").groupBy("digest").agg(
        F.min("text").alias("lo"), F.max("text").alias("hi"))
    clash = stage(checked.filter("lo <> hi").select("digest"), "clashes")
    same = groups.select("digest", F.col("best").alias("keep"), "size")
    if clash.isEmpty():
        return rows.join(same, "digest").select("_k1", "_k2", "id", "chars", "digest", "keep", "size")
    # one digest, several texts: these groups are formed by the text itself
    split = texts.join(clash, "digest", "left_semi").join(
        rows.select("_k1", "_k2", "id", "chars").distinct(), ["_k1", "_k2"])
    own = split.groupBy("digest", "text").agg(F.min(_better()).alias("keep"), F.count("*").alias("size"))
    apart = split.join(own, ["digest", "text"]).select("_k1", "_k2", "id", "chars", "digest", "keep", "size")
    rest = rows.join(clash, "digest", "left_anti").join(same, "digest")
    return rest.select("_k1", "_k2", "id", "chars", "digest", "keep", "size").union(apart)


def survivors(docs: DataFrame, **params) -> DataFrame:
    """(_k1, _k2) of the row that stays of each group."""
    return assign(docs, **params).select("keep._k1", "keep._k2").distinct()
