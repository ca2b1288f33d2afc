"""Lines that many documents share, dropped from all documents but one.

A line's key is the line stripped of white space (U+0020, U+0009..U+000D) with
A-Z lower-cased. Keys of at least ``MIN_CHARS`` code points are counted by the
documents that hold them (128 bits of hash, summed per task before the
shuffle). The hashes of the keys that reach ``MIN_DOCS`` are dealt to shards,
and each shard becomes one minimal perfect hash: key i of n gets a place of its
own in 0..n-1, where three arrays keep a fingerprint (64 bits beside the 64
that choose the place), the document count and the document that keeps the
line. Documents send the distinct hashes of their lines to the shards and probe
the arrays; lines themselves never move. A shard that is asked more often than
``PROBES`` times, because a line in it stands in very many documents, is copied
and its askers are dealt over the copies, so no task grows with a hot line.
The hits go back to their documents.

Every row is one document. A null or empty text is one empty line. A null id
counts as the least; where the largest id is on several rows, or no row has an
id, all rows with it keep the line. Rows alike in id and text are judged alike.
A line that a document repeats is dropped, or kept, each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from meterlake.llm.common import ASCII_LOWER, ASCII_UPPER, SPACES, ascii_lower, row_key, slices, stage
from meterlake.session import observed

MIN_CHARS, MIN_DOCS = 40, 5
# Keys of a shard on average (24 bytes each), and questions that one copy of a shard answers on average.
SHARD_KEYS, PROBES = 50_000, 50_000
# Bytes of text that a task takes apart at a time.
SLICE_BYTES = 16 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


class MinimalPerfectHash:
    """Levels of bits: a key whose place on a level is its alone sets the bit
    there, the others go on to the next. A key's number is the count of set
    bits before its own."""

    ROOM = 2.0  # bits per key on a level

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.before = np.concatenate([[0], np.cumsum(bits)])

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (keys ^ (keys >> np.uint64(31))) * (_MIX + np.uint64(2 * level))
            h = (h ^ (h >> np.uint64(29))) * _MIX
        return ((h ^ (h >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        """``keys``: distinct unsigned 64-bit integers."""
        sizes, levels, left = [], [], keys
        while len(left):
            size = max(64, int(cls.ROOM * len(left)))
            at = cls._place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, dtype=bool))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The number of every key; some number or -1 for any other key."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = start + self._place(keys[open_], level, size)
            hit = self.bits[at]
            out[open_[hit]] = self.before[at[hit]]
            open_, start = open_[~hit], start + size
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes], dtype="<i8")
        return head.tobytes() + np.packbits(self.bits).tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> MinimalPerfectHash:
        n = int(np.frombuffer(data[:8], dtype="<i8")[0])
        sizes = [int(x) for x in np.frombuffer(data[8:8 + 8 * n], dtype="<i8")]
        bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8, offset=8 + 8 * n))[:sum(sizes)]
        return cls(sizes, bits.astype(bool))


# ------------------------------------------------------------------- line keys
def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(_k1, _k2, h1, h2): the distinct long keys of every document."""
    keys = F.transform(_lines(F.col(text_col)), lambda x: ascii_lower(F.btrim(x, F.lit(SPACES))))
    keys = F.array_distinct(F.filter(keys, lambda x: F.length(x) >= min_chars))
    k = docs.select(*row_key(id_col, text_col), F.explode(keys).alias("key"))
    h1 = F.xxhash64("key")
    # xxhash64 of two columns hashes the second with the first one's hash as its seed
    return k.select("_k1", "_k2", h1.alias("h1"), F.xxhash64("key", "key").alias("h2"))


def _key_hashes(line: str, min_chars: int) -> tuple[int, int] | None:
    """The same two hashes in Python, signed; None: too short to be dropped."""
    key = line.strip(SPACES)
    if len(key) < min_chars:
        return None
    data = key.translate(_LOWER).encode()
    h1 = xxhash.xxh64_intdigest(data, 42)
    h2 = xxhash.xxh64_intdigest(data, h1)
    return h1 - (h1 >> 63 << 64), h2 - (h2 >> 63 << 64)


_LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)


# ---------------------------------------------------------------- sharded index
def count_lines(keys: DataFrame) -> DataFrame:
    """(h1, h2, docs, keeper): how many documents hold a key, and the largest
    id among them."""
    return keys.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("_k1").alias("keeper"))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("h1"), F.lit(shards)).cast("int")


def build_index(counts: DataFrame, shards: int) -> DataFrame:
    """(shard, hash, prints, docs, keepers): one row per shard that has keys."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        # two keys may share the 64 bits that choose the place; their order then tells them apart
        pdf = pdf.sort_values(["h1", "h2"])
        h1 = pdf["h1"].to_numpy().view(np.uint64)
        own = np.r_[True, h1[1:] != h1[:-1]]
        mph = MinimalPerfectHash.build(h1[own])
        at = mph.index(h1[own])
        order = np.empty(len(at), dtype=np.int64)
        order[at] = np.flatnonzero(own)
        first, more = pdf.iloc[order], pdf[~own]
        arrays = [np.concatenate([first[c].to_numpy(), more[c].to_numpy()]).astype("<i8") for c in ("h2", "docs", "keeper")]
        clash = more["h1"].to_numpy().astype("<i8")
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "hash": [mph.to_bytes()], "prints": [arrays[0].tobytes()],
                             "docs": [arrays[1].tobytes()], "keepers": [arrays[2].tobytes()], "clash": [clash.tobytes()]})

    return counts.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(
        build, "shard int, hash binary, prints binary, docs binary, keepers binary, clash binary")


def probe(index: pd.DataFrame, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, keeper) of each asked key; 0 documents: not in the shard."""
    row = index.iloc[0]
    mph = MinimalPerfectHash.from_bytes(row["hash"])
    prints, docs, keepers, clash = (np.frombuffer(row[c], dtype="<i8") for c in ("prints", "docs", "keepers", "clash"))
    at = mph.index(h1.view(np.uint64))
    same = (at >= 0) & (prints[at] == h2)
    n, keeper = np.where(same, docs[at], 0), np.where(same, keepers[at], 0)
    for i, c in enumerate(clash):  # keys behind another of the same first 64 bits: practically none
        j = len(prints) - len(clash) + i
        hit = (h1 == c) & (prints[j] == h2)
        n, keeper = np.where(hit, docs[j], n), np.where(hit, keepers[j], keeper)
    return n, keeper


def drops(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = MIN_CHARS,
          min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS, probes: int = PROBES) -> DataFrame:
    """(_k1, _k2, gone): for every document that loses lines the hashes of
    their keys, array<struct<h1, h2>>."""
    keys = line_keys(docs, id_col, text_col, min_chars)
    asked = Observation("asked")
    often = stage(count_lines(keys).observe(asked, F.sum("docs").alias("n")).filter(F.col("docs") >= min_docs), "line_counts")
    total = int(observed(asked).get("n") or 0)
    own = often.agg(F.count("*").alias("keys"), F.sum("docs").alias("n")).first()
    shards = max(1, -(-own["keys"] // shard_keys))
    index = stage(build_index(often, shards), "line_index")
    # questions a shard is asked: those for its own keys, and an even share of all others
    other = (total - int(own["n"] or 0)) / shards
    copies = F.greatest(F.lit(1), F.ceil((F.sum("docs") + F.lit(other)) / F.lit(probes))).cast("int")
    load = often.groupBy(_shard(shards).alias("shard")).agg(copies.alias("copies"))
    spread = index.join(load, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))

    def ask(new: pd.DataFrame, own_: pd.DataFrame) -> pd.DataFrame:
        if not len(new) or not len(own_):
            return new[["_k1", "_k2", "h1", "h2"]].iloc[:0]
        n, keeper = probe(own_, new["h1"].to_numpy(), new["h2"].to_numpy())
        return new.loc[(n >= min_docs) & (keeper != new["_k1"].to_numpy()), ["_k1", "_k2", "h1", "h2"]]

    # two integers per shard_keys frequent keys: bounded, so it is broadcast
    asks = keys.withColumn("shard", _shard(shards)).join(F.broadcast(load), "shard")
    # any copy answers alike; dealing by row number also spreads rows that repeat
    asks = asks.withColumn("copy", F.pmod(F.monotonically_increasing_id(), F.col("copies")).cast("int"))
    hits = asks.select("shard", "copy", "_k1", "_k2", "h1", "h2").groupBy("shard", "copy").cogroup(
        spread.select("shard", "copy", "hash", "prints", "docs", "keepers", "clash").groupBy("shard", "copy")).applyInPandas(
        ask, "_k1 long, _k2 long, h1 long, h2 long")
    return hits.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("h1", "h2")).alias("gone"))


def strip_lines(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, n_lines, n_dropped, kept): every document without the lines of its
    ``gone`` keys."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column("size").to_pylist(), SLICE_BYTES):
                s = b.slice(lo, hi - lo)
                kept, before, dropped = [], [], []
                for text, g in zip(s.column("text").to_pylist(), s.column("gone").to_pylist()):
                    lines = text.split("\n")
                    if g:
                        out = {(x["h1"], x["h2"]) for x in g}
                        rest = [x for x in lines if _key_hashes(x, min_chars) not in out]
                    else:
                        rest = lines
                    kept.append("\n".join(rest))
                    before.append(len(lines))
                    dropped.append(len(lines) - len(rest))
                yield pa.RecordBatch.from_arrays([s.column("id"), pa.array(before, pa.int64()), pa.array(dropped, pa.int64()),
                                                  pa.array(kept, pa.string())], ["id", "n_lines", "n_dropped", "kept"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), text.alias("text"), *row_key(id_col, text_col))
    d = d.join(gone, ["_k1", "_k2"], "left").select("id", "text", F.octet_length("text").alias("size"), "gone")
    kind = docs.schema[id_col].dataType.simpleString()
    return d.mapInArrow(cut, f"id {kind}, n_lines long, n_dropped long, kept string")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """(id, n_lines, n_dropped, kept) for every row of ``docs``."""
    gone = stage(drops(docs, id_col, text_col, **params), "dropped_lines")
    return strip_lines(docs, gone, id_col, text_col, min_chars=params.get("min_chars", MIN_CHARS))
