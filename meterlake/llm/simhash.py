"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within ``k`` bits share a variant that lies within half the
radius of either: every fingerprint emits all its variants at up to
floor(k/2) flipped bits. For an odd ``k`` the two halves differ by one, and
two fingerprints at an odd distance differ in parity, so those of odd parity
emit up to ceil(k/2) flips. The variants are shuffled; all fingerprints on one
variant are linked to the least one that lies within floor(k/2) of it, which
by the triangle inequality is within ``k`` bits of each (and is checked).
A variant therefore gives a star, never all pairs, and the fingerprints that
can meet on it are bounded by the size of a ball.

For an odd ``k`` a sieve comes first, which keeps the larger half-ball from
fingerprints that have no neighbour: with one quarter of the bits masked out,
the odd bit is absorbed by some mask, so floor(k/2) flips on either side must
meet. Fingerprints that meet no other under any mask have no link.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import row_key, signed, slices, stage
from meterlake.llm.components import components

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
MASK_BLOCKS = 4
_SLICE_BYTES = 2 << 20


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> list[int]:
    """XXH64 of each shingle, repeats included; ``bytes.lower`` changes A-Z
    only and ``bytes.split`` cuts at exactly U+0020 and U+0009..U+000D."""
    w = text.lower().split()
    if not w:
        return []
    h = xxhash.xxh64_intdigest
    if len(w) < words:
        return [h(b" ".join(w), seed)]
    return [h(s, seed) for s in map(b" ".join, zip(*(w[i:] for i in range(words))))]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint per run of ``counts`` hashes (0 for an empty run)."""
    out = np.zeros(len(counts), dtype=np.uint64)
    some = counts > 0
    if not some.any():
        return out
    n = counts[some]
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    major = np.packbits(2 * ones > n[:, None], axis=1)
    out[some] = np.ascontiguousarray(major).view(">u8").ravel().astype(np.uint64)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(_k1, _k2, id, fp) per row; fp is the 64-bit fingerprint as a signed
    long. A null text counts as empty; no word gives fingerprint 0."""

    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            fps = np.zeros(len(texts), dtype=np.uint64)
            for lo, hi in slices([len(t) for t in texts], _SLICE_BYTES):
                per = [shingle_hashes(t, words, seed) for t in texts[lo:hi]]
                counts = np.array([len(p) for p in per], dtype=np.int64)
                flat = np.fromiter((x for p in per for x in p), dtype=np.uint64, count=int(counts.sum()))
                fps[lo:hi] = majority(flat, counts)
            yield pa.RecordBatch.from_arrays(
                [b.column("_k1"), b.column("_k2"), b.column("id"), pa.array(fps.view(np.int64))],
                names=["_k1", "_k2", "id", "fp"])

    rows = docs.select(*row_key(id_col, text_col), F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "_k1 long, _k2 long, id long, fp long")


def _flips(bits: list[int], most: int) -> list[int]:
    return [sum(1 << b for b in c) for r in range(most + 1) for c in combinations(bits, r)]


def _sieve(fps: DataFrame, k: int) -> DataFrame:
    """Fingerprints that meet another one under some mask (odd ``k``)."""
    half, width = k // 2, BITS // MASK_BLOCKS
    variants = []
    for j in range(MASK_BLOCKS):
        block = ((1 << width) - 1) << (j * width)
        rest = [b for b in range(BITS) if not block >> b & 1]
        tag = (j + 1) << (j * width)  # the masked bits tell the mask
        variants += [(signed(~block), signed(f ^ tag)) for f in _flips(rest, half)]
    pairs = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(x).cast("long").alias("x"))
                      for m, x in variants])
    emitted = fps.select("fp", F.explode(pairs).alias("v")).select(
        "fp", F.col("fp").bitwiseAND(F.col("v.m")).bitwiseXOR(F.col("v.x")).alias("key"))
    w = Window.partitionBy("key")
    met = emitted.select("fp", F.min("fp").over(w).alias("lo"), F.max("fp").over(w).alias("hi"))
    return met.filter("lo < hi").select("fp").distinct()


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(u, v) star links between distinct fingerprints (column fp): every two
    within ``max_distance`` bits are joined by a path of links, and every link
    is within ``max_distance`` bits."""
    half, k = max_distance // 2, max_distance
    live = stage(_sieve(fps, k), "live") if k % 2 else fps
    near = _flips(list(range(BITS)), half)
    far = _flips(list(range(BITS)), k - half)[len(near):]
    own = [F.lit(signed(f)).cast("long") for f in near]
    balls = live.select("fp", F.explode(F.array(*own)).alias("flip"))
    if far:
        odd = live.filter(F.bit_count("fp") % 2 == 1)
        balls = balls.union(odd.select("fp", F.explode(F.array(
            *[F.lit(signed(f)).cast("long") for f in far])).alias("flip")))
    met = balls.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z"),
                       (F.bit_count("flip") <= half).alias("inner"))
    centre = F.min(F.when(F.col("inner"), F.col("fp"))).over(Window.partitionBy("z"))
    stars = met.select("fp", centre.alias("c")).filter("c is not null and c <> fp").distinct()
    return stars.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("c"))) <= k).select(
        F.col("fp").alias("u"), F.col("c").alias("v"))


def cluster(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(_k1, _k2, id, fp, root, component) per row; root names the component
    (its least fingerprint), component is its least id (null only where all
    its ids are): rows are in one component when links of at most
    ``max_distance`` bits join their fingerprints.

    Rows with one fingerprint are grouped before any variant is made, so
    copies cost nothing beyond one row each in the last join. An empty table
    gives an empty table.
    """
    rows = stage(fingerprints(docs, id_col, text_col, words), "simhash")
    per = rows.groupBy("fp").agg(F.min("id").alias("least"))
    per = stage(per, "fingerprints")
    parts = components(links(per.select("fp"), max_distance))
    linked = parts.join(per, parts.node == per.fp).select("node", "root", "least")
    roots = linked.groupBy("root").agg(F.min("least").alias("component"))
    linked = linked.join(roots, "root").select(F.col("node").alias("fp"), "root", "component")
    of = per.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component", "least").alias("component"))
    # written, so that the join below has two plain sides and a hot fingerprint can be split
    return rows.join(stage(of, "components"), "fp").select("_k1", "_k2", "id", "fp", "root", "component")


def survivors(docs: DataFrame, **params) -> DataFrame:
    """(_k1, _k2) of the one row that stays of each component: the least id
    (nulls last), then the least text key."""
    first = F.min(F.struct(F.col("id").isNull().alias("n"), "id", "_k1", "_k2")).alias("b")
    return cluster(docs, **params).groupBy("root").agg(first).select("b._k1", "b._k2")
