"""Threshold-scaled document fingerprints.

Of all hashes of five-word shingles, those below a fixed fraction of the range
are kept, so sketches of documents of any length share one threshold, and
containment of a short text in a very long one is estimated from the kept
hashes alone. A text with shingles of which none is below keeps its least hash,
so that its fingerprint is not empty. That hash lies above the threshold, which
marks such a sketch: nothing is estimated from it, values of the pair come from
the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import LONG_MIN, ascii_lower, stage

WORDS = 5
# One hash in so many is kept.
SCALE = 8
# Bytes of text in a range of ids, and the number of ranges beyond which they grow.
RANGE_BYTES = 16 << 20
MOST_RANGES = 200_000


def with_hashes(df: DataFrame, text: Column, out: str, words: int = WORDS) -> DataFrame:
    """``out``: hashes of all shingles of ``text`` (lower-cased A-Z; fewer
    words: the whole sequence; none: empty)."""
    w = f"_{out}_w"
    cut = F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    df = df.withColumn(w, cut)
    items = ", ".join(f"`{w}`[i + {k}]" for k in range(words))
    return df.withColumn(out, F.expr(
        f"case when size(`{w}`) >= {words} then transform(sequence(0, size(`{w}`) - {words}), i -> xxhash64({items})) "
        f"when size(`{w}`) > 0 then array(xxhash64(array_join(`{w}`, ' '))) else cast(array() as array<bigint>) end")).drop(w)


def threshold(scale: int = SCALE) -> int:
    return LONG_MIN + (1 << 64) // scale


def with_sketch(df: DataFrame, text: str, out: str, words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """``out``: sorted distinct kept hashes of the shingles of column ``text``
    (empty without words)."""
    h = f"_{out}_h"
    df = with_hashes(df, F.col(text), h, words)
    kept = F.expr(f"array_sort(array_distinct(filter(`{h}`, h -> h < {threshold(scale)})))")
    least = F.when(F.size(h) > 0, F.array(F.array_min(h))).otherwise(F.col(h))
    df = df.withColumn(out, kept)
    return df.withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(least)).drop(h)


def fell_back(a: str, scale: int = SCALE) -> Column:
    """Whether a sketch holds a least hash above the threshold only."""
    return F.coalesce(F.get(F.col(a), F.lit(0)) >= F.lit(threshold(scale)), F.lit(False))


def _jaccard(a: str, b: str) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def _part(a: str, b: str) -> Column:
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_distinct(a)))


def likeness(a: str, b: str, scale: int = SCALE) -> Column:
    """Estimated Jaccard similarity of two sketches; 1 if neither text has
    words, 0 if one has none. Null where a side fell back otherwise."""
    unknown = (fell_back(a, scale) & (F.size(b) > 0)) | (fell_back(b, scale) & (F.size(a) > 0))
    return F.when(~unknown, _jaccard(a, b))


def containment(a: str, b: str, scale: int = SCALE) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; 1 if ``a`` has none,
    0 if only ``b`` has none. Null where a side fell back otherwise."""
    unknown = (fell_back(a, scale) & (F.size(b) > 0)) | (fell_back(b, scale) & (F.size(a) > 0))
    return F.when(~unknown, _part(a, b))


def union(a: str, b: str, scale: int = SCALE) -> Column:
    """The sketch of the shingles of both sides."""
    both = F.array_sort(F.array_union(a, b))
    return F.when(F.get(both, F.lit(0)) < F.lit(threshold(scale)), F.filter(both, lambda h: h < F.lit(threshold(scale)))) \
        .otherwise(F.slice(both, 1, 1))


def _with_value(df: DataFrame, estimate, exact, out: str, a: str, sketch_a: str, b: str, sketch_b: str,
                words: int, scale: int) -> DataFrame:
    value, open_, ha, hb = f"_{out}_e", f"_{out}_o", f"_{out}_a", f"_{out}_b"
    df = df.withColumn(value, estimate(sketch_a, sketch_b, scale)).withColumn(open_, F.col(value).isNull())
    # texts are hashed in full in such rows only
    df = with_hashes(df, F.when(F.col(open_), F.col(a)), ha, words)
    df = with_hashes(df, F.when(F.col(open_), F.col(b)), hb, words)
    return df.withColumn(out, F.when(F.col(open_), exact(ha, hb)).otherwise(F.col(value))).drop(value, open_, ha, hb)


def with_likeness(df: DataFrame, out: str, a: str, sketch_a: str, b: str, sketch_b: str,
                  words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """``out``: ``likeness`` of two sketches, or where that is null the Jaccard
    similarity of all shingles of the texts ``a`` and ``b``."""
    return _with_value(df, likeness, _jaccard, out, a, sketch_a, b, sketch_b, words, scale)


def with_containment(df: DataFrame, out: str, a: str, sketch_a: str, b: str, sketch_b: str,
                     words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """``out``: ``containment`` of two sketches, or where that is null the share
    of all shingles of text ``a`` that text ``b`` has."""
    return _with_value(df, containment, _part, out, a, sketch_a, b, sketch_b, words, scale)


def as_text(a: str) -> Column:
    """16 hex digits for each kept hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def range_ends(rows: DataFrame, range_bytes: int = RANGE_BYTES, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Upper ends (id, place), ascending, that cut ``rows`` (id, text) with an
    id into ranges of about ``range_bytes`` of text.

    Texts of an id are weighed once per text, so what is sorted holds three
    numbers a row and copies are added up before. A range is larger only by its
    last text and that text's copies. Ends reach the driver: about ``most`` of
    them, beyond which ranges grow with the corpus, and one per sorted partition.
    """
    keyed = rows.filter("id is not null").select("id", _place("text").alias("place"), F.octet_length("text").alias("n"))
    keys = stage(keyed.groupBy("id", "place").agg(F.sum("n").alias("n")), "sketch_keys")
    total = keys.agg(F.sum("n").alias("n")).first()["n"] or 0
    each = max(range_bytes, total // most)
    ordered = keys.repartitionByRange("id", "place").withColumn("part", F.spark_partition_id())
    w = Window.partitionBy("part").orderBy("id", "place")
    upto = ordered.withColumn("upto", F.sum("n").over(w)).withColumn("last", F.lead("id").over(w).isNull())
    cut = F.floor(F.col("upto") / each) > F.floor((F.col("upto") - F.col("n")) / each)
    return sorted((r["id"], r["place"]) for r in upto.filter(cut | F.col("last")).select("id", "place").collect())


def _place(text: str) -> Column:
    """Order of the rows of one id: descending by their text's hash."""
    return F.bitwise_not(F.xxhash64(text))


def _arrays(ends: list[tuple[int, int]]) -> tuple[Column, Column]:
    """Ids and places of ``ends``, one literal each, however many."""
    ids, places = zip(*ends)
    return tuple(F.split(F.lit(",".join(map(str, c))), ",").cast("array<bigint>") for c in (ids, places))


def _below(ends: list[tuple[int, int]]) -> Column:
    """How many of ``ends`` lie below a row's (id, place), by bisection."""
    ids, places = _arrays(ends)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(ends).bit_length()))])

    def step(at: Column, s: Column) -> Column:
        i, place = F.get(ids, at + s - 1), F.get(places, at + s - 1)
        below = (i < F.col("id")) | ((i == F.col("id")) & (place < F.col("place")))
        return F.when((at + s <= len(ends)) & below, at + s).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def chained(docs: DataFrame, id_col: str, text_col: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(id, text, sketch, next_text, next_sketch) per row, next being the row
    with the next smaller id, after the smallest that with the largest.

    Rows are cut into ranges by bytes of text (``range_ends``), a task each, so
    tasks do not grow with the corpus. A range is one window; the rows at its
    upper end go to the range above as well, where they follow its smallest.
    Each text is shuffled once. Rows of one id follow each other by their
    text's hash and are cut into ranges like others; copies of one text under
    one id stay in one range. A null id has no place in the order: its next
    text is empty, and it is not shuffled.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # a table without ids has one range, which is empty
    ends = range_ends(rows, range_bytes) or [(0, 0)]
    n = len(ends)
    placed = rows.filter("id is not null").withColumn("place", _place("text")).withColumn("part", _below(ends))
    ids, places = _arrays(ends)
    at_end = (F.get(ids, F.col("part")) == F.col("id")) & (F.get(places, F.col("part")) == F.col("place"))
    home = F.struct(F.col("part"), F.lit(False).alias("guest"))
    above = F.struct(F.pmod(F.col("part") + 1, F.lit(n)).alias("part"), F.lit(True).alias("guest"))
    dealt = placed.select("id", "text", "place", F.explode(F.when(at_end, F.array(home, above)).otherwise(F.array(home))).alias("p"))
    dealt = dealt.select("id", "text", "place", "p.part", "p.guest").repartitionById(n, F.col("part"))
    dealt = with_sketch(dealt, "text", "sketch")
    w = Window.partitionBy("part").orderBy("guest", F.col("id").desc(), F.col("place").desc())
    none = F.expr("cast(array() as array<bigint>)")
    chain = dealt.select("id", "text", "sketch", "guest", F.lead("text").over(w).alias("next_text"),
                         F.lead("sketch").over(w).alias("next_sketch")).filter("not guest").drop("guest")
    alone = with_sketch(rows.filter("id is null"), "text", "sketch").select(
        "id", "text", "sketch", F.lit("").alias("next_text"), none.alias("next_sketch"))
    return chain.withColumn("next_text", F.coalesce("next_text", F.lit(""))) \
        .withColumn("next_sketch", F.coalesce("next_sketch", none)).unionByName(alone)


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the sketches of its text and of its edited text (the last half
    of the code points replaced by as many, or all, of the next text's first),
    and their likenesses (from the texts where a sketch fell back). Null counts
    as empty."""
    d = chained(docs, id_col, text_col).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    d = d.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.col("next_text"), F.lit(1), half)))
    d = d.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch", "edited", "text", "next_text")
    d = with_sketch(d, "edited", "edited_sketch")
    d = with_likeness(d, "near_edited", "text", "sketch", "edited", "edited_sketch")
    d = with_likeness(d, "near_next", "text", "sketch", "next_text", "next_sketch")
    return d.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "sketch", "edited_sketch", "near_edited", "near_next")
