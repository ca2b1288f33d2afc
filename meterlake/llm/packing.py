"""Packing tokenised documents into fixed-length sequences, shortest pack first
over the length histogram.

Documents are cut into pieces of at most ``size`` tokens (full pieces, then
the rest). The histogram of piece lengths has at most ``size`` rows whatever
the corpus, so the packing is planned on it alone: lengths are placed longest
first, each into the emptiest pack type that has room, and only the counts of
pack types change. Patterns are joined back to pieces by rank: the r-th piece
of a length takes the r-th place that the patterns hold for this length.

Ranks are made without a window over a whole length: pieces of a length are
dealt into salted groups whose number grows with the count, ranked inside a
group, and shifted by the sum of the groups before it.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import slices, stage

SEQUENCE_TOKENS = 2048
END_ID = 1
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
# Pieces ranked in one window group on average.
RANK_GROUP = 20_000
_CACHE_WORDS = 400_000
_SLICE_BYTES = 4 << 20


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# Words of these characters are encoded by the ranks file; others, and unusual spacing, by the tokenizer file.
_PLAIN_WORD = re.compile("[\\n -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*").fullmatch
# White space but for " " and "\n" (and what some readers take for it).
_OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(
    map(chr, range(0x2000, 0x200C)))


def _spaced_out(text: str) -> bool:
    """True unless every space stands alone between visible characters."""
    return ("  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
            or any(c in text for c in _OTHER_SPACE))


@lru_cache(maxsize=2)
def encoder(path: str, ranks_path: str) -> Callable[[list[str]], list[bytes]]:
    """texts -> their ids as little-endian unsigned 32-bit bytes.

    The ids are those of the tokenizer file. A pre-token must end before a
    single space, so words between single spaces are encoded once per task
    and remembered (``encode.words``, bounded and emptied by the task); the ranks file holds the same vocabulary
    and encodes such a word several times as fast. Texts with other runs of
    white space, and texts that hold an added token of the tokenizer file (which
    is one id wherever it stands), are encoded whole by that file.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    added = [t.content for t in whole.get_added_tokens_decoder().values()]
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(n) for a, n in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words: dict[str, bytes] = {}  # by the word without the space before it

    def full(text: str) -> bytes:
        return array("I", whole.encode(text, add_special_tokens=False).ids).tobytes()

    token_bytes = np.array([len(t) for t, _ in sorted(ranks.items(), key=lambda x: x[1])], dtype=np.int64)

    def learn(new: list[str]) -> None:
        """Encode new words in one text, each after its space, and cut the ids where the words end."""
        plain = [w for w in new if _PLAIN_WORD(w)]
        raw = [b" " + w.encode() for w in plain]
        ids = np.array(fast.encode_ordinary(b"".join(raw).decode()), dtype="<u4")
        ends = np.searchsorted(np.cumsum(token_bytes[ids]), np.cumsum([len(r) for r in raw])) + 1
        data = ids.tobytes()
        words.update(zip(plain, [data[4 * i:4 * j] for i, j in zip([0, *ends.tolist()], ends.tolist())]))
        words.update((w, full(" " + w)) for w in set(new).difference(plain))

    def encode(texts: list[str]) -> list[bytes]:
        if len(words) > _CACHE_WORDS:
            words.clear()
        cut = [None if _spaced_out(t) or any(a in t for a in added) else t.split(" ") for t in texts]
        new = set().union(*[c[1:] for c in cut if c]).difference(words)
        if new:
            learn(list(new))
        return [full(t) if c is None else full(c[0]) + b"".join(map(words.__getitem__, c[1:]))
                for t, c in zip(texts, cut)]

    encode.words = words
    return encode


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE_TOKENS,
           end_id: int = END_ID, path: str | None = None, ranks_path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) per piece. A null
    text counts as empty; every row gives at least the end id. Rows that repeat
    an id give their own pieces."""
    path, ranks_path = path or tokenizer_path(), ranks_path or tokenizer_path(RANKS)

    def run(batches):
        encode = encoder(path, ranks_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for b in batches:
            ids, texts = b.column("id").to_pylist(), b.column("text").to_pylist()
            for lo, hi in slices([len(t) for t in texts], _SLICE_BYTES):
                cols = [[], [], [], [], [], []]
                for i, data in zip(ids[lo:hi], encode(texts[lo:hi])):
                    data += end
                    total = len(data) // 4
                    for start in range(0, total, size):
                        part = data[4 * start:4 * (start + size)]
                        row = (i, start, len(part) // 4, zlib.crc32(part), total,
                               np.frombuffer(part, dtype="<i4") if keep_ids else None)
                        for c, v in zip(cols, row):
                            c.append(v)
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                n = 6 if keep_ids else 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols[:n], kinds)], names=names[:n])
        # the worker lives on for other stages
        encode.words.clear()

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if keep_ids else "")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema)


def plan(histogram: dict[int, int], size: int = SEQUENCE_TOKENS) -> list[tuple[int, tuple[int, ...]]]:
    """Pack types as (count, lengths) for a histogram of lengths."""
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in sorted((n for n, c in histogram.items() if c > 0), reverse=True):
        left = histogram[length]
        grown: list[tuple[int, tuple[int, ...]]] = []
        # the emptiest packs first; packs made by this length wait for the next pass
        for free in sorted((f for f in room if f >= length), reverse=True):
            packs = room.pop(free)
            while packs and left:
                count, held = packs.pop()
                fit = min(free // length, max(1, left // count))
                used = min(count, left // fit)
                if used < count:
                    packs.append((count - used, held))
                if used:
                    grown.append((used, held + (length,) * fit))
                    left -= used * fit
                elif left:  # fewer left than one pack could take
                    grown.append((1, held + (length,) * left))
                    packs[-1] = (count - 1, held)
                    left = 0
                packs = [p for p in packs if p[0]]
            if packs:
                room[free] = packs
            if not left:
                break
        if left:
            fit = size // length
            if left // fit:
                grown.append((left // fit, (length,) * fit))
            if left % fit:
                grown.append((1, (length,) * (left % fit)))
        for count, held in grown:
            room.setdefault(size - sum(held), []).append((count, held))
    return [p for packs in room.values() for p in packs]


def _places(patterns: list[tuple[int, tuple[int, ...]]]) -> pd.DataFrame:
    """One row per pattern and distinct length: the ranks it takes, its first
    sequence, and where its copies of the length start in a sequence."""
    taken: dict[int, int] = {}
    rows, first = [], 0
    for count, held in sorted(patterns, key=lambda p: (p[1], p[0])):
        offset = 0
        for length in sorted(set(held), reverse=True):
            each = held.count(length)
            rank = taken.get(length, 0)
            rows.append((length, rank, rank + each * count, each, first, offset))
            taken[length] = rank + each * count
            offset += each * length
        first += count
    return pd.DataFrame(rows, columns=["length", "rank_from", "rank_to", "each", "first_sequence", "base"]).astype("int64")


def ranked(rows: DataFrame, counts: dict[int, int], order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) inside their ``length``."""
    total = sum(counts.values())
    groups = max(1, -(-total // RANK_GROUP))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(groups)))
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("length", "_salt").orderBy(*order)
    return (salted.withColumn("_in", F.row_number().over(inside) - 1).join(sizes, ["length", "_salt"])
            .withColumn("rank", F.col("_before") + F.col("_in")).drop("_salt", "_in", "_before"))


def pack(rows: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """``rows`` of pieces (stored; columns doc_id, start, length, ids_crc32)
    with sequence_id and offset. Every piece gets one place; the pieces of a
    sequence lie gapless from 0."""
    spark = rows.sparkSession
    # at most `size` rows reach the driver, whatever the corpus
    counts = {int(r["length"]): r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(plan(counts, size))
    schema = "length long, rank_from long, rank_to long, each long, first_sequence long, base long"
    table = spark.createDataFrame(list(places.itertuples(index=False, name=None)), schema)
    placed = ranked(rows, counts, ["doc_id", "start", "ids_crc32"])
    # ranks of a length are cut by the starts of its patterns: the place is the last start at or before the rank
    starts = table.groupBy("length").agg(F.sort_array(F.collect_list(F.struct(
        "rank_from", "each", "first_sequence", "base"))).alias("_p"))
    # bounded: the pattern table grows with the number of lengths (at most `size`), not with the corpus
    j = placed.join(F.broadcast(starts), "length")
    at = F.expr("element_at(filter(_p, p -> p.rank_from <= rank), -1)")
    j = j.withColumn("_at", at).drop("_p")
    within = F.col("rank") - F.col("_at.rank_from")
    return j.select(*rows.columns,
                    (F.col("_at.first_sequence") + F.floor(within / F.col("_at.each"))).cast("long").alias("sequence_id"),
                    (F.col("_at.base") + F.pmod(within, F.col("_at.each")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, size: int = SEQUENCE_TOKENS, **params) -> DataFrame:
    return pack(stage(pieces(docs, size=size, **params), "pieces"), size)


def padding(packed: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """(sequences, tokens, padded): what padding to ``size`` adds, a fill that
    is a power of two being left as it is."""
    fills = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    power = F.expr("bit_count(fill) = 1")
    return fills.agg(F.count("*").alias("sequences"), F.sum("fill").alias("tokens"),
                     F.sum(F.when(power, 0).otherwise(size - F.col("fill"))).alias("padded"))
