"""Groups of spelling variants: words one edit apart in a counted vocabulary.

Two words are near if one inserted, deleted or replaced code point turns one
into the other. The vocabulary is cut into sorted lists in which every near
pair is found exactly once, and each list is scanned with the banded edit
matrix: a query's matrix has three cells a row, the rows down to the common
prefix of a list word and the word before it are kept, and all words that share
a prefix on which every cell exceeds one edit are passed over.

A near pair differs first at one place p of its longer word (length L). A list
``(L, lo, hi, key)`` holds the words of lengths L and L - 1 that share the
first ``lo`` code points and, after place ``hi``, the rest of the word; it finds
the pairs with lo <= p < hi. Every word starts in the lists of either half, as
the longer and as the shorter word. A list of more than ``MAX_LIST`` words is
halved again, both halves with a longer key, until it is small or one place
wide, where the alphabet bounds it. So no list grows with the corpus, none is
cut short, and the scan of a list holds its words only.

Null or empty texts have no words; a row whose id is null counts with an empty
id. Rows are not compared with each other, so repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import ascii_lower, stage

# Parameters of the word count. Code points of a word lie in a-z and U+00C0..U+00FF.
MIN_LENGTH, MIN_COUNT = 5, 3
RUN = "[a-zÀ-ÿ]{%d,}+"
# One run in SLIP loses a code point, chosen by a checksum of id and run.
SLIP = 97
# A form's count is at least this multiple of the word's.
RATIO = 2
# Words of a list at most; one place wide, the alphabet allows 91.
MAX_LIST = 256
# Matrix cells (words x code points) that a task scans at a time.
SCAN_CELLS = 2_000_000


def runs(text: Column, least: int = MIN_LENGTH) -> Column:
    """Maximal runs of letters of at least ``least`` code points, A-Z lower-cased."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(RUN % least), F.lit(0))


def slipped(word: Column, doc_id: Column, one_in: int = SLIP) -> Column:
    """The run, or the run without one code point where the checksum of
    ``<id>:<run>`` is a multiple of ``one_in``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word))
    at = (h % F.length(word)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): counted per task before the shuffle."""
    w = docs.select(F.col(id_col).alias("id"), F.explode(runs(F.col(text_col), min_length)).alias("run"))
    w = w.select(slipped(F.col("run"), F.col("id")).alias("word")).filter(F.length("word") >= min_length)
    return w.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


# ----------------------------------------------------------------- sorted lists
_LIST = ["long_len", "lo", "hi", "key"]


def _halves(lo: Column, hi: Column) -> Column:
    mid = F.floor((lo + hi) / 2).cast("int")
    return F.array(F.struct(lo.alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), hi.alias("hi")))


def _members(ranges: DataFrame) -> DataFrame:
    """(word, n, long_len, lo, hi) with the list's key."""
    tail = F.col("long_len") - F.col("hi")
    key = F.concat(F.substring("word", F.lit(1), F.col("lo")), F.lit("|"),
                   F.substring("word", F.length("word") - tail + 1, tail))
    return ranges.withColumn("key", key)


def _split(ranges: DataFrame) -> DataFrame:
    parts = ranges.select("word", "n", "long_len", F.explode(_halves(F.col("lo"), F.col("hi"))).alias("r"))
    return _members(parts.select("word", "n", "long_len", "r.lo", "r.hi"))


def lists(words: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """The members of all sorted lists, none of more than ``max_list`` words
    unless it is one place wide."""
    roles = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("long_len")
    level = _split(words.select("word", "n", roles).select(
        "word", "n", "long_len", F.lit(0).alias("lo"), F.col("long_len").alias("hi")))
    done = None
    while True:
        size = level.filter("hi - lo > 1").groupBy(*_LIST).agg(F.count("*").alias("size"))
        large = stage(size.filter(F.col("size") > max_list).select(*_LIST), "large_lists")
        if large.isEmpty():
            return level if done is None else done.unionByName(level)
        small = level.join(large, _LIST, "left_anti").select(level.columns)
        done = small if done is None else done.unionByName(small)
        level = stage(_split(level.join(large, _LIST, "left_semi")), "halved_lists")


# ------------------------------------------------------------------------ scan
def _common(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Common prefix lengths of the rows of two code point matrices."""
    same = np.logical_and.accumulate(a == b, axis=1).sum(axis=1)
    return np.minimum(same, np.minimum(la, lb))


def scan(mids: list[bytes], first: np.ndarray, span: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs (query, word), both directions, inside sorted lists.

    ``mids`` are the differing parts of the words, one byte a code point, list
    after list and sorted within each; ``first`` marks where lists begin; ``span``
    is the length of a longer word's differing part; ``after`` is the code point
    that follows the differing part (0: none). Step t compares every query with the t-th word of its list, all lists at once.
    """
    if not mids:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lens = np.array([len(m) for m in mids], dtype=np.int32)
    width = int(lens.max())
    # a guard column on either side: code points before the first and after the last equal nothing
    text = np.zeros((len(mids), width + 3), dtype=np.uint8)
    text[:, 1:width + 1] = np.array(mids, dtype=f"S{max(width, 1)}").view(np.uint8).reshape(len(mids), -1)[:, :width]
    chars = text[:, 1:]
    lcp = np.zeros(len(mids), dtype=np.int32)
    lcp[1:] = _common(chars[1:], lens[1:], chars[:-1], lens[:-1])
    lcp[first] = 0
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(mids)))
    # queries of the largest lists first: those that have a t-th word are a prefix
    order = np.argsort(-sizes, kind="stable")
    query = np.concatenate([np.arange(starts[o], starts[o] + sizes[o]) for o in order])
    begin, count = np.repeat(starts[order], sizes[order]), np.repeat(sizes[order], sizes[order])

    n = len(query)
    rows = np.zeros((width + 1, 3, n), dtype=np.int8)  # row d: cells d - 1, d, d + 1 of the query
    rows[0] = np.array([2, 0, 1], dtype=np.int8)[:, None]
    dead = np.full(n, width + 2, dtype=np.int32)  # rows needed until every cell exceeded one edit
    out_q, out_w = [], []
    for t in range(int(count[0])):
        have = int(np.searchsorted(-count, -t, side="left"))
        word = begin[:have] + t
        at = lcp[word]
        # words that share a prefix on which the matrix has run out are passed over
        live = np.flatnonzero(dead[:have] > at)
        depth, word = at[live], word[live]
        dead[live] = width + 2
        while len(live):
            ended = depth == lens[word]
            if ended.any():
                e, w = live[ended], word[ended]
                gap = lens[query[e]] - lens[w]
                hit = np.abs(gap) <= 1
                e, w, gap = e[hit], w[hit], gap[hit]
                hit = rows[lens[w], gap + 1, e] == 1
                out_q.append(query[e[hit]])
                out_w.append(w[hit])
                live, depth, word = live[~ended], depth[~ended], word[~ended]
            q, c = query[live], text[word, depth + 1]
            x, y, z = rows[depth, 0, live], rows[depth, 1, live], rows[depth, 2, live]
            at_end = np.minimum(depth, lens[q] + 1)  # past its end a query has guard cells only
            nx = np.minimum(x + (c != text[q, at_end]), y + 1)
            ny = np.minimum(np.minimum(y + (c != text[q, np.minimum(depth + 1, width + 2)]), z + 1), nx + 1)
            nz = np.minimum(z + (c != text[q, np.minimum(depth + 2, width + 2)]), ny + 1)
            depth = depth + 1
            rows[depth, 0, live], rows[depth, 1, live], rows[depth, 2, live] = np.minimum(nx, 2), np.minimum(ny, 2), np.minimum(nz, 2)
            out = np.minimum(np.minimum(nx, ny), nz) > 1
            dead[live[out]] = depth[out]
            live, depth, word = live[~out], depth[~out], word[~out]
    qs, ws = np.concatenate(out_q) if out_q else np.empty(0, np.int64), np.concatenate(out_w) if out_w else np.empty(0, np.int64)
    # two of the shorter words meet in the lists of their own length
    keep = (lens[qs] == span[qs]) | (lens[ws] == span[ws])
    qs, ws = qs[keep], ws[keep]
    # a code point dropped before an equal one: the pair first differs later, in another list
    swap = lens[qs] > lens[ws]
    longer, shorter = np.where(swap, qs, ws), np.where(swap, ws, qs)
    doubt = np.flatnonzero((lens[longer] > lens[shorter]) & (after[longer] != 0) & (chars[longer, lens[longer] - 1] == after[longer]))
    if len(doubt):
        a, b = longer[doubt], shorter[doubt]
        later = _common(chars[a], lens[a], chars[b], lens[b]) == lens[b]
        keep = np.ones(len(qs), dtype=bool)
        keep[doubt[later]] = False
        qs, ws = qs[keep], ws[keep]
    return qs, ws


def _best(words: list[str], n: np.ndarray, qs: np.ndarray, ws: np.ndarray) -> pd.DataFrame:
    """Per query the number of its near words and the best: largest n, then
    smallest in code point order."""
    encoded = np.array([w.encode("latin-1") for w in words])
    rank = np.unique(encoded, return_inverse=True)[1]
    by = np.lexsort((rank[ws], -n[ws], qs))
    qs, ws = qs[by], ws[by]
    head = np.flatnonzero(np.r_[True, qs[1:] != qs[:-1]]) if len(qs) else np.empty(0, np.int64)
    near = np.diff(np.append(head, len(qs)))
    return pd.DataFrame({"word": [words[i] for i in qs[head]], "near": near.astype(np.int64),
                         "best": [words[i] for i in ws[head]], "best_n": n[ws[head]]})


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by list, then by differing part; lists are scanned as
    soon as they are whole, so a task holds some ``SCAN_CELLS`` cells."""
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())])

    def part(t: pa.Table) -> Iterator[pa.RecordBatch]:
        """Scan whole lists, some at a time."""
        if not t.num_rows:
            return
        t = t.combine_chunks()
        same = np.ones(t.num_rows - 1, dtype=bool)
        for c in _LIST:
            col = t.column(c)
            same &= pc.equal(col.slice(1), col.slice(0, t.num_rows - 1)).to_numpy()
        first = np.r_[True, ~same]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, t.num_rows))
        keep = np.repeat(sizes > 1, sizes)  # alone in its list: nothing to compare
        if not keep.any():
            return
        t, first = t.filter(pa.array(keep)), first[keep]
        starts = np.append(np.flatnonzero(first), t.num_rows)
        cells = pc.utf8_length(t.column("mid")).to_numpy().astype(np.int64) + 1
        at = 0
        while at < len(starts) - 1:
            # some lists whose rows x longest part stay within the bound
            until, wide = at + 1, cells[starts[at]:starts[at + 1]].max()
            while until < len(starts) - 1:
                wide = max(wide, cells[starts[until]:starts[until + 1]].max())
                if wide * (starts[until + 1] - starts[at]) > SCAN_CELLS:
                    break
                until += 1
            lo, hi = int(starts[at]), int(starts[until])
            s = t.slice(lo, hi - lo)
            mids = [m.encode("latin-1") for m in s.column("mid").to_pylist()]
            after = np.array([ord(k[p + 1]) if len(k) > p + 1 else 0 for k, p in
                              zip(s.column("key").to_pylist(), s.column("lo").to_pylist())], dtype=np.uint8)
            words = s.column("word").to_pylist()
            span = s.column("hi").to_numpy() - s.column("lo").to_numpy()
            qs, ws = scan(mids, first[lo:hi], span, after)
            if len(qs):
                yield pa.RecordBatch.from_pandas(_best(words, s.column("n").to_numpy(), qs, ws), schema=schema, preserve_index=False)
            at = until

    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size * 16 < SCAN_CELLS:
            continue
        t = pa.Table.from_batches(held)
        last = {c: t.column(c)[t.num_rows - 1] for c in _LIST}
        own = np.ones(t.num_rows, dtype=bool)
        for c in _LIST:
            own &= pc.equal(t.column(c), last[c]).to_numpy()
        cut = t.num_rows - int(own.sum())  # the last list may go on
        yield from part(t.slice(0, cut))
        held = t.slice(cut).combine_chunks().to_batches()
        size = t.num_rows - cut
    if held:
        yield from part(pa.Table.from_batches(held))


def near_words(words: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """(word, n_near, best struct<neg_n, word>) for the words that have a near
    word. ``words``: (word, n), each word once, of the alphabet of ``RUN``."""
    tail = F.col("long_len") - F.col("hi")
    mid = F.substring("word", F.col("lo") + 1, F.length("word") - F.col("lo") - tail)
    m = lists(words, max_list).withColumn("mid", mid)
    m = m.repartition(*_LIST).sortWithinPartitions(*_LIST, "mid")
    found = m.mapInArrow(_scan_batches, "word string, near long, best string, best_n long")
    return found.groupBy("word").agg(
        F.sum("near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("neg_n"), F.col("best").alias("word"))).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words that have a form: chains are halved in every
    round. Counts at least double along a chain, so it has no cycle and its
    length is at most the logarithm of the largest count."""
    at = stage(forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        at = stage(at.join(step, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, ratio: int = RATIO,
             max_list: int = MAX_LIST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary."""
    words = stage(vocabulary(docs, id_col, text_col), "vocabulary")
    near = near_words(words, max_list)
    usual = -F.col("best.neg_n") >= ratio * F.col("n")
    forms = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(usual, F.col("best.word")).alias("form"), F.when(usual, -F.col("best.neg_n")).alias("form_n")), "forms")
    out = forms.join(roots(forms), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
