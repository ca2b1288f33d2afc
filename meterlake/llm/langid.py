"""Language of texts, also of texts that mix several.

Every word (between white space) is scored per language by the log
probabilities of its hashed character 1- to 3-grams. The script of a word,
by ranges of code points, narrows the languages it may belong to. Viterbi over
the words, with a penalty for each switch, labels spans; the language with the
most letters in its spans is the document's.

The model is fitted on a bounded sample of labelled rows and is one table of
``BUCKETS`` counts for each language, so its size depends on the number of
languages only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import slices

UNKNOWN = "und"
BUCKETS = 1 << 15
# Labelled documents sampled for each language (in the mean), and languages that a model may have.
SAMPLE_DOCS = 3000
MAX_LANGS = 256
# Nats that a change of language between two words costs.
SWITCH = 12.0
# A script is open to a language that writes at least this share of its letters in it.
SCRIPT_SHARE = 0.01
# The pipeline rejects a text with a lower score (or without letters).
MIN_SCORE = 0.25
_SLICE_CHARS = 3 << 20
# Words scored at a time, which bounds the table of their grams.
_SCORE_WORDS = 30_000

# First code points of script ranges (fixed values, blocks of Unicode); each
# range ends where the next begins. 0 is any other script.
SCRIPTS = [(0x0041, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0780, 0),
           (0x0900, 7), (0x0980, 8), (0x0A00, 9), (0x0A80, 10), (0x0B00, 0), (0x0B80, 11), (0x0C00, 12), (0x0C80, 13),
           (0x0D00, 14), (0x0D80, 0), (0x0E00, 15), (0x0E80, 0), (0x10A0, 16), (0x1100, 17), (0x1200, 18), (0x1380, 0),
           (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 19), (0x3100, 0), (0x3400, 20), (0xA000, 0), (0xAC00, 17),
           (0xD7B0, 0), (0xF900, 20), (0xFB00, 0), (0x20000, 20), (0x323B0, 0)]
_STARTS = np.array([s for s, _ in SCRIPTS])
_OF = np.array([0] + [k for _, k in SCRIPTS])
N_SCRIPTS = int(_OF.max()) + 1


def _letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every 1- to 3-gram of non-empty words, word
    ends included."""
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    gap = points == 32
    number = np.cumsum(gap) - 1
    where, bucket = [], []
    with np.errstate(over="ignore"):
        h, inside = np.zeros(len(points), dtype=np.uint64), np.ones(len(points), dtype=bool)
        for n in (1, 2, 3):
            h = (h[: len(points) - n + 1] + points[n - 1:] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            at = np.arange(len(h))
            if n == 1:
                ok = ~gap
            elif n == 2:
                ok = ~(gap[:-1] & gap[1:])
            else:
                ok = ~gap[1:-1]
            where.append(number[at[ok]])
            bucket.append((h[ok] >> np.uint64(32)).astype(np.int64) % BUCKETS)
    return np.concatenate(where), np.concatenate(bucket)


def _scripts(words: list[str]) -> np.ndarray:
    """The script of each word's first letter (words have one script but for rare mixtures)."""
    first = np.array([ord(w[0]) for w in words], dtype=np.int64)
    return _OF[np.searchsorted(_STARTS, first, side="right")]


@dataclass
class Model:
    langs: list[str]
    score: np.ndarray  # (BUCKETS, languages) log probabilities
    open: np.ndarray  # (scripts, languages) bool
    common: int  # the language with the most labelled letters

    def words(self, words: list[str]) -> np.ndarray:
        """(words, languages); -1e6 for a language closed to the word's script,
        0 in all for a script that no language writes."""
        if len(words) > _SCORE_WORDS:
            return np.concatenate([self.words(words[i:i + _SCORE_WORDS]) for i in range(0, len(words), _SCORE_WORDS)])
        out = np.zeros((len(words), len(self.langs)))
        if not words:
            return out
        where, bucket = _grams(words)
        order = np.argsort(where, kind="stable")
        where, bucket = where[order], bucket[order]
        starts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        out[where[starts]] = np.add.reduceat(self.score[bucket], starts, axis=0)
        may = self.open[_scripts(words)]
        out = np.where(may, out, -1e6)
        out[~may.any(axis=1)] = 0
        return out


def _counts(batches):
    for pdf in batches:
        for lang, texts in pdf.groupby("lang")["text"]:
            grams, scripts = np.zeros(BUCKETS, dtype=np.int64), np.zeros(N_SCRIPTS, dtype=np.int64)
            texts = texts.tolist()
            for lo, hi in slices([len(t) for t in texts], _SLICE_CHARS):
                seen = pd.Series([w for t in texts[lo:hi] for w in t.lower().split()]).value_counts()
                words = [_letters(w) for w in seen.index]
                keep = [i for i, w in enumerate(words) if w]
                if not keep:
                    continue
                words, n = [words[i] for i in keep], seen.to_numpy()[keep]
                where, bucket = _grams(words)
                grams += np.bincount(bucket, weights=n[where], minlength=BUCKETS).astype(np.int64)
                scripts += np.bincount(_scripts(words), weights=n * [len(w) for w in words], minlength=N_SCRIPTS).astype(np.int64)
            both = np.concatenate([grams, scripts])
            at = np.flatnonzero(both)
            yield pd.DataFrame({"lang": lang, "slot": at, "n": both[at]})


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = SAMPLE_DOCS, max_langs: int = MAX_LANGS) -> Model | None:
    """A model of the rows that have text and language; about ``sample_docs``
    of each language are read, drawn by id and text together, so that rows
    without an id or with the same one are drawn one by one. None if there is
    no such row. A model takes 256 kB a language on the driver and in every
    task; more than ``max_langs`` different values are an error."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                           F.col(id_col).alias("id")).filter("text is not null and lang is not null")
    per = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(max_langs + 1).collect()}
    if not per:
        return None
    if len(per) > max_langs:
        raise ValueError(f"more than {max_langs} values in {lang_col}: clean the column or raise max_langs")
    share = F.create_map(*[F.lit(x) for lang, n in per.items() for x in (lang, min(1.0, sample_docs / n))])
    u = F.pmod(F.xxhash64(F.lit("sample"), "id", "text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    drawn = rows.filter(u < F.try_element_at(share, F.col("lang"))).select("text", "lang")
    # languages x (BUCKETS + scripts) rows at most
    table = drawn.mapInPandas(_counts, "lang string, slot long, n long").groupBy("lang", "slot").agg(
        F.sum("n").alias("n")).toPandas()
    langs = sorted(set(table["lang"]))
    if not langs:
        return None
    counts = np.zeros((BUCKETS + N_SCRIPTS, len(langs)))
    counts[table["slot"].to_numpy(), [langs.index(x) for x in table["lang"]]] = table["n"].to_numpy()
    grams, scripts = counts[:BUCKETS] + 0.5, counts[BUCKETS:]
    letters = scripts.sum(axis=0)
    may = scripts >= SCRIPT_SHARE * np.maximum(letters, 1)
    may[0] = False
    return Model(langs, np.log(grams / grams.sum(axis=0)), may, int(letters.argmax()))


def viterbi(emit: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word of many documents laid end to end; documents
    are stepped through together, the longest first."""
    n, k = emit.shape
    order = np.argsort(-lengths, kind="stable")
    start = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    stay, best = np.ones((n, k), dtype=bool), np.zeros(n, dtype=np.int16)
    state = np.zeros((len(size), k))
    steps = int(size.max()) if len(size) else 0
    alive_at = len(size) - np.searchsorted(size[::-1], np.arange(steps), side="right")
    for t in range(steps):
        a = alive_at[t]
        at, s = start[:a] + t, state[:a]
        if t:
            top = s.argmax(axis=1)
            moved = s[np.arange(a), top][:, None] - switch
            keep = s >= moved
            stay[at], best[at] = keep, top
            s = np.maximum(s, moved)
        s = s + emit[at]
        state[:a] = s - s.max(axis=1, keepdims=True)
    label = np.zeros(n, dtype=np.int16)
    now = state.argmax(axis=1).astype(np.int16)
    for t in range(steps - 1, -1, -1):
        a = alive_at[t]
        at, cur = start[:a] + t, now[:a]
        label[at] = cur
        if t:
            now[:a] = np.where(stay[at, cur], cur, best[at])
    return label


def _slice(texts: list[str], model: Model, switch: float):
    """Language number (-1: no letter), score and spans' labels of some texts."""
    tokens = [t.lower().split() for t in texts]
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    codes, distinct = pd.factorize(np.array([w for t in tokens for w in t] or [""], dtype=object))
    if not sizes.sum():
        codes = codes[:0]
    words = [_letters(w) for w in distinct]
    have = [i for i, w in enumerate(words) if w]
    emit = np.zeros((len(words), len(model.langs)))
    letters = np.zeros(len(words), dtype=np.int64)
    known = np.zeros(len(words), dtype=bool)
    if have:
        w = [words[i] for i in have]
        emit[have], letters[have] = model.words(w), [len(x) for x in w]
        known[have] = model.open[_scripts(w)].any(axis=1)
    label = viterbi(emit[codes], sizes, switch)
    doc = np.repeat(np.arange(len(texts)), sizes)
    k = len(model.langs)
    votes = np.bincount(doc * k + label, weights=letters[codes] * known[codes], minlength=len(texts) * k).reshape(-1, k)
    total = np.bincount(doc, weights=letters[codes], minlength=len(texts))
    lang = np.where(votes.any(axis=1), votes.argmax(axis=1), model.common)
    score = votes[np.arange(len(texts)), lang] / np.maximum(total, 1)
    return np.where(total > 0, lang, -1), np.where(total > 0, score, 0.0), label, sizes


def predict(docs: DataFrame, model: Model | None, carry: list[str], text_col: str = "text",
            switch: float = SWITCH) -> DataFrame:
    """``carry`` columns, lang_pred and score of every row. Null texts and
    texts without a letter are ``und`` with score 0; so is every text if
    nothing could be learned. Score is the share of the letters that lie in
    spans of the language and in a script it is written in; ties go to the
    first language by name."""
    if model is None:
        return docs.select(*carry, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        names = np.array([*m.langs, UNKNOWN], dtype=object)
        for b in batches:
            texts = [t or "" for t in b.column("_text").to_pylist()]
            langs, scores = [], []
            for lo, hi in slices([len(t) for t in texts], _SLICE_CHARS):
                lang, score, _, _ = _slice(texts[lo:hi], m, switch)
                langs.append(names[lang])
                scores.append(score)
            out = [b.column(c) for c in carry] + [
                pa.array(np.concatenate(langs) if langs else [], pa.string()),
                pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            yield pa.RecordBatch.from_arrays(out, names=[*carry, "lang_pred", "score"])

    rows = docs.select(*carry, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema)
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def with_letters(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows whose text has a letter: those that ``predict`` does not call
    ``und`` where a model is at hand."""
    def run(batches):
        for b in batches:
            texts = b.column("_text").to_pylist()
            yield b.filter(pa.array([any(map(str.isalpha, t or "")) for t in texts], pa.bool_())).drop_columns(["_text"])

    rows = docs.select("*", F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, docs.schema)


def spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          switch: float = SWITCH) -> DataFrame:
    """(id, first_word, last_word, lang) of every span, by number of word."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for pdf in batches:
            texts = pdf["_text"].fillna("").tolist()
            _, _, label, sizes = _slice(texts, m, switch)
            out, at = [], 0
            for i, n in zip(pdf["id"], sizes):
                own = label[at:at + n]
                cuts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if n else np.array([], dtype=int)
                out += [(i, int(a), int(b) - 1, m.langs[own[a]]) for a, b in zip(cuts, [*cuts[1:], n])]
                at += n
            yield pd.DataFrame(out, columns=["id", "first_word", "last_word", "lang"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text")).mapInPandas(
        run, "id long, first_word long, last_word long, lang string")


def held_out(id_col: str = "doc_id"):
    """Rows kept from training: crc32 of the id as text has remainder 2 by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
