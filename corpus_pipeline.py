"""The corpus pipeline: language, exact and near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes every stage to shared
storage and reads it again, so that a lost executor costs one stage's tasks at
most. The result cannot be expressed in SQL (a learned model, fingerprints,
tokens), so the tests compare it with a plain Python version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import exact_dedup, langid, mixing, packing, simhash
from meterlake.llm.common import DOC_COLUMNS, keep_rows, remove, scratch, scratch_removed, stage, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and those of which less than a quarter of
    the letters is in the language predicted (scripts that no labelled
    language writes). The model learns from the labelled rows given; where
    there is none, nothing is known of languages and only texts without a
    letter (null ones among them) go."""
    docs = docs.select(*DOC_COLUMNS)
    model = langid.fit(docs)
    if model is None:
        return langid.with_letters(docs)
    judged = langid.predict(docs, model, DOC_COLUMNS)
    return judged.filter(f"lang_pred <> '{langid.UNKNOWN}' and score >= {langid.MIN_SCORE}").select(*DOC_COLUMNS)


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts alike but for white space, the one with the most code points
    stays, then that with the smallest id."""
    return keep_rows(docs.select(*DOC_COLUMNS), exact_dedup.survivors(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by fingerprints within the bit distance, the one
    with the smallest id stays."""
    return keep_rows(docs.select(*DOC_COLUMNS), simhash.survivors(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target rate says; some not at
    all, some several times (copies keep their id)."""
    return mixing.mix(docs, DOC_COLUMNS).select(*DOC_COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in its sequence of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_duplicates),
    ("simhash_near_dedup", drop_near_duplicates),
    ("poisson_mix", mix_sources),
    ("packing", pack_sequences),
]

# Neither the learned language model nor the tokenizer is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Tables that a stage makes on its way go when
    its own rows are written, and those rows when the next stage's are, so two
    stages are stored at a time; after a failure nothing is left."""
    docs, stored = table(spark, sf_dir, "documents"), []
    try:
        for name, f in STAGES[:-1]:
            path = scratch(spark, name)
            stored.append(path)
            with scratch_removed(spark):
                docs = stage(f(spark, docs, sf_dir), name, path)
            remove(spark, stored[:-1])
            stored = [path]
        return STAGES[-1][1](spark, docs, sf_dir)
    except BaseException:
        remove(spark, stored)
        raise
