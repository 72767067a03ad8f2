"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor
kept. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, langid, mixing, ngram_join, packing
from tessera.llm.common import Scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a language: null texts and texts without letters go."""
    model = langid.fit_on(docs, F.lit(True))
    if model is None:  # no label to learn from says nothing about the texts
        return docs.filter(F.col("text").rlike(langid.LETTER))
    named = langid.identify(docs, model)
    return named.filter(F.col("lang_pred") != langid.UNKNOWN).select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of texts with five-word shingles 0.8 or more alike."""
    return ngram_join.keep_one(docs, words=5, num=80, den=100)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the target weights of the sources take it."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language_id", language_id),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

#: Tokenising and fitting have no SQL form; ``tests/llm/test_stages.py`` holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again, and
    deleted when the next one is written."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    before = None
    for name, stage in STAGES:
        docs = scratch.table(name, stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = name
    return docs
