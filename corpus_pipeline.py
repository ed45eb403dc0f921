"""A corpus pipeline over ``documents``: rules, near duplicates, repeated
passages, mixing, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import bpe, jaccard, mixing, rules, substring
from tokenloom.llm.tables import read
from tokenloom.session import land


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """``changed`` with the columns of ``docs``; ``n_chars`` follows the text."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy keeps."""
    ledger = rules.ledger(docs)
    return ledger.where(rules.verdict("ledger_bits", rules.STANDARD)).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 5-word shingles, Jaccard
    similarity of at least 0.8.  (op10 has its own, 4 words and 85 %.)"""
    return jaccard.one_of_each(docs, percent=80, width=5)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents have; a document
    that has nothing else stays with an empty text."""
    return _like(docs, substring.dedup(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    return bpe.encode(docs, check=True).select("doc_id", "lang", "source", "n_tokens", "ids", "round_trip")


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("bpe_codec", bpe_codec),
]

# The last stage's ids are beyond SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
