"""The corpus pipeline: stages over the documents, each written and read again.

Every stage works on all that its predecessor kept. A stage takes the documents, an
empty table included, and returns their columns; the last one returns encoded texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import bpe, langid, minhash, mixing, quality
from tallymart.llm.tables import kept_table, read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return langid.accepted(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    return minhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row per span that an output slot holds of a document, with the span's text and length.

    Spans keep their document's id, language and source. A span that is taken several
    times is there several times.
    """
    mixed = mixing.mixed_texts(docs, mixing.mix(docs))
    own = mixing.DOCUMENT_COLUMNS
    return mixed.select(*(F.col(name) if name in own else F.col(f"others.`{name}`") for name in docs.columns))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and digests of all mixed texts, decoded again."""
    return bpe.round_trip(docs, keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near-duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

# Learned classifiers and pseudorandom draws are nothing SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage reads what its predecessor has written."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return docs
