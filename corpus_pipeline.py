"""A corpus from raw documents to token files, in stages.

Each stage takes all that the one before kept, is written as Parquet and read again. The
stages but the last return the columns of ``documents``; the last returns the digests
read from the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import decontam, mixing, near_dedup, token_files, toxicity
from llm.queries import TOKENIZER, table, workers_find_us
from llm.storage import land

#: SQL cannot express a model, a sketch or a tokenizer; the stages are tested one by one.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic by a model of the labels that may be used."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.without_toxic(docs, labels.where(toxicity.fold("doc_id", 4) != 2))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    workers_find_us(spark)
    return near_dedup.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of smaller sources up to twice, at the mixture's weights."""
    workers_find_us(spark)
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and the digests of all documents read back from them."""
    workers_find_us(spark)
    return token_files.token_output(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name)
    return docs
