"""From raw documents to packed training sequences, as five stages of the training-data operators.

Every stage takes the session, the documents its predecessor kept and the folder of the input tables,
and works on all of them. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalog_signals.llm.line_dedup import deduped_documents
from catalog_signals.llm.mixing import mixed_documents
from catalog_signals.llm.ngram_join import distinct_documents
from catalog_signals.llm.packing import pack
from catalog_signals.llm.quality_rules import clean_documents
from catalog_signals.llm.queries import packing_parameters
from catalog_signals.llm.text import checkpointed, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that fail the rules or are depleted, and without frequent lines."""
    return clean_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later occurrences of three lines in a row; documents it empties go."""
    return deduped_documents(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of least id."""
    return distinct_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture draws it."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return pack(docs, packing_parameters())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("mixing", mixing),
    ("best-fit packing", packing),
]

#: Neither the join's hashed paths nor a tokenizer can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
