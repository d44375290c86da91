"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

Toxic documents go, repeated passages are cut out of the texts, one document of every group
of near-duplicates stays, and what is left is packed into training sequences.

Defined cases: a null text stays null until it is packed as empty (its closing token alone), and counts as
an empty text for the near-duplicates; empty texts are near-duplicates of each other, so one of them
stays; rows without doc_id and rows that share one are documents of their own; without labels of
both classes nothing is toxic; an empty table gives empty stages; further columns, whatever their names, are carried
through to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import line_dedup, packing, simhash, toxicity
from parcelflow.llm.common import staged, table
from parcelflow.llm.queries import WORD_TOKENIZER


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier learns from the labels of the documents at hand; what it rejects goes."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(docs).select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", without_near_duplicates),
    ("packing", packed),
]

# Training a classifier and tokenizing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
