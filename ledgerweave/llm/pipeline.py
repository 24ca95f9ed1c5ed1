"""The stages of the corpus pipeline.

Each takes (spark, docs, sf_dir) and works on every row of docs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerweave.llm.common import table, written
from ledgerweave.llm.exact_dedup import keep_latest
from ledgerweave.llm.mixing import mixed_documents
from ledgerweave.llm.ngram_join import one_of_each_class
from ledgerweave.llm.packing import pack
from ledgerweave.llm.toxicity import not_toxic

TOKENIZER = "byte_bpe_50k.json"
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic."""
    return not_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts only the row with the largest doc_id."""
    return keep_latest(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return one_of_each_class(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each document and epoch with the words that it gives."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


def run(spark: SparkSession, sf_dir: str, stages: Sequence[tuple[str, Stage]]) -> DataFrame:
    """Apply the stages to the documents; each reads what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in stages[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return stages[-1][1](spark, docs, sf_dir)
