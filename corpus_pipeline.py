"""The corpus pipeline: each stage reads what its predecessor wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerweave.llm import pipeline

STAGES = [
    ("toxicity", pipeline.toxicity),
    ("exact_dedup", pipeline.exact_dedup),
    ("ngram_join", pipeline.ngram_join),
    ("mixing", pipeline.mixing),
    ("packing", pipeline.packing),
]

#: SQL can't state the trees, the draws or the packing; tests hold a brute-force run against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next."""
    return pipeline.run(spark, sf_dir, STAGES)
