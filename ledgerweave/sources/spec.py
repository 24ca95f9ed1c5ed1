"""What a run of the generators is given, and where its row ids come from."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession

from ledgerweave.functions.rng import RowRandom

ROWS_PER_TASK = 5_000_000
ID = "id"


@dataclass(frozen=True)
class Spec:
    """Seed, load date and pick style of a run.

    ``salted`` draws every random pick independently.  ``cyclic`` takes each pick from
    the row id modulo the pool size, which locks columns to each other.
    """

    as_of: dt.date
    seed: int = 42
    style: Literal["salted", "cyclic"] = "salted"

    def __post_init__(self) -> None:
        if self.style not in ("salted", "cyclic"):
            raise ValueError(f"unknown style {self.style!r}")

    @property
    def cyclic(self) -> bool:
        return self.style == "cyclic"

    def random(self, table: str) -> RowRandom:
        """Draws for the rows of one table."""
        return TableRandom(ID, self.seed, table)


@dataclass(frozen=True)
class TableRandom(RowRandom):
    """Row draws whose salts are kept apart per table."""

    table: str = ""

    def stream(self, salt: str) -> str:
        return f"{self.table}.{salt}"


def id_range(
    spark: SparkSession, n: int, start: int = 1, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``n`` consecutive ids with no shuffle and a bounded number of rows per task."""
    partitions = max(1, math.ceil(n / rows_per_task), cores_for(spark, n))
    return spark.range(start, start + n, 1, partitions)


def cores_for(spark: SparkSession, n: int) -> int:
    """The cores worth using for ``n`` rows: one per 10,000, as far as there are."""
    return min(spark.sparkContext.defaultParallelism, math.ceil(n / 10_000))


def ids_from(df: DataFrame, expression: Column) -> DataFrame:
    """Existing rows as row ids: one generated row per input row."""
    return df.select(expression.cast("bigint").alias(ID))
