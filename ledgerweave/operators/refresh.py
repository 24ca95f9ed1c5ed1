"""The stored ledger aggregate, kept up to date by what is appended to the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.operators.agg import AMOUNTS, GRAIN, ledger_aggregate, roll_up
from ledgerweave.sources.schema import Layout
from ledgerweave.sources.tables import read_table, replace_partitions, save_table, scratch_path

PERIOD = GRAIN[0]
#: The last batch that a period's partition holds.
BATCH = "last_batch"
LAYOUT = Layout((PERIOD,), ("company_id", "profit_center_id"))
#: Grain column that closes the range key of a write.
LAST = "account_class"


def create_aggregate(ledger: DataFrame, accounts: DataFrame, target: str) -> None:
    """Store the aggregate of a whole ledger, partitioned by period, as batch 0."""
    first = ledger_aggregate(ledger, accounts).withColumn(BATCH, F.lit(0).cast("bigint"))
    save_table(first, target, LAYOUT, LAST)


def refresh_aggregate(
    spark: SparkSession, target: str, appended: DataFrame, accounts: DataFrame, batch: int
) -> None:
    """Merge the aggregate of appended ledger rows into the stored one.

    Only the appended rows and the stored periods they fall in are read, and only those periods'
    partitions are written again.  Batches are numbered from 1 on, in the order of their
    appends.  A batch whose refresh broke off is applied again as it was: a period that holds
    it already, as its partition says, is left alone, so no row counts twice.
    """
    path = scratch_path(spark, "delta")
    save_table(ledger_aggregate(appended, accounts), path)
    delta = pending(read_table(spark, target), read_table(spark, path), batch)
    # At most as many as the calendar has.
    periods = [r[0] for r in delta.select(PERIOD).distinct().collect()]
    if periods:
        merged = merge(read_table(spark, target), delta, periods)
        replace_partitions(
            spark, merged.withColumn(BATCH, F.lit(batch).cast("bigint")), target, LAYOUT, LAST
        )


def pending(stored: DataFrame, delta: DataFrame, batch: int) -> DataFrame:
    """The rows of a batch's aggregate whose period doesn't hold the batch yet."""
    done = stored.where(F.col(BATCH) >= batch).select(PERIOD).distinct()
    return delta.join(done, PERIOD, "left_anti")


def merge(stored: DataFrame, delta: DataFrame, periods: list[int]) -> DataFrame:
    """The named periods with a batch's sums added key by key."""
    columns = [*GRAIN, *AMOUNTS, "row_cnt"]
    old = stored.where(F.col(PERIOD).isin(periods)).select(*columns)
    return roll_up(old.unionAll(delta.select(*columns)), GRAIN)


def stored_aggregate(spark: SparkSession, target: str) -> DataFrame:
    """The aggregate as it is stored."""
    return read_table(spark, target).select(*GRAIN, *AMOUNTS, "row_cnt")
