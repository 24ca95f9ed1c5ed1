"""A child and a large parent stored in buckets of their key, so that joins never move the child.

Both tables are dealt once, when they are written.  Lookups, orphan checks and sums by key then
read matching buckets side by side, without an exchange of either table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.operators.joins import ROWS_PER_TASK, hot_keys, is_small
from ledgerweave.sources.tables import save_table

SALT = "_salt"


class Bucketed(NamedTuple):
    """The catalog names of a child and its parent, and the columns both are bucketed by.

    ``by`` is the child's key, and the salt if some key has more rows than one task takes.
    """

    child: str
    parent: str
    key: str
    parent_key: str
    salted: bool

    @property
    def by(self) -> list[str]:
        return [self.key, SALT] if self.salted else [self.key]

    @property
    def parent_by(self) -> list[str]:
        return [self.parent_key, SALT] if self.salted else [self.parent_key]


def save_bucketed(
    child: DataFrame,
    parent: DataFrame,
    on: tuple[str, str],
    row_id: str,
    names: tuple[str, str],
    buckets: int,
    rows_per_task: int = ROWS_PER_TASK,
) -> Bucketed:
    """Write a child and its parent as catalog tables in equal buckets of the key.

    ``on`` is (child column, parent key), of one type: a cast would undo the buckets.  The rows
    of a key with more than ``rows_per_task``, or without a key if those are as many, are dealt
    by a hash of their id over as many salts as they need; the parent's row is repeated for each.
    """
    key, parent_key = on
    kinds = child.schema[key].dataType, parent.schema[parent_key].dataType
    if kinds[0] != kinds[1]:
        raise ValueError(f"{key} is {kinds[0]}, but {parent_key} is {kinds[1]}")
    clash = {SALT, "_hot_key", "_tasks"} & {*child.columns, *parent.columns}
    if clash:
        raise ValueError(f"columns named {sorted(clash)} are in the way")
    hot = hot_keys(child, key, rows_per_task)
    keyless = child.where(F.col(key).isNull()).count()
    saved = Bucketed(*names, key, parent_key, hot is not None or keyless > rows_per_task)
    if saved.salted:
        # Rows without a key match nothing, so they may lie anywhere.
        nulls = max(1, -(-keyless // rows_per_task))
        child = _salted(child, key, hot, _any_salt(row_id), nulls)
        parent = _salted(parent, parent_key, hot, _every_salt, 1)
    save_table(child, saved.child, buckets=buckets, bucket_by=saved.by)
    save_table(parent, saved.parent, buckets=buckets, bucket_by=saved.parent_by)
    return saved


def bucketed_lookup(spark: SparkSession, saved: Bucketed, columns: Sequence[str]) -> DataFrame:
    """Left join a few parent columns onto every child row, bucket by bucket."""
    child = spark.table(saved.child)
    parent = spark.table(saved.parent).select(
        *(F.col(c).alias(f"_parent{i}") for i, c in enumerate(saved.parent_by)), *columns
    )
    joined = child.join(parent, _same(child, parent, saved.by), "left")
    return joined.select(*(child[c] for c in child.columns if c != SALT), *columns)


def bucketed_orphans(spark: SparkSession, saved: Bucketed) -> DataFrame:
    """The child keys without a parent, and how many rows hold each.

    Rows are counted and compared where they lie.  Only with hot keys are the orphans' counts,
    one row per key and salt, summed once more.
    """
    child = spark.table(saved.child).where(F.col(saved.key).isNotNull())
    used = child.groupBy(*saved.by).agg(F.count("*").alias("child_rows"))
    parent = spark.table(saved.parent).select(
        *(F.col(c).alias(f"_parent{i}") for i, c in enumerate(saved.parent_by))
    )
    orphans = used.join(parent, _same(used, parent, saved.by), "left_anti")
    if not saved.salted:
        return orphans
    return orphans.groupBy(saved.key).agg(F.sum("child_rows").alias("child_rows"))


def _same(child: DataFrame, parent: DataFrame, by: Sequence[str]) -> Column:
    same = F.lit(True)
    for i, column in enumerate(by):
        same = same & (child[column] == parent[f"_parent{i}"])
    return same


def _any_salt(row_id: str) -> Callable[[Column], Column]:
    """One of a key's salts, by the row's id: a retried task deals its rows the same way."""
    return lambda tasks: F.pmod(F.xxhash64(row_id), tasks).cast("int")


def _every_salt(tasks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), tasks - 1))


def _salted(
    df: DataFrame,
    key: str,
    hot: DataFrame | None,
    salt: Callable[[Column], Column],
    keyless: int,
) -> DataFrame:
    """The rows with their salt: 0 for all but the hot keys, and rows without a key if many."""
    tasks = F.when(F.col(key).isNull(), F.lit(keyless)).otherwise(F.lit(1))
    if hot is None:
        return df.select("*", salt(tasks).alias(SALT))
    hot = F.broadcast(hot) if is_small(hot) else hot
    tasks = F.coalesce(F.col("_tasks").cast("int"), tasks)
    joined = df.join(hot, df[key] == hot["_hot_key"], "left")
    return joined.select(*(df[c] for c in df.columns), salt(tasks).alias(SALT))
