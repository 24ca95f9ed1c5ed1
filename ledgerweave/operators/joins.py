"""Joining a fact to its parents: broadcast below a checked size, hot keys split above it."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.sources.tables import read_table, save_table, scratch_path

MAX_BROADCAST_BYTES = 64 << 20
#: Rows of one key that one task joins; a hotter key is dealt over several.
ROWS_PER_TASK = 2_000_000
#: Rough width of a row's columns beside their text, as a hash table holds it.
ROW_BYTES = 40


class Lookup(NamedTuple):
    """Some columns of a parent, for the child rows whose key equals the parent's."""

    parent: DataFrame
    child_key: str
    parent_key: str
    columns: Sequence[str]


def is_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the rows take at most ``max_bytes``, by their number and their texts' lengths."""
    texts = sum(
        (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns),
        F.lit(ROW_BYTES),
    )
    return (df.agg(F.sum(texts.cast("bigint"))).first()[0] or 0) <= max_bytes


def lookup(
    child: DataFrame,
    parent: DataFrame,
    on: tuple[str, str],
    columns: Sequence[str],
    row_id: str,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join a few parent columns onto every child row.

    ``on`` is (child column, parent key); ``row_id`` is unique per child row.
    """
    step = Lookup(parent, *on, columns)
    return lookups(child, [step], row_id, max_broadcast_bytes, rows_per_task)


def lookups(
    child: DataFrame,
    steps: Sequence[Lookup],
    row_id: str,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Several left joins onto the same child rows, whose keys the child itself has.

    A parent whose measured size is within the bound is broadcast.  For a larger one the
    child's keys are counted first; without a hot key it is an ordinary join, which adaptive
    execution may still split.  Each step adds the child's plan once, however many there are.
    """
    joined = child
    for step in steps:
        attributes = step.parent.select(F.col(step.parent_key).alias("_parent_key"), *step.columns)
        if is_small(attributes, max_broadcast_bytes):
            attributes, hot = F.broadcast(attributes), None
        else:
            hot = hot_keys(child, step.child_key, rows_per_task)
        if hot is None:
            same = joined[step.child_key] == attributes["_parent_key"]
            joined = joined.join(attributes, same, "left").drop("_parent_key")
        else:
            joined = _split_join(joined, attributes, step.child_key, row_id, hot)
    return joined


def hot_keys(child: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """(key, tasks) of the keys with more rows than one task takes; None if there are none.

    There are at most rows / rows_per_task of them.  They are written once, so that the
    counting isn't part of any later plan.
    """
    counted = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot_key"))
    hot = counted.agg(F.count("*").alias("_rows")).where(F.col("_rows") > rows_per_task)
    tasks = F.ceil(F.col("_rows") / rows_per_task).cast("bigint").alias("_tasks")
    spark, path = child.sparkSession, scratch_path(child.sparkSession, "hot_keys")
    save_table(hot.select("_hot_key", tasks), path)
    written = read_table(spark, path)
    return written if written.count() else None


def _split_join(
    child: DataFrame, parent: DataFrame, key: str, row_id: str, hot: DataFrame
) -> DataFrame:
    """Left join that deals each hot key over its tasks, and the parent's row to each of them.

    The salt is a hash of the row id: a retried task deals its rows the same way.
    """
    tasks = F.coalesce(F.col("_tasks"), F.lit(1).cast("bigint"))
    salted_child = child.join(hot, child[key] == hot["_hot_key"], "left").select(
        child["*"], F.pmod(F.xxhash64(child[row_id]), tasks).alias("_salt")
    )
    salted_parent = parent.join(hot, parent["_parent_key"] == hot["_hot_key"], "left").select(
        parent["*"],
        F.explode(F.sequence(F.lit(0).cast("bigint"), tasks - 1)).alias("_parent_salt"),
    )
    return salted_child.join(
        salted_parent,
        (salted_child[key] == salted_parent["_parent_key"])
        & (salted_child["_salt"] == salted_parent["_parent_salt"]),
        "left",
    ).drop("_parent_key", "_salt", "_parent_salt")
