"""Bucketed children and parents: whole results, no exchange of the child, hot and missing keys."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerweave.operators.buckets import bucketed_lookup, bucketed_orphans, save_bucketed
from ledgerweave.sources.tables import save_table, scratch_table

ROWS = 6_000


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def children(spark):
    """A third of the rows of one key, a tenth without any, some keys without a parent."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 != 1, F.col("id") % 500)
    return spark.range(ROWS).select("id", key.cast("bigint").alias("k"))


def parents(spark):
    return spark.range(400).select(F.col("id").alias("pk"), (F.col("id") * 2).alias("v"))


def saved(spark, rows_per_task, buckets=4):
    names = scratch_table("child"), scratch_table("parent")
    return save_bucketed(
        children(spark), parents(spark), ("k", "pk"), "id", names, buckets, rows_per_task
    )


@pytest.mark.parametrize("rows_per_task", [10**6, 300, 1])
def test_lookup_and_orphans_are_whole(spark, no_broadcast, rows_per_task):
    tables = saved(spark, rows_per_task)
    assert tables.salted == (rows_per_task < ROWS)
    keys = {r.id: r.k for r in children(spark).collect()}
    found = bucketed_lookup(spark, tables, ["v"])
    assert found.columns == ["id", "k", "v"]
    expected = sorted(
        (i, k, k * 2 if k is not None and k < 400 else None) for i, k in keys.items()
    )
    assert sorted(tuple(r) for r in found.collect()) == expected
    orphans = Counter(k for k in keys.values() if k is not None and k >= 400)
    assert {r.k: r.child_rows for r in bucketed_orphans(spark, tables).collect()} == orphans


def test_no_exchange_of_the_child(spark, no_broadcast, physical_plan):
    plain = saved(spark, 10**6)
    assert "Exchange" not in physical_plan(bucketed_lookup(spark, plain, ["v"]))
    assert "Exchange" not in physical_plan(bucketed_orphans(spark, plain))
    salted = saved(spark, 300)
    assert "Exchange" not in physical_plan(bucketed_lookup(spark, salted, ["v"]))
    # Only the orphans' counts move, above the join.
    plan = physical_plan(bucketed_orphans(spark, salted))
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("LeftAnti")


def test_a_hot_key_is_dealt_over_the_buckets(spark):
    tables = saved(spark, 300, buckets=8)
    table = spark.table(tables.child)
    per_file = table.groupBy(F.input_file_name()).count().collect()
    assert len(per_file) <= 8  # one file a bucket
    hot = table.where("k = 7").groupBy("_salt").count().collect()
    assert len(hot) == -(-sum(r["count"] for r in hot) // 300)


def test_empty_tables_and_repeated_parents(spark):
    names = scratch_table("child"), scratch_table("parent")
    empty = save_bucketed(
        children(spark).limit(0), parents(spark), ("k", "pk"), "id", names, 2
    )
    assert bucketed_lookup(spark, empty, ["v"]).count() == 0
    assert bucketed_orphans(spark, empty).count() == 0
    names = scratch_table("child"), scratch_table("parent")
    twice = parents(spark).unionAll(parents(spark)).where("pk = 7")
    both = save_bucketed(children(spark), twice, ("k", "pk"), "id", names, 2, 300)
    assert bucketed_lookup(spark, both, ["v"]).where("k = 7").count() == 2 * sum(
        r.k == 7 for r in children(spark).collect()
    )


def test_refusals(spark):
    names = scratch_table("child"), scratch_table("parent")
    text = parents(spark).withColumn("pk", F.col("pk").cast("string"))
    with pytest.raises(ValueError, match="pk"):
        save_bucketed(children(spark), text, ("k", "pk"), "id", names, 2)
    clash = children(spark).withColumn("_salt", F.lit(1))
    with pytest.raises(ValueError, match="_salt"):
        save_bucketed(clash, parents(spark), ("k", "pk"), "id", names, 2)
    with pytest.raises(ValueError, match="catalog"):
        save_table(parents(spark), "/nowhere/table", buckets=2, bucket_by=["pk"])
