"""Foreign-key assignment and the parent join, with hot, missing and repeated keys."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from ledgerweave.functions.pools import SECURITY_REGIONS
from ledgerweave.functions.rng import RowRandom
from ledgerweave.operators import fk
from ledgerweave.operators.joins import Lookup, hot_keys, is_small, lookup, lookups


def test_dense_ordinals_number_the_distinct_keys(spark):
    keys = [f"k{i * i}" for i in range(500)]
    rows = [(k,) for k in keys] + [("k4",)] * 700 + [(None,)]
    found = []
    for partitions in (1, 7):
        parent = spark.createDataFrame(rows, "k string").repartition(partitions)
        found.append({r.k: r.ordinal for r in fk.dense_ordinals(parent, "k").collect()})
    assert found[0] == found[1]
    assert sorted(found[0].values()) == list(range(1, 501))


def test_every_child_gets_an_existing_key(spark):
    parent = spark.range(50).select((F.col("id") * 3).alias("pk")).where("pk % 2 = 0")
    child = spark.range(0, 5_000, 1, 3).select(F.col("id").alias("row"))
    assigned = fk.assign_parent_key(child, parent, "pk", RowRandom("row"), "parent", "fk")
    counts = Counter(r.fk for r in assigned.collect())
    assert sum(counts.values()) == 5_000
    assert set(counts) == {3 * i for i in range(50) if i % 2 == 0}
    assert min(counts.values()) > 120
    again = fk.assign_parent_key(
        child.repartition(5), parent.repartition(2), "pk", RowRandom("row"), "parent", "fk"
    )
    assert again.exceptAll(assigned).count() == 0


def test_no_parent_leaves_the_key_empty(spark):
    parent = spark.range(0).select(F.col("id").alias("pk"))
    child = spark.range(3).select(F.col("id").alias("row"))
    assigned = fk.assign_parent_key(child, parent, "pk", RowRandom("row"), "parent", "fk")
    assert [r.fk for r in assigned.collect()] == [None] * 3


def test_dense_key_range_and_cyclic(spark):
    random = RowRandom("id")
    low, high, n = (
        spark.range(10_000)
        .select(fk.dense_key(random, "s", 7).alias("k"))
        .agg(F.min("k"), F.max("k"), F.count_distinct("k"))
        .first()
    )
    assert (low, high, n) == (1, 7, 7)
    cyclic = spark.range(5).select(fk.dense_key(random, "s", 3, cyclic=True)).collect()
    assert [r[0] for r in cyclic] == [1, 2, 3, 1, 2]


def test_literal_table_and_distincts(spark):
    table = fk.literal_table(spark, SECURITY_REGIONS)
    assert [r.value for r in table.orderBy("position").collect()] == list(SECURITY_REGIONS)
    df = spark.createDataFrame([(202001,), (202013,), (202101,), (None,)], "p int")
    assert {r.p for r in fk.distinct_values(df, "p").collect()} == {202001, 202013, 202101}
    years = fk.fiscal_years_in(df.where("p is not null"), "p").collect()
    assert {r[0] for r in years} == {2020, 2021}


def hot_child(spark):
    """6000 rows; a third hold key 1, some hold no key or one without a parent."""
    key = (
        F.when(F.col("id") % 3 == 0, 1)
        .when(F.col("id") % 100 == 1, None)
        .when(F.col("id") % 100 == 2, -5)
        .otherwise(F.col("id") % 4_000)
    )
    return spark.range(6_000).select("id", key.alias("k"))


def test_split_join_equals_a_plain_left_join(spark):
    child = hot_child(spark)
    parent = spark.range(4_000).select(
        F.col("id").alias("pk"), F.concat(F.lit("v"), F.col("id")).alias("v")
    )
    split = lookup(child, parent, ("k", "pk"), ["v"], "id", 0, rows_per_task=500)
    plain = child.join(parent, child["k"] == parent["pk"], "left").drop("pk")
    assert split.columns == plain.columns
    assert split.count() == 6_000
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_a_hot_key_gets_as_many_tasks_as_its_rows_need(spark):
    child = hot_child(spark)
    assert [tuple(r) for r in hot_keys(child, "k", 500).collect()] == [(1, 4)]
    assert hot_keys(child, "k", 5_000) is None
    parent = spark.range(4_000).select(F.col("id").alias("pk"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup(child, parent, ("k", "pk"), [], "id", 0, rows_per_task=500)
        tasks = joined.where("k = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert 3 <= len(tasks) <= 4
    assert sum(r[1] for r in tasks) == child.where("k = 1").count()


def test_lookup_broadcasts_only_within_the_bound(spark, physical_plan):
    child = hot_child(spark)
    parent = spark.range(100).select(F.col("id").alias("pk"), (F.col("id") * 2).alias("twice"))
    small = lookup(child, parent, ("k", "pk"), ["twice"], "id")
    large = lookup(child, parent, ("k", "pk"), ["twice"], "id", 99, rows_per_task=500)
    assert "BroadcastHashJoin" in physical_plan(small)
    assert "_salt" in physical_plan(large)
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0


def test_chained_lookups_hold_the_child_once(spark, physical_plan, tmp_path):
    hot_child(spark).withColumns({f"k{i}": F.col("k") + i for i in range(5)}).write.parquet(
        f"{tmp_path}/child"
    )
    child = spark.read.parquet(f"{tmp_path}/child")
    parent = spark.range(4_000).select(F.col("id").alias("pk"), (F.col("id") * 2).alias("v"))
    steps = [
        Lookup(parent.withColumnRenamed("v", f"v{i}"), f"k{i}", "pk", [f"v{i}"]) for i in range(5)
    ]
    joined = lookups(child, steps, "id", 0, rows_per_task=500)
    # Only the child's scan reads k1; paths may be shortened in a plan.
    scans = [s for s in physical_plan(joined).split("ReadSchema: ")[1:] if "k1:" in s.split(">")[0]]
    assert len(scans) == 1
    first = joined.where("k = 7").select(*(f"v{i}" for i in range(5))).first()
    assert tuple(first) == (14, 16, 18, 20, 22)


def test_is_small_measures_texts_too(spark):
    assert is_small(spark.range(10), 10 * 60) and not is_small(spark.range(1_000), 10 * 60)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1_000).alias("s"))
    assert not is_small(wide, 10 * 60)
