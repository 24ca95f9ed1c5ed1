"""Assigning each child row a parent key.

* ``dense_key``: the parent's ids run 1..n, so the key is arithmetic on the row id.  A key
  that is a formula of a dense id (``functions.keys``) is that formula of ``dense_key``.
* ``assign_parent_key``: the parent has arbitrary keys.  They are numbered densely and
  joined on the number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerweave.functions.rng import RowRandom

_HASH_DIGITS = 3  # 4096 buckets, each sorted on its own


def dense_key(random: RowRandom, salt: str, n: int | Column, cyclic: bool = False) -> Column:
    """A key in 1..n: drawn from the salt's stream, or the row id modulo n."""
    position = F.pmod(random.row, F.lit(n)) if cyclic else random.index(salt, n)
    return position + F.lit(1)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-null values of a column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def fiscal_years_in(df: DataFrame, period: str) -> DataFrame:
    """The distinct fiscal years of a column of period numbers."""
    return df.select(F.floor(F.col(period) / 100).cast("int").alias("fiscal_year")).distinct()


def dense_ordinals(parent: DataFrame, key: str) -> DataFrame:
    """Number the distinct keys 1..n in the order of their hash.

    Keys are bucketed by a hash prefix, numbered inside their bucket and shifted by the
    size of the earlier buckets.  No task sees more than one bucket, the order does not
    depend on partitioning or on sampled boundaries, and only the at most 4096 bucket
    sizes are gathered in one place.
    """
    keys = distinct_values(parent, key).withColumn("_hash", F.md5(F.col(key).cast("string")))
    hashed = keys.withColumn("_bucket", F.substring("_hash", 1, _HASH_DIGITS))
    in_bucket = Window.partitionBy("_bucket").orderBy("_hash", key)
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hashed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    offsets = offsets.select(
        "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        hashed.withColumn("_position", F.row_number().over(in_bucket))
        .join(F.broadcast(offsets), "_bucket", "left")
        .select((F.col("_offset") + F.col("_position")).alias("ordinal"), key)
    )


def assign_parent_key(
    child: DataFrame, parent: DataFrame, key: str, random: RowRandom, salt: str, name: str
) -> DataFrame:
    """Add column ``name``: a key of ``parent`` drawn uniformly for every child row.

    Drawn ordinals are uniform whatever the keys look like, so the join has no hot key.
    Whether the parent is broadcast is left to its measured size.
    """
    parents = dense_ordinals(parent, key)
    n = distinct_values(parent, key).agg(F.count("*")).scalar()
    drawn = child.withColumn("_ordinal", dense_key(random, salt, n))
    numbered = parents.select("ordinal", F.col(key).alias(name))
    return drawn.join(numbered, drawn["_ordinal"] == numbered["ordinal"], "left").drop(
        "_ordinal", "ordinal"
    )


def literal_table(spark: SparkSession, values: Sequence) -> DataFrame:
    """A driver-side list as a table of positions, from 0, and values."""
    rows = [(position, str(value)) for position, value in enumerate(values)]
    return spark.createDataFrame(rows, "position bigint not null, value string")
