"""Parent chains of a hierarchy: closure, depth and cycles, by a recursive query.

A hierarchy's edges are rows (hierarchy, child, parent).  A parent without an edge of its own,
or with a null parent, is a root; repeated edges count once and edges without a child not at all.
A node may have several parents: every path is followed, so nested diamonds multiply.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.sources.tables import read_table, save_table, scratch_path

EDGE = "hierarchy", "child", "parent"
#: The closing edge of a cycle is followed once and no further, so the recursion always ends.
CHAINS = """
with recursive chain (hierarchy, node, ancestor, distance, path, closed) as (
  select hierarchy, child, parent, 1, array(child, parent), child = parent
  from {edges} where parent is not null
  union all
  select c.hierarchy, c.node, e.parent, c.distance + 1, array_append(c.path, e.parent),
         array_contains(c.path, e.parent)
  from chain c join {edges} e on e.hierarchy = c.hierarchy and e.child = c.ancestor
  where not c.closed and e.parent is not null
)
select hierarchy, node, ancestor, distance, closed from chain
"""


def parent_edges(df: DataFrame, name: str, child: str, parent: str) -> DataFrame:
    """The edges of a table that names each row's parent."""
    return df.select(
        F.lit(name).alias("hierarchy"),
        F.col(child).cast("string").alias("child"),
        F.col(parent).cast("string").alias("parent"),
    )


def level_edges(df: DataFrame, name: str, stem: str, levels: int) -> DataFrame:
    """The edges between the nodes on adjacent levels of a table with a column for each level.

    One pass, in which a row becomes one edge a level; level 1 is the coarsest.
    """
    node = [F.col(f"{stem}{level}_cd") for level in range(1, levels + 1)]
    above = [F.lit(None).cast("string"), *node[:-1]]
    pairs = F.array(*(F.struct(n.alias("child"), p.alias("parent")) for n, p in zip(node, above)))
    exploded = df.select(F.explode(pairs).alias("edge"))
    return exploded.select(F.lit(name).alias("hierarchy"), "edge.child", "edge.parent").distinct()


def closure(edges: DataFrame) -> DataFrame:
    """Each node with every ancestor: (hierarchy, node, ancestor, distance, closed).

    ``distance`` is the shortest way up, ``closed`` whether a way to that ancestor met a node
    again; a node on a cycle is an ancestor of itself.  The edges are written first, since each
    step of the recursion reads them.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    save_table(edges.select(*EDGE).where(F.col("child").isNotNull()).distinct(), path)
    chains = spark.sql(CHAINS, edges=read_table(spark, path))
    return chains.groupBy("hierarchy", "node", "ancestor").agg(
        F.min("distance").alias("distance"), F.bool_or("closed").alias("closed")
    )


def node_report(edges: DataFrame) -> DataFrame:
    """One row per node, roots included: its depth, how many ancestors it has, and its state.

    ``depth`` is the distance of the farthest ancestor by the shortest way, 0 for a root and
    null where a cycle is met; ``state`` is root, chain, cycle (on one) or into cycle.
    """
    ends = [edges.select("hierarchy", F.col(end).alias("node")) for end in EDGE[1:]]
    nodes = reduce(DataFrame.unionAll, ends).where(F.col("node").isNotNull()).distinct()
    above = (
        closure(edges)
        .groupBy("hierarchy", "node")
        .agg(
            F.max("distance").alias("_depth"),
            F.count_if(F.col("ancestor") != F.col("node")).alias("_ancestors"),
            F.bool_or(F.col("ancestor") == F.col("node")).alias("_on"),
            F.bool_or("closed").alias("_closed"),
        )
    )
    state = (
        F.when(F.col("_depth").isNull(), "root")
        .when(F.col("_on"), "cycle")
        .when(F.col("_closed"), "into cycle")
        .otherwise("chain")
    )
    depth = F.when(~F.coalesce("_closed", F.lit(False)), F.coalesce("_depth", F.lit(0)))
    return nodes.join(above, ["hierarchy", "node"], "left").select(
        "hierarchy",
        "node",
        depth.alias("depth"),
        F.coalesce("_ancestors", F.lit(0)).cast("bigint").alias("ancestor_cnt"),
        state.alias("state"),
    )
