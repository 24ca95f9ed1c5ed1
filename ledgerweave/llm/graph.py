"""Connected components of a large graph, and streaming over sorted groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id reachable, for every node of an edge (a, b).

    Large star and small star by turns: each links neighbours to the smallest id around, so
    the edges become one star per component after a logarithmic number of rounds.  Each round
    is a written table; nothing but its size and checksum reaches the driver.
    """
    links = edges.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    links = written(links.distinct(), "edges")
    mark = _checksum(links)
    while mark[0]:
        links = written(_small_star(_large_star(links)), "edges")
        before, mark = mark, _checksum(links)
        if before == mark:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _checksum(links: DataFrame) -> tuple[int, int]:
    hashed = F.sum(F.xxhash64("u", "v") % (1 << 31))
    count, total = links.agg(F.count("*"), hashed).first()
    return count, total or 0


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # Read back, the join has exchanges of its own on both sides, so a centre with very many
    # neighbours can be split over several tasks.
    least = written(least, "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    links = written(links.where("u != v").distinct(), "star")
    least = written(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    others = links.join(least, "u").where("v != m")
    moved = others.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Those of the edges that first join two parts: at most one fewer than the nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, right = [], []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            left.append(x)
            right.append(y)
    return left, right


def grouped(
    batches: Iterator[pa.RecordBatch], keys: int
) -> Iterator[tuple[tuple[int, ...], pa.Table]]:
    """Groups of rows that follow one another with equal first ``keys`` long columns."""
    held: list[pa.Table] = []
    held_key: tuple[int, ...] | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = np.stack([batch.column(i).to_numpy() for i in range(keys)])
        edges = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(0)) + 1
        table = pa.Table.from_batches([batch])
        for start, end in zip([0, *edges], [*edges, batch.num_rows]):
            key = tuple(int(c) for c in columns[:, start])
            if held_key is not None and key != held_key:
                yield held_key, pa.concat_tables(held)
                held = []
            held_key = key
            held.append(table.slice(start, end - start))
    if held_key is not None:
        yield held_key, pa.concat_tables(held)


def block_pairs(rows: DataFrame, group: str, node: str, size: str, most: int) -> DataFrame:
    """Each row once for every pair of blocks of its group that holds its own block.

    A group of ``size`` rows has about size / most blocks, dealt by a hash of the node.  The
    columns group, i and j come first and name one comparison of two blocks; ``own`` is the
    row's block.  No task ever holds more than two blocks.
    """
    blocks = F.ceil(F.col(size) / most).cast("long")
    own = F.pmod(F.xxhash64(node), blocks)
    dealt = rows.withColumn("_blocks", blocks).withColumn("own", own)
    every = F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)
    dealt = dealt.withColumn("other", F.explode(every))
    rest = [c for c in rows.columns if c not in (group, size)]
    i, j = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    return dealt.select(group, i, j, "own", *rest)
