"""Near-duplicate vectors by NN-descent, with an audit of its recall."""

from __future__ import annotations

import functools
import logging
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.llm.common import hash_sample, written
from ledgerweave.llm.graph import block_pairs, components, forest, grouped

logger = logging.getLogger(__name__)

THRESHOLD = 0.9
#: Similarities of lists are single precision; a link this far below is still looked at.
MARGIN = 1e-3
NEIGHBOURS = 6
#: Two vectors at the threshold lie on one side of a random plane with this chance.
SIDE = 1 - math.acos(THRESHOLD) / math.pi
#: So many tables are drawn that these two share a bucket with this chance, at any size.
MEET = 0.99
BUCKET = 64
BLOCK = 256
#: Vectors of an audit: at first, at most, and the links in small groups that are evidence enough.
AUDITED, MOST_AUDITED = 256, 4096
EVIDENCE, SMALL = 100, 64
RECALL = 0.97
#: Vectors with a neighbour so far below the threshold are audited besides those drawn from all.
LIKELY = 0.05
#: Draws in a row that may join nothing new while the audit still misses links.
BARREN = 2
LIST = "array<struct<sim: float, node: long, other: boolean>>"


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(node, unit): each usable vector at length one, as packed doubles.

    Null, zero and non-finite vectors are left out, and rows without an id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, units = [], []
            for node, row in zip(*(c.to_pylist() for c in batch.columns)):
                if not row or any(v is None for v in row):
                    continue
                vector = np.array(row, np.float64)
                # Scaled first, so that no square overflows.
                top = np.abs(vector).max()
                if np.isfinite(vector).all() and top > 0:
                    vector /= top
                    nodes.append(node)
                    # Zeros without a sign, so that equal vectors have equal bytes.
                    units.append((vector / np.linalg.norm(vector) + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(units, pa.binary())], ["node", "unit"]
            )

    chosen = vectors.where("vec_id is not null").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    )
    return chosen.mapInArrow(run, "node long, unit binary").groupBy("node").agg(
        F.min("unit").alias("unit")
    )


def collapsed(vectors: DataFrame) -> DataFrame:
    """(unit, node, weight): each distinct vector once, by its least id, and how many it is."""
    return vectors.groupBy("unit").agg(F.min("node").alias("node"), F.count("*").alias("weight"))


def unpacked(column: pa.ChunkedArray) -> np.ndarray:
    """Packed vectors of one length as rows."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def table_count(bits: int) -> int:
    """Tables of ``bits`` planes in which a pair at the threshold meets with chance MEET."""
    return math.ceil(math.log(1 - MEET) / math.log1p(-(SIDE**bits)))


def signs(units: DataFrame, round_: int, bits: int) -> DataFrame:
    """(table, key, node): on which sides of random planes a vector lies, for each table."""

    tables = table_count(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            packed = batch.column("unit").to_pylist()
            for i, p in enumerate(packed):
                by_size.setdefault(len(p), []).append(i)
            for size, rows in by_size.items():
                vectors = np.frombuffer(b"".join(packed[i] for i in rows)).reshape(len(rows), -1)
                nodes = batch.column("node").to_numpy()[rows]
                planes = np.random.default_rng([round_, size]).normal(
                    size=(vectors.shape[1], tables * bits)
                )
                sides = (vectors @ planes > 0).reshape(len(rows), tables, bits)
                keys = sides @ (1 << np.arange(bits)) * 4096 + size // 8 % 4096
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(tables), len(rows))),
                        pa.array(keys.ravel()),
                        pa.array(np.repeat(nodes, tables)),
                    ],
                    ["table", "key", "node"],
                )

    return units.mapInArrow(run, "table long, key long, node long")


def spanning(close: np.ndarray) -> tuple[list[int], list[int]]:
    """A forest that joins what a symmetric matrix of links joins."""
    unseen = close.any(1)
    left, right = [], []
    while unseen.any():
        frontier = [int(np.argmax(unseen))]
        unseen[frontier] = False
        while frontier:
            p = frontier.pop()
            new = np.flatnonzero(close[p] & unseen).tolist()
            unseen[new] = False
            left += [p] * len(new)
            right += new
            frontier += new
    return left, right


def nearest_in_groups(members: DataFrame, located: DataFrame) -> DataFrame:
    """Rows (node, list, joined) from comparing all vectors of each group (a, b, c).

    A list holds the nearest others of a member; a full member has a second one, of the nearest
    outside its own cluster.  Rows with ``joined`` are a forest of every link that was seen, so
    that none is lost to the length of a list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in grouped(batches, 3):
            nodes = table.column("node").to_numpy()
            if len(nodes) < 2:
                continue
            vectors = unpacked(table.column("unit")).astype(np.float32)
            similar = vectors @ vectors.T
            np.fill_diagonal(similar, -2)
            width = min(NEIGHBOURS, len(nodes) - 1)
            owners, sims, others, apart = [], [], [], []
            full = np.flatnonzero(table.column("full").to_numpy())
            component = table.column("component").to_numpy()
            foreign = component[full][:, None] != component
            every = np.arange(len(nodes))
            for rows, found in ((every, similar), (full, np.where(foreign, similar[full], -2))):
                best = np.argpartition(-found, width - 1, axis=1)[:, :width]
                values = np.take_along_axis(found, best, 1)
                x, y = np.nonzero(values > -1.5)
                owners.append(rows[x])
                sims.append(values[x, y])
                others.append(best[x, y])
                apart.append(np.full(len(x), found is not similar))
            owner = np.concatenate(owners) + len(nodes) * np.concatenate(apart)
            entries = pa.StructArray.from_arrays(
                [
                    pa.array(np.round(np.concatenate(sims), 4), pa.float32()),
                    pa.array(nodes[np.concatenate(others)]),
                    pa.array(np.concatenate(apart)),
                ],
                ["sim", "node", "other"],
            )
            listed, starts = np.unique(owner, return_index=True)
            offsets = pa.array(np.append(starts, len(owner)).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, entries)
            # Every entry that rounding lifts to the threshold of close_entries is joined, too.
            left, right = spanning(similar >= THRESHOLD - MARGIN - 1e-4)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes[[*(listed % len(nodes)), *left]]),
                    pa.concat_arrays([lists, pa.nulls(len(left), lists.type)]),
                    pa.array([*[None] * len(listed), *nodes[right].tolist()], pa.int64()),
                ],
                ["node", "list", "joined"],
            )

    keys = ["a", "b", "c"]
    rows = members.join(located, "node").select(*keys, "node", "unit", "component", "full")
    # Vectors of different lengths never share a group.
    rows = rows.withColumn("c", F.col("c") * 65536 + F.octet_length("unit") / 8).withColumn(
        "c", F.col("c").cast("long")
    )
    return (
        rows.repartition(*keys)
        .sortWithinPartitions(*keys, "node")
        .mapInArrow(run, f"node long, list {LIST}, joined long")
    )


def merged(lists: DataFrame) -> DataFrame:
    """One list per node: of all its lists the nearest, and the nearest outside its cluster."""

    def plain(entry: Column) -> Column:
        return F.struct(
            entry["sim"].alias("sim"), entry["node"].alias("node"), F.lit(False).alias("other")
        )

    def nearest(entries: Column) -> Column:
        return F.slice(F.sort_array(F.array_distinct(entries), asc=False), 1, NEIGHBOURS)

    together = lists.groupBy("node").agg(F.flatten(F.collect_list("list")).alias("list"))
    near = nearest(F.transform("list", plain))
    far = nearest(F.filter("list", lambda entry: entry["other"]))
    return together.select("node", F.concat(near, far).alias("list"))


def in_buckets(located: DataFrame, round_: int, count: int) -> DataFrame:
    """Rows from comparing the vectors of each bucket, those on the same sides of random planes.

    Buckets over the block size are dealt into blocks; what a block parts, the rounds and the
    comparison within components bring together.
    """
    bits = max(1, min(30, math.ceil(math.log2(max(2, count / BUCKET)))))
    keys = written(signs(located.select("node", "unit"), round_, bits), "keys")
    sizes = keys.groupBy("table", "key").agg(F.count("*").alias("size"))
    large = sizes.where(F.col("size") > BLOCK)
    dealt = keys.join(large, ["table", "key"], "left")
    block = F.pmod(
        F.xxhash64("node", "table"), F.ceil(F.coalesce("size", F.lit(1)) / BLOCK).cast("long")
    )
    members = dealt.select(
        "node", F.col("table").alias("a"), F.col("key").alias("b"), block.alias("c")
    )
    return nearest_in_groups(members, located)


def around(lists: DataFrame, located: DataFrame) -> DataFrame:
    """Rows from comparing, around each node, its neighbours and those that list it."""
    edges = lists.select(F.col("node").alias("centre"), F.explode("list").alias("to")).select(
        "centre", F.col("to.node").alias("node"), "to.sim", "to.other"
    )
    by_sim = Window.partitionBy("node", "other").orderBy(F.desc("sim"), "centre")
    back = edges.withColumn("rank", F.row_number().over(by_sim)).where(F.col("rank") <= NEIGHBOURS)
    back = back.select(F.col("node").alias("centre"), F.col("centre").alias("node"))
    own = lists.select(F.col("node").alias("centre"), "node")
    members = edges.select("centre", "node").union(back).union(own).distinct()
    zero = F.lit(0).cast("long")
    return nearest_in_groups(
        members.select("node", F.col("centre").alias("a"), zero.alias("b"), zero.alias("c")),
        located,
    )


def close_entries(lists: DataFrame) -> DataFrame:
    """(node, other): the entries of the lists that may be links."""
    pairs = lists.select("node", F.explode("list").alias("to"))
    return pairs.where(F.col("to.sim") >= THRESHOLD - MARGIN).select("node", "to.other")


def placed(units: DataFrame, clusters: DataFrame, lists: DataFrame) -> DataFrame:
    """The vectors with their cluster and whether their list is full of links."""
    close = close_entries(lists).where("not other").groupBy("node").agg(F.count("*").alias("n"))
    joined = units.join(clusters, "node", "left").join(close, "node", "left")
    return joined.select(
        "node",
        "unit",
        F.coalesce("component", "node").alias("component"),
        F.coalesce(F.col("n") >= NEIGHBOURS, F.lit(False)).alias("full"),
    )


def links_within(clusters: DataFrame, units: DataFrame) -> DataFrame:
    """Rows (a, b, links) from comparing all vectors of each cluster in double precision.

    Forest edges have b; other rows count a node's links, equal vectors as many as they are.
    """
    sizes = clusters.groupBy("component").agg(F.count("*").alias("size"))
    rows = clusters.join(sizes, "component").join(units, "node")
    rows = rows.select("component", "node", "size", "unit", "weight")
    keyed = block_pairs(rows, "component", "node", "size", BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), table in grouped(batches, 3):
            nodes, own = table.column("node").to_numpy(), table.column("own").to_numpy()
            vectors = unpacked(table.column("unit"))
            p, q = np.flatnonzero(own == i), np.flatnonzero(own == j)
            linked = vectors[p] @ vectors[q].T >= THRESHOLD
            if i == j:
                linked = np.triu(linked, 1)
            x, y = np.nonzero(linked)
            links, weight = np.zeros(len(nodes), np.int64), table.column("weight").to_numpy()
            np.add.at(links, p[x], weight[q[y]])
            np.add.at(links, q[y], weight[p[x]])
            a, b = forest(nodes[p[x]], nodes[q[y]])
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.array(a, np.int64), nodes[some]])),
                    pa.array([*b, *[None] * len(some)], pa.int64()),
                    pa.array(np.concatenate([np.zeros(len(a), np.int64), links[some]])),
                ],
                ["a", "b", "links"],
            )

    keys = ["component", "i", "j"]
    return (
        keyed.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(run, "a long, b long, links long")
    )


class Audit(NamedTuple):
    """A recall, or None where too few links were seen to tell, and what it rests on."""

    recall: float | None
    links: int
    vectors: int

    @property
    def reached(self) -> bool:
        return self.recall is not None and self.recall >= RECALL


def lowest_recall(totals: np.ndarray, found: np.ndarray) -> float:
    """The least mean recall of vectors with about equally many links, or 1 without links.

    Each vector counts once, and vectors with few links apart from those with many, so that a
    large group can't hide what small ones lose.
    """
    totals, found = totals[totals > 0], found[totals > 0]
    classes = np.log2(totals).astype(int)
    shares = found / totals
    return min((float(shares[classes == c].mean()) for c in np.unique(classes)), default=1.0)


def audit(located: DataFrame, count: int, lists: DataFrame | None = None) -> Audit:
    """The lowest recall of links by brute force between some vectors and all.

    A link within a cluster is found, since all its pairs are compared.  Half of the vectors are
    drawn from all, half from those that ``lists`` show with a neighbour near the threshold,
    where links are likely.  More are drawn until small groups have shown enough links, up to
    MOST_AUDITED of each half; then the recall is unknown, unless every vector was audited.
    """
    likely = None
    if lists is not None:
        near = lists.where(F.exists("list", lambda to: to["sim"] >= THRESHOLD - LIKELY))
        likely = written(located.join(near.select("node"), "node", "left_semi"), "likely")
    likely_count = likely.count() if likely is not None else 0
    asked = AUDITED
    while True:
        chosen = hash_sample(located, "node", asked, count, seed=9)
        if likely is not None:
            chosen = chosen.union(hash_sample(likely, "node", asked, likely_count, seed=10))
        totals, found, drawn = counted(located, chosen.dropDuplicates(["node"]))
        evidence = int(totals[totals <= SMALL].sum())
        known = evidence >= EVIDENCE or drawn == count
        if known or asked >= MOST_AUDITED:
            return Audit(lowest_recall(totals, found) if known else None, evidence, drawn)
        asked = min(4 * asked, MOST_AUDITED)


def recaptured(edges: DataFrame, located: DataFrame, count: int) -> tuple[Audit, int]:
    """The share of a fresh draw's links that lay within the clusters before it, and the others.

    The draw's planes are independent of all earlier ones, so what it meets stands for all
    links.  Links of small clusters are judged apart, so that large ones can't hide them.
    """
    size = Window.partitionBy("component")
    at = located.select("node", "component")
    at = at.select("node", "component", (F.count("*").over(size) <= SMALL).alias("small"))
    a, b = F.least("node", "joined"), F.greatest("node", "joined")
    pairs = edges.select(a.alias("a"), b.alias("b")).distinct()
    pairs = pairs.join(at.toDF("a", "from", "small_from"), "a")
    pairs = pairs.join(at.toDF("b", "to", "small_to"), "b")
    sums = (
        pairs.groupBy((F.col("small_from") & F.col("small_to")).alias("small"))
        .agg(F.count("*").alias("met"), F.count_if(F.col("from") != F.col("to")).alias("new"))
        .collect()  # two rows
    )
    met, new = sum(r["met"] for r in sums), sum(r["new"] for r in sums)
    shares = [1 - r["new"] / r["met"] for r in sums if r["met"] >= EVIDENCE]
    known = min([*shares, 1 - new / met]) if met >= EVIDENCE else None
    return Audit(known, met, count), new


def counted(located: DataFrame, drawn: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Of some vectors the links with all others, those within the own cluster; how many."""
    chosen = drawn.collect()  # bounded
    by_size: dict[int, list[int]] = {}
    for i, r in enumerate(chosen):
        by_size.setdefault(len(r["unit"]), []).append(i)
    queries = {}
    for size, rows in by_size.items():
        packed = b"".join(bytes(chosen[i]["unit"]) for i in rows)
        queries[size] = (
            np.array(rows),
            np.array([chosen[i]["node"] for i in rows], np.int64),
            np.array([chosen[i]["component"] for i in rows], np.int64),
            np.frombuffer(packed).reshape(len(rows), -1),
        )

    asked_count = len(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.zeros(asked_count, np.int64)
        within = np.zeros(asked_count, np.int64)
        for batch in batches:
            packed, ids = batch.column("unit").to_pylist(), batch.column("node").to_numpy()
            components_ = batch.column("component").to_numpy()
            for size, (places, nodes, own, vectors) in queries.items():
                rows = np.array([i for i, p in enumerate(packed) if len(p) == size], np.int64)
                for at in range(0, len(rows), BLOCK):
                    part = rows[at : at + BLOCK]
                    others = np.frombuffer(b"".join(packed[i] for i in part))
                    linked = vectors @ others.reshape(len(part), -1).T >= THRESHOLD
                    linked &= nodes[:, None] != ids[part]
                    every[places] += linked.sum(1)
                    within[places] += (linked & (own[:, None] == components_[part])).sum(1)
        some = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(every[some]), pa.array(within[some])],
            ["query", "every", "within"],
        )

    parts = located.mapInArrow(run, "query long, every long, within long")
    sums = parts.groupBy("query").agg(F.sum("every"), F.sum("within")).collect()  # per query
    totals = np.array([r[1] for r in sums], np.int64)
    return totals, np.array([r[2] for r in sums], np.int64), asked_count


def near_vectors(vectors: DataFrame) -> DataFrame:
    """Links and components of vectors, as of ``search_vectors``, without its audit."""
    return search_vectors(vectors)[0]


def search_vectors(vectors: DataFrame) -> tuple[DataFrame, Audit]:
    """Links and components of vectors: vec_id, n_links, component_id, kept; and the recall.

    Two vectors are linked if their cosine is 0.9 or more in double precision.  Equal vectors
    are searched for as one.  Each vector starts with the nearest of a few hash buckets; then
    neighbours of neighbours are compared until the lists gain no more links.  A list full of
    links is enlarged by the nearest vectors of other clusters, and the search goes on, until no
    such list gains a link to another cluster.  Vectors joined by any link that was seen form
    clusters, all of whose pairs are compared.  Buckets are drawn in so many tables that a
    pair at the threshold meets with one chance at any size; a bucket over the block size is
    dealt out, which lowers it.  An audit compares some vectors with all; while any class of
    vectors by number of links is below its target, new buckets are drawn.  Where the audit meets
    too few links to tell, the next draw's links are the evidence; where these are few, too, the
    search ends with the first draw that joins nothing new, its recall unknown (None).  It also
    ends, with the recall it has, when further draws join nothing new.  Null, zero and non-finite
    vectors link with nothing.  Rows with one id are one vector, of which the least usable one counts.
    A row without an id is returned without links.  Equal vectors link like others.
    """
    rows = written(unit_vectors(vectors), "vectors")
    units = written(collapsed(rows), "units")
    count = units.count()
    start = units.select("node", "unit", F.col("node").alias("component"), F.lit(False).alias("full"))
    lists, clusters, located, round_ = None, None, start, 0
    result, barren = None, 0
    while True:
        seen = written(in_buckets(located, round_, count), "seen")
        round_ += 1
        fresh = None
        if result is not None:
            edges = seen.where("joined is not null").select("node", "joined")
            fresh, new = recaptured(edges, located, count)
            barren = 0 if new else barren + 1
        joined = [seen.where("joined is not null").select("node", "joined")]
        drawn = seen.where("list is not null").select("node", "list")
        if lists is not None:
            # What was outside a cluster then may be inside now.
            near = F.filter("list", lambda entry: ~entry["other"]).alias("list")
            joined.append(clusters.select("node", F.col("component").alias("joined")))
            drawn = drawn.union(lists.select("node", near))
        lists = written(merged(drawn), "lists")
        before, close = -1, close_entries(lists).count()
        while close > before * 1.005:
            seen = written(around(lists, located), "seen")
            joined.append(seen.where("joined is not null").select("node", "joined"))
            grown = seen.where("list is not null").select("node", "list")
            lists = written(merged(grown.union(lists)), "lists")
            before, close = close, close_entries(lists).count()
        edges = functools.reduce(DataFrame.union, joined).toDF("a", "b")
        clusters = written(components(edges), "clusters")
        first = located is start
        located = written(placed(units, clusters, lists), "located")
        if located.where("full").count() if first else close_entries(lists).where("other").count():
            continue
        result = audit(located, count, lists)
        if result.recall is None and fresh is not None:
            result = fresh
        logger.info("after %d draws: %s", round_, result)
        # Two unknowns with nothing new between them: there are hardly any links.
        if result.reached or barren >= (1 if result.recall is None else BARREN):
            break
    if not result.reached:
        logger.warning("near vectors: the search ended with %s", result)
    found = written(links_within(clusters, units), "links")
    final = components(found.where("b is not null").select("a", "b"))
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n"))
    each = units.join(final, "node", "left").join(links, "node", "left")
    each = written(
        each.select(
            "unit",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"),
            F.coalesce("component", "node").alias("component"),
        ),
        "results",
    )
    results = rows.join(each, "unit").select("node", "n", "component")
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    ids = ids.where("vec_id is not null").distinct().union(ids.where("vec_id is null"))
    joined = ids.join(results, ids["vec_id"] == results["node"], "left")
    component = F.coalesce("component", "vec_id")
    report = joined.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
    return report, result
