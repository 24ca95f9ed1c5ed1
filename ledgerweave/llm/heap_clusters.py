"""Centroid clustering in exact integers, with heaps of bounds that say who must be looked at."""

from __future__ import annotations

import hashlib
import heapq
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import written
from ledgerweave.sources.tables import scratch_path

SIZE, CLUSTERS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
#: Vectors of one block, and of one task.
BLOCK, TASK = 1024, 65_536
#: Integers beyond this count as this: 64 squares of differences still fit in a long.
LARGEST = 1 << 27
#: Below this, products of integers are exact in double precision.
SMALL = 1 << 20
#: Bounds are doubles; a gap this small a part of its distances counts as none.
SLACK = 1e-9
BLOCKS = "block long, ids array<long>, ints binary"
STATE = "block long, owner binary, members binary, keys binary, sums array<long>"


def integer_vectors(column: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are usable, and floor(scale * x) of their components."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    whole = np.flatnonzero(lengths == size)
    flat = pc.list_flatten(column.take(pa.array(whole)))
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(whole), size)
    finite = np.isfinite(values).all(1)  # a null component reads as not a number
    bounded = np.clip(np.floor(scale * values[finite]), -LARGEST, LARGEST)
    return whole[finite], bounded.astype(np.int32)


def blocks_of(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """Rows of up to BLOCK usable vectors: a number, their ids, and their integers packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            rows, ints = integer_vectors(batch.column(1), size, scale)
            ids = batch.column(0).take(pa.array(rows))
            starts = range(0, len(rows), BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number + i for i in range(len(starts))], pa.int64()),
                    pa.array(
                        [ids[s : s + BLOCK].to_pylist() for s in starts], pa.list_(pa.int64())
                    ),
                    pa.array([ints[s : s + BLOCK].tobytes() for s in starts], pa.binary()),
                ],
                ["block", "ids", "ints"],
            )
            number += len(starts)

    chosen = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    )
    return chosen.mapInArrow(run, BLOCKS)


def save_bucketed(blocks: DataFrame, buckets: int) -> str:
    """The blocks as a table bucketed by number: joins on it never move the vectors again."""
    name = f"blocks_{uuid.uuid4().hex}"
    (
        blocks.repartition(buckets, "block")
        .write.bucketBy(buckets, "block")
        .option("path", scratch_path(blocks.sparkSession, "blocks"))
        .saveAsTable(name)
    )
    return name


def first_centroids(blocks: DataFrame, clusters: int, size: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hex SHA-256 of "seed:vec_id"; equal ids by components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, ints in zip(batch.column(0), batch.column(1)):
                rows = np.frombuffer(ints.as_py(), np.int32).reshape(-1, size)
                named = [(i, v) for i, v in enumerate(ids.as_py()) if v is not None]
                marks = [hashlib.sha256(f"{seed}:{v}".encode()).hexdigest() for _, v in named]
                least = heapq.nsmallest(
                    clusters, ((m, rows[i].tolist()) for m, (i, _) in zip(marks, named))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([m for m, _ in least], pa.string()),
                        pa.array([r for _, r in least], pa.list_(pa.int32())),
                    ],
                    ["mark", "ints"],
                )

    least = blocks.select("ids", "ints").mapInArrow(run, "mark string, ints array<int>")
    rows = least.orderBy("mark", "ints").limit(clusters).collect()  # bounded by the parameter
    return np.array([r["ints"] for r in rows], np.int64).reshape(len(rows), size)


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances between integer vectors, as 64-bit integers."""
    largest = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0))
    if largest < SMALL:
        a, b = vectors.astype(np.float64), centroids.astype(np.float64)
        squares = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
        return squares.astype(np.int64)
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, centroid in enumerate(centroids):
        difference = vectors.astype(np.int64) - centroid
        out[:, j] = (difference * difference).sum(1)
    return out


class Heaps:
    """The clusters' heaps over one block.

    A vector's key is the gap between its distance to its own centroid and to the next, plus
    the drift its cluster had accumulated when it was measured.  While the key exceeds the drift
    accumulated since, no other centroid can have become the nearest.
    """

    def __init__(self, owner: np.ndarray, heaps: list[list[tuple[float, int]]]):
        self.owner, self.heaps = owner, heaps

    @classmethod
    def fresh(cls, vectors: int, clusters: int) -> Heaps:
        """Nobody owned; heap 0 holds all with keys that have expired."""
        heaps: list[list[tuple[float, int]]] = [[] for _ in range(clusters)]
        heaps[0] = [(-math.inf, i) for i in range(vectors)]
        return cls(np.full(vectors, -1, np.int16), heaps)

    @classmethod
    def unpacked(cls, owner: bytes, members: bytes, keys: bytes, clusters: int) -> Heaps:
        """As they were packed: the heaps in cluster order, each in heap order."""
        owners = np.frombuffer(owner, np.int16).copy()
        sizes = np.bincount(owners, minlength=clusters)
        heaps, start = [], 0
        pairs = list(zip(np.frombuffer(keys).tolist(), np.frombuffer(members, np.int32).tolist()))
        for size in sizes.tolist():
            heaps.append(pairs[start : start + size])
            start += size
        return cls(owners, heaps)

    def packed(self) -> tuple[bytes, bytes, bytes]:
        """Owners, members and keys as bytes."""
        pairs = [pair for heap in self.heaps for pair in heap]
        members = np.array([i for _, i in pairs], np.int32)
        return self.owner.tobytes(), members.tobytes(), np.array([k for k, _ in pairs]).tobytes()

    def expired(self, drift: np.ndarray) -> np.ndarray:
        """Pop every vector whose gap its cluster's drift has used up."""
        popped = []
        for heap, moved in zip(self.heaps, (drift * (1 + SLACK)).tolist()):
            while heap and heap[0][0] <= moved:
                popped.append(heapq.heappop(heap)[1])
        return np.array(popped, np.int64)

    def put(self, rows: np.ndarray, distances: np.ndarray, drift: np.ndarray) -> None:
        """Give rows to their nearest centroids; of equally near ones the first."""
        own = distances.argmin(1)
        self.owner[rows] = own
        near = np.sqrt(distances[np.arange(len(rows)), own].astype(np.float64))
        others = distances.astype(np.float64)
        others[np.arange(len(rows)), own] = np.inf
        far = np.sqrt(others.min(1))
        slack = np.where(np.isfinite(far), SLACK * (near + far), 0)
        keys = far - near - slack + drift[own]
        for row, cluster, key in zip(rows.tolist(), own.tolist(), keys.tolist()):
            heapq.heappush(self.heaps[cluster], (key, row))


def reassigned(
    blocks: DataFrame, state: DataFrame | None, centroids: np.ndarray, drift: np.ndarray
) -> DataFrame:
    """One round: the blocks' next state, and a row per task with what moved between sums.

    The vectors stay in their buckets; the state, some twelve bytes a vector, comes to them.
    """
    clusters, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved = np.zeros((clusters, size + 1), np.int64)
        names = ["block", "owner", "members", "keys", "sums"]
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for block, ints, *held in zip(*(c.to_pylist() for c in batch.columns)):
                vectors = np.frombuffer(ints, np.int32).reshape(-1, size)
                heaps = (
                    Heaps.unpacked(*held, clusters)
                    if held
                    else Heaps.fresh(len(vectors), clusters)
                )
                rows = heaps.expired(drift)
                before = heaps.owner[rows]
                heaps.put(rows, squared_distances(vectors[rows], centroids), drift)
                after = heaps.owner[rows]
                other = before != after
                changed = np.column_stack([vectors[rows[other]], np.ones(other.sum(), np.int64)])
                np.add.at(moved, after[other], changed)
                known = before[other] >= 0
                np.subtract.at(moved, before[other][known], changed[known])
                for column, value in zip(out, (block, *heaps.packed())):
                    column.append(value)
            arrays = [pa.array(out[0], pa.int64()), *(pa.array(c, pa.binary()) for c in out[1:])]
            none = pa.nulls(len(out[0]), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*arrays, none], names)
        blank = [pa.nulls(1, pa.int64()), *(pa.nulls(1, pa.binary()) for _ in range(3))]
        sums = pa.array([moved.ravel().tolist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*blank, sums], names)

    rows = blocks.select("block", "ints")
    if state is not None:
        held = state.where("block is not null").drop("sums").hint("shuffle_hash")
        rows = rows.join(held, "block").select("block", "ints", "owner", "members", "keys")
    return written(rows.mapInArrow(run, STATE), "state")


def moved_sums(state: DataFrame, clusters: int, size: int) -> np.ndarray:
    """What the tasks' rows of moved sums and counts add up to: a number per component."""
    each = state.where("block is null").select(F.posexplode("sums").alias("place", "value"))
    found = each.groupBy("place").agg(F.sum("value")).collect()  # clusters x (size + 1) rows
    total = np.zeros(clusters * (size + 1), np.int64)
    for place, value in found:
        total[place] = value
    return total.reshape(clusters, size + 1)


def drifts(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """By how much a gap of each cluster can shrink: its own move and the largest other one."""
    moves = np.sqrt(((after - before).astype(np.float64) ** 2).sum(1))
    others = [np.delete(moves, c).max(initial=0.0) for c in range(len(moves))]
    return moves + np.array(others)


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    size: int = SIZE,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable vector, and the final centroids.

    Usable are vectors of ``size`` finite components, none null; x becomes floor(scale * x),
    held within 2^27 either way.  The first centroids are the usable vectors with the smallest
    hash of their id, fewer if there are not enough; a row without an id is never one, but
    takes part.  Repeated rows count each.  Each round assigns every vector to the nearest
    centroid, ties to the first, and moves every centroid that has vectors to the floor of
    their mean.  Only vectors whose gap has expired are measured again.
    """
    spark = vectors.sparkSession
    count = vectors.count()
    tasks = max(math.ceil(count / TASK), min(count, spark.sparkContext.defaultParallelism))
    name = save_bucketed(blocks_of(vectors, size, scale), max(1, tasks))
    blocks = spark.table(name)
    centroids = first_centroids(blocks, clusters, size, seed)
    if not len(centroids):
        spark.sql(f"drop table {name}")
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    state, drift = None, np.zeros(len(centroids))
    sums = np.zeros((len(centroids), size + 1), np.int64)
    for _ in range(rounds):
        state = reassigned(blocks, state, centroids, drift)
        sums = sums + moved_sums(state, len(centroids), size)
        members = sums[:, -1:]
        means = np.where(members > 0, sums[:, :-1] // np.maximum(1, members), centroids)
        drift = drift + drifts(centroids, means)
        centroids = means
    state = reassigned(blocks, state, centroids, drift)
    found = written(measured(blocks, state, centroids), "clusters")
    spark.sql(f"drop table {name}")  # its files stay in the shared folder
    return found, centroids


def measured(blocks: DataFrame, state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Each vector's cluster and its exact squared distance to that centroid."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, ints, owner in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(owner, np.int16)
                apart = np.frombuffer(ints, np.int32).reshape(-1, size) - centroids[own]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(own, pa.int32()),
                        pa.array((apart * apart).sum(1), pa.int64()),
                    ],
                    ["vec_id", "cluster", "distance"],
                )

    held = state.where("block is not null").select("block", "owner").hint("shuffle_hash")
    rows = blocks.select("block", "ids", "ints").join(held, "block")
    return rows.select("ids", "ints", "owner").mapInArrow(
        run, "vec_id long, cluster int, distance long"
    )


def cluster_report(vectors: DataFrame, **parameters: int) -> DataFrame:
    """Each vector with its cluster, distance, the sums of distances and its centroid's digest.

    A sum that doesn't fit in a long is null.
    """
    rows, centroids = cluster(vectors, **parameters)
    exact = F.col("distance").cast("decimal(38,0)")
    each = {r[0]: r[1] for r in rows.groupBy("cluster").agg(F.sum(exact)).collect()}
    sums = [
        (i, fitting(int(each[i])), fitting(int(sum(each.values()))), digest(c))
        for i, c in enumerate(centroids.tolist())
        if i in each
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # One row per cluster: their number is a parameter.
    named = rows.sparkSession.createDataFrame(sums, schema)
    return rows.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def fitting(total: int) -> int | None:
    """The sum, or null where no long can hold it."""
    return total if total < 1 << 63 else None


def digest(components: list[int]) -> str:
    """SHA-256 of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, components)).encode()).hexdigest()
