"""Packing token pieces into sequences by cutting-stock column generation."""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerweave.llm.common import chunks, exclusive_total, written

SEQUENCE = 2048
UNIT = 8
SEPARATOR = 1
EPSILON = 1e-7
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
)
#: Fixed value: how the vocabulary file splits a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_encoding(path: str):
    """An encoder with the vocabulary and special tokens of a byte-level BPE file.

    The ids are those of the library the file is written for; this encoder is four times
    faster.  The order of ids is the order of merges in such a file.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    # Bytes that don't print stand as code points from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    ranks = {
        bytes(byte_of[c] for c in token): rank
        for token, rank in described["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def encoder(path: str) -> Callable[[str], list[int]]:
    """From a text to its ids, special tokens included where the text spells them.

    The fast encoder's pattern gives up on very long runs of white space; such texts go to the
    library that the file is written for.
    """
    fast, exact = load_encoding(path), []

    def ids(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except ValueError:
            if not exact:
                exact.append(Tokenizer.from_file(path))
            return list(exact[0].encode(text, add_special_tokens=False).ids)

    return ids


def pieces_of(docs: DataFrame, path: str, sequence: int = SEQUENCE) -> DataFrame:
    """The documents' token ids, cut every ``sequence`` ids: one row for each piece.

    Ids of the text (null: none), then the separator.  The crc is over little-endian
    unsigned 32-bit ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in chunks(batches):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = [*encode(text or ""), SEPARATOR]
                packed = np.array(ids, "<u4")
                for start in range(0, len(ids), sequence):
                    piece = packed[start : start + sequence]
                    rows.append((doc_id, start, len(piece), zlib.crc32(piece), len(ids)))
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, PIECES
    )


# The linear program: few numbers, whatever the table's size --------------------------


def best_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of sizes 1..capacity with the greatest value."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    for room in range(1, capacity + 1):
        reached = values[:room] + best[room - 1 :: -1]
        size = int(reached.argmax())
        if reached[size] > best[room - 1]:
            best[room], choice[room] = reached[size], size + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(capacity, np.int64), capacity
    while room > 0:
        if choice[room]:
            pattern[choice[room] - 1] += 1
            room -= choice[room]
        else:
            room -= 1
    return float(best[capacity]), pattern


def cutting_stock(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, so that every size's demand is covered.

    ``demand[i]`` items have size i + 1.  Revised simplex over patterns, columns priced by a
    knapsack; then counts are rounded down and first fit places what is left, largest first.
    """
    sizes = np.flatnonzero(demand)
    if len(sizes) == 0:
        return []
    rows, need = len(sizes), demand[sizes].astype(float)
    columns = [np.eye(rows)[i] * (capacity // (s + 1)) for i, s in enumerate(sizes)]
    inverse = np.diag([1.0 / (capacity // (s + 1)) for s in sizes])
    level = inverse @ need
    costs = np.ones(rows)
    for step in range(50 * rows):
        if step % 64 == 63:  # rounding errors grow with each pivot: one Newton step undoes them
            error = np.eye(rows) - np.einsum("ij,jk->ik", inverse, np.stack(columns, axis=1))
            inverse = inverse + np.einsum("ij,jk->ik", error, inverse)
            level = inverse @ need
        duals = costs @ inverse
        worst = int(duals.argmin())
        if duals[worst] < -EPSILON:  # a size would rather be covered too often
            entering, cost = -np.eye(rows)[worst], 0.0
        else:
            values = np.zeros(capacity)
            values[sizes] = np.maximum(duals, 0)
            worth, pattern = best_pattern(values, capacity)
            if worth <= 1 + EPSILON:
                break
            entering, cost = pattern[sizes].astype(float), 1.0
        change = inverse @ entering
        rising = change > EPSILON
        if not rising.any():
            break
        steps = np.full(rows, np.inf)
        steps[rising] = np.maximum(level[rising], 0) / change[rising]
        leaving = int(steps.argmin())
        pivot = inverse[leaving] / change[leaving]
        inverse -= np.outer(change, pivot)
        inverse[leaving] = pivot
        columns[leaving], costs[leaving] = entering, cost
        level = inverse @ need
    plan: list[tuple[np.ndarray, int]] = []
    left = demand[sizes].copy()
    for column, amount, cost in zip(columns, level, costs):
        times = math.floor(amount + EPSILON)
        if cost and times > 0:
            counts = np.rint(column).astype(np.int64)
            plan.append((spread(counts, sizes, capacity), times))
            left -= counts * times
    left = np.maximum(left, 0)
    for i, size in enumerate(sizes):  # all but what rounding can leave, in bulk
        each = capacity // (int(size) + 1)
        times = int(left[i]) // each - rows
        if times > 0:
            plan.append((spread(each * (np.arange(rows) == i), sizes, capacity), times))
            left[i] -= each * times
    plan += [(spread(c, sizes, capacity), 1) for c in first_fit(left, sizes, capacity)]
    return plan


def spread(counts: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Counts of some sizes as counts of all."""
    full = np.zeros(capacity, np.int64)
    full[sizes] = counts
    return full


def first_fit(left: np.ndarray, sizes: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Bins for what rounding down left over: fewer items than the patterns hold."""
    bins: list[np.ndarray] = []
    rooms: list[int] = []
    for i in range(len(sizes) - 1, -1, -1):
        size = int(sizes[i]) + 1
        for _ in range(int(left[i])):
            for b, room in enumerate(rooms):
                if room >= size:
                    break
            else:
                bins.append(np.zeros(len(sizes), np.int64))
                rooms.append(capacity)
                b = len(bins) - 1
            bins[b][i] += 1
            rooms[b] -= size
    return bins


def intervals(plan: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """(size, first rank, end rank, first sequence, items per sequence) for each pattern's size.

    Items of a size, by rank, fill the patterns in order; a pattern's copies are numbered on.
    """
    out = []
    next_rank: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        for size in np.flatnonzero(pattern):
            each = int(pattern[size])
            first = next_rank.get(int(size), 0)
            out.append((int(size) + 1, first, first + each * times, sequence, each))
            next_rank[int(size)] = first + each * times
        sequence += times
    return out


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE, unit: int = UNIT) -> DataFrame:
    """Pieces with their sequence_id and the offset in it.

    Pieces are counted in a histogram of at most sequence / unit lengths, each rounded up to
    whole units for the plan alone; the linear program sees only that.  Then the pieces of a
    length, ranked by document, take the places that the patterns have for it.  A null or
    empty text is one separator.  Repeated rows are packed each.  An empty table packs to
    nothing.  A sequence holds at most ``sequence`` ids.
    """
    rows = written(pieces_of(docs, path, sequence), "pieces")
    capacity = sequence // unit
    sized = rows.withColumn("size", F.ceil(F.col("length") / unit).cast("int"))
    demand = np.zeros(capacity, np.int64)
    counted = sized.groupBy("size").agg(F.count("*").alias("n")).collect()  # <= capacity rows
    for size, n in counted:
        demand[size - 1] = n
    places = intervals(cutting_stock(demand, capacity))
    spark = docs.sparkSession
    schema = "place_size int, first long, end long, sequence long, each long"
    slots = spark.createDataFrame(places, schema)
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    ranked = exclusive_total(sized, ["size"], order, F.lit(1), "rank", int(demand.sum()))
    placed = ranked.join(
        F.broadcast(slots),
        (F.col("size") == F.col("place_size"))
        & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("end")),
    ).withColumn(
        "sequence_id",
        F.col("sequence") + F.floor((F.col("rank") - F.col("first")) / F.col("each")),
    )
    within = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("size"), "rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("length").over(within), F.lit(0)).alias("offset")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset
    )
