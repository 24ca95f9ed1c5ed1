"""Jaccard join of word n-grams: MinHash candidates pruned by Bayes, then verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import (
    LOWER,
    WHITE,
    append_columns,
    chunks,
    free_name,
    list_array,
    mix,
    per_text,
    runs,
    text_bytes,
    word_hashes,
    written,
)
from ledgerweave.llm.graph import block_pairs, components, forest, grouped

WORDS = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 25, 5
HASHES = BANDS * BAND_ROWS
STEP = 25
TOLERANCE = 1e-5
BUCKET_BLOCK, CLUSTER_BLOCK = 512, 256
PLACE = np.array([3, 5, 7, 11, 13, 17, 19, 23, 29, 31], np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(
    batch: pa.RecordBatch, words: int = WORDS
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and how many each text has.

    Words are runs without white space, A-Z lower-cased.  A text with fewer words than a
    shingle is one shingle of all its words; one without words has none.
    """
    data, offsets = text_bytes(batch.column("text"))
    starts, ends = runs(~WHITE[data], offsets)
    hashes = word_hashes(LOWER[data], starts, ends)
    first = per_text(starts, offsets)
    counts = np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts)
    index = np.arange(len(hashes))
    left = first[1:][rows] - index  # words from here to the text's end
    whole = (left >= words) | ((index == first[:-1][rows]) & (counts[rows] < words))
    begin = index[whole]
    value = np.zeros(len(begin), np.uint64)
    for k in range(words):
        inside = left[begin] > k
        at = np.minimum(begin + k, max(0, len(hashes) - 1))
        value += np.where(inside, mix(hashes[at] + PLACE[k]) * (PLACE[k] | np.uint64(1)), 0).astype(
            np.uint64
        )
    value = mix(value)
    owner = rows[begin]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(counts)).astype(np.int64)


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MinHash of each set under HASHES functions; rows of empty sets mean nothing."""
    out = np.zeros((len(counts), HASHES), np.uint32)
    full = counts > 0
    if not full.any():
        return out
    begin = (np.cumsum(counts) - counts)[full]
    rng = np.random.default_rng(5)
    factor = rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
    shift = rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
    low, high = values.astype(np.uint32), (values >> np.uint64(32)).astype(np.uint32)
    for k in range(HASHES):
        hashed = low * factor[k] + shift[k]
        hashed ^= high
        hashed *= factor[HASHES - 1 - k]
        out[full, k] = np.minimum.reduceat(hashed, begin)
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, shingles (number), a 128-bit key of the set, and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            values, counts = shingle_sets(batch)
            signed = signatures(values, counts)
            keys = set_keys(values, counts)
            rows = [r.tobytes() for r in signed]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), *keys, pa.array(rows, pa.binary())],
                ["doc_id", "shingles", "key_a", "key_b", "signature"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, shingles long, key_a long, key_b long, signature binary"
    )


def set_keys(values: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
    """Two 64-bit sums that name a set."""
    ends = np.cumsum(counts)
    out = []
    for salt in (1, 2):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(values + np.uint64(salt)))])
        out.append(pa.array((total[ends] - total[ends - counts]).view(np.int64)))
    return out


def required_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """Fewest equal hashes after 25, 50, ... with which a pair stays a candidate.

    With a uniform prior the similarity after m matches of k is Beta(m + 1, k - m + 1), and
    the chance that it reaches t is that of at most m successes of k + 1 at rate t.
    """
    out = {}
    for k in range(STEP, HASHES + 1, STEP):
        chance = 0.0
        for m in range(k + 1):
            chance += comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if chance >= tolerance:
                out[k] = m
                break
    return out


def bayes_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature blocks that no step of the comparison drops."""
    needed = required_matches()
    left, right = [], []
    for first in range(0, len(a), 64):
        rows = a[first : first + 64]
        matches = np.zeros((len(rows), len(b)), np.int16)
        for k in range(STEP):
            matches += rows[:, k][:, None] == b[:, k][None, :]
        x, y = np.nonzero(matches >= needed[STEP])
        x = x + first
        if same:
            x, y = x[x < y], y[x < y]
        left.append(x)
        right.append(y)
    x, y = np.concatenate(left), np.concatenate(right)
    found = (a[x, :STEP] == b[y, :STEP]).sum(1)
    for k in range(STEP, HASHES, STEP):
        found = found + (a[x, k : k + STEP] == b[y, k : k + STEP]).sum(1)
        stay = found >= needed[k + STEP]
        x, y, found = x[stay], y[stay], found[stay]
    return x, y


def _signature_rows(table: pa.Table) -> np.ndarray:
    joined = b"".join(table.column("signature").to_pylist())
    return np.frombuffer(joined, np.uint32).reshape(table.num_rows, HASHES)


def _blocks(table: pa.Table, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    own = table.column("own").to_numpy()
    return np.flatnonzero(own == i), np.flatnonzero(own == j)


def candidate_edges(sets: DataFrame) -> DataFrame:
    """Edges that join all sets of which some chain of candidate pairs survives the pruning.

    Sets with an equal band of hashes share a bucket.  Buckets with the same members are
    compared once, told by sums of hashes, so no list of members is gathered.  A large bucket
    is compared block by block.  A task gives back a forest of its surviving pairs.
    """
    width = 4 * BAND_ROWS
    parts = [F.substring("signature", width * j + 1, width) for j in range(BANDS)]
    bands = F.array(*(F.xxhash64(F.lit(j), part) for j, part in enumerate(parts)))
    spread = sets.where("shingles > 0").select("node", F.explode(bands).alias("band"))
    counted = spread.groupBy("band").agg(
        F.count("*").alias("members"),
        F.sum(F.xxhash64(F.lit(1), "node") % (1 << 40)).alias("sum_a"),
        F.sum(F.xxhash64(F.lit(2), "node") % (1 << 40)).alias("sum_b"),
    )
    distinct = (
        counted.where("members > 1")
        .groupBy("members", "sum_a", "sum_b")
        .agg(F.min("band").alias("band"))
        .select("band", "members")
    )
    members = spread.join(distinct, "band").join(sets.select("node", "signature"), "node")
    keyed = block_pairs(members, "band", "node", "members", BUCKET_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), table in grouped(batches, 3):
            nodes, signed = table.column("node").to_numpy(), _signature_rows(table)
            p, q = _blocks(table, i, j)
            if len(p) and len(q):
                x, y = bayes_pairs(signed[p], signed[q], i == j)
                a, b = forest(nodes[p[x]], nodes[q[y]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
                )

    keys = ["band", "i", "j"]
    return (
        keyed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")
    )


def verified(docs: DataFrame, sets: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rows (a, b, links) from the exact comparison inside clusters.

    Forest edges of the links have b and links = 0; the others say how many documents a task
    found linked to the set of document a.  A large cluster is compared block by block.
    """
    sized = clusters.groupBy("component").agg(F.count("*").alias("members"))
    nodes = clusters.join(sized, "component").join(sets, "node")
    wanted = nodes.select(
        "first_id", "node", "component", "members", "copies", "key_a", "key_b"
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    picked = texts.join(wanted, texts["doc_id"] == wanted["first_id"])

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["component", "node", "members", "copies", "set", "signature"]
        for batch in chunks(batches):
            values, counts = shingle_sets(batch)
            keys = set_keys(values, counts)
            # Of several texts with one id, only the set's own.
            own = np.logical_and(*(
                k.to_numpy() == batch.column(c).to_numpy() for k, c in zip(keys, ("key_a", "key_b"))
            ))
            signed = [r.tobytes() for r in signatures(values, counts)]
            arrays = [batch.column(c) for c in names[:4]]
            sets_of = list_array(values.view(np.int64), counts, pa.int64())
            arrays += [sets_of, pa.array(signed, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names).filter(pa.array(own))

    columns = (
        "component long, node long, members long, copies long, set array<long>, signature binary"
    )
    with_sets = picked.mapInArrow(shingle, columns).dropDuplicates(["component", "node"])
    keyed = block_pairs(with_sets, "component", "node", "members", CLUSTER_BLOCK)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), table in grouped(batches, 3):
            nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
            sets_of = [s.values.to_numpy().view(np.uint64) for s in table.column("set")]
            signed = _signature_rows(table)
            p, q = _blocks(table, i, j)
            if not len(p) or not len(q):
                continue
            x, y = bayes_pairs(signed[p], signed[q], i == j)
            x, y = p[x], q[y]
            linked = jaccard(sets_of, x, y) >= THRESHOLD
            x, y = x[linked], y[linked]
            links = np.zeros(len(nodes), np.int64)
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            a, b = forest(nodes[x], nodes[y])
            some = np.flatnonzero(links)
            left = np.concatenate([np.array(a, np.int64), nodes[some]])
            right = pa.array([*b, *[None] * len(some)], pa.int64())
            number = np.concatenate([np.zeros(len(a), np.int64), links[some]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(left), right, pa.array(number)], ["a", "b", "links"]
            )

    keys = ["component", "i", "j"]
    return (
        keyed.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(compare, "a long, b long, links long")
    )


def jaccard(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact similarity of pairs of sorted sets."""
    sizes = np.array([len(s) for s in sets])
    if len(x) < 300:
        common = (np.intersect1d(sets[a], sets[b], assume_unique=True) for a, b in zip(x, y))
        both = np.array([len(c) for c in common])
    else:
        both = _all_overlaps(sets)[x, y]
    return both / np.maximum(1, sizes[x] + sizes[y] - both)


def _all_overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of a few hundred sets share, by blocks of values."""
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float64)
    for first in range(0, len(values), 4096):
        a, b = np.searchsorted(column, [first, first + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        total += part @ part.T
    return total


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Links and classes of documents: doc_id, class_id, n_links, kept.

    See ``classified``; of the rows with a kept id, those with the kept set are kept.
    """
    return classified(docs).select("doc_id", "class_id", "n_links", "kept")


def classified(docs: DataFrame) -> DataFrame:
    """Links and classes of documents: doc_id, key_a, key_b, class_id, n_links, kept.

    Two documents are linked if their five-word shingle sets have a Jaccard similarity of 0.8
    or more.  A class is what links reach; its smallest doc_id names it and is kept.  n_links
    counts the other documents linked directly, copies included.  Documents with equal sets
    are joined as one set.  Of rows with one id, each has the links and the class of its own
    text; if a class's smallest id stands on several of its texts, one of them is kept.  A
    document without words, null ones among them, has no links, nor has a row without an id.
    A pair at exactly 0.8 is missed by the bands with a chance of 5e-5 and dropped by the
    pruning with 5e-5; more similar pairs with less.
    """
    rows = written(sketch(docs), "sketch")
    usable = rows.where("shingles > 0 and doc_id is not null")
    sets = written(
        usable.groupBy("key_a", "key_b", "shingles").agg(
            F.min("doc_id").alias("first_id"),
            F.count("*").alias("copies"),
            F.first("signature").alias("signature"),
        )
        .withColumn("node", F.monotonically_increasing_id()),  # fixed once it is written
        "sets",
    )
    clusters = components(candidate_edges(sets))
    found = written(verified(docs, sets.drop("signature"), clusters), "links")
    classes = written(components(found.where("b is not null").select("a", "b")), "classes")
    first = (
        classes.join(sets.select("node", "first_id"), "node")
        .groupBy("component")
        .agg(F.min(F.struct("first_id", "node")).alias("one"))
    )
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("linked"))
    named = (
        sets.drop("signature")
        .join(classes.join(first, "component"), "node", "left")
        .join(links, "node", "left")
        .withColumn("one", F.coalesce("one", F.struct("first_id", "node")))
    )
    joined = rows.drop("signature").join(
        named.select("key_a", "key_b", "shingles", "node", "copies", "one", "linked"),
        ["key_a", "key_b", "shingles"],
        "left",
    )
    alone = F.col("doc_id").isNull() | F.col("node").isNull()
    class_id = F.when(alone, F.col("doc_id")).otherwise(F.col("one.first_id"))
    own = (F.col("doc_id") == class_id) & (F.col("node") == F.col("one.node"))
    return joined.select(
        "doc_id",
        "key_a",
        "key_b",
        class_id.alias("class_id"),
        F.when(alone, 0)
        .otherwise(F.col("copies") - 1 + F.coalesce("linked", F.lit(0)))
        .cast("long")
        .alias("n_links"),
        (alone | own).alias("kept"),
    )


def one_of_each_class(docs: DataFrame) -> DataFrame:
    """The rows of the kept documents, with all their columns.

    Rows with one id and equal sets are one document: one of them stays.
    """
    key, a, b, c, d = (free_name(docs, f"_{n}") for n in ("id", "a", "b", "c", "d"))

    def keys(batch: pa.RecordBatch) -> list[pa.Array]:
        return set_keys(*shingle_sets(batch))

    dropped = classified(docs).where("not kept").select(
        F.col("doc_id").alias(key), F.col("key_a").alias(c), F.col("key_b").alias(d)
    )
    named = append_columns(docs, keys, [a, b], ["long", "long"])
    # By id and set, since an id may stand on other texts, too; the same keys then leave one of
    # equal rows, so the texts are shuffled once.
    same = (
        (named["doc_id"].cast("long") == dropped[key])
        & (named[a] == dropped[c])
        & (named[b] == dropped[d])
    )
    kept = named.join(dropped.distinct(), same, "left_anti")
    return kept.dropDuplicates(["doc_id", a, b]).select(*docs.columns)
