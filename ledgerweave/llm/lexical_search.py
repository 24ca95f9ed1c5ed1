"""Ranked lexical search: range maxima over posting lists bound whole intervals of documents."""

from __future__ import annotations

import functools
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.llm.common import LOWER, byte_class, chunks, per_text, runs, text_bytes, written

TERM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Bytes of text in one shard of the index.
SHARD_BYTES = 4 << 20
#: Bytes of distinct query terms that tasks may hold; with more, the index holds every term.
VOCABULARY_BYTES = 16 << 20
#: Bytes of query terms searched in one pass over the index.
QUERY_BYTES = 8 << 20
#: Intervals of a query split at a time, and postings so few that all their documents are scored.
WIDTH, LEAF = 4, 256
TOP = 10
SALTS = 64
NO_ID = (1 << 63) - 1
SHARD = (
    "docs array<long>, lengths binary, terms array<binary>, sizes array<long>, "
    "places binary, counts binary"
)


def terms_of(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of all texts, each occurrence's number among them, and its row.

    Terms are maximal runs of ASCII letters, digits and other characters above ASCII, A-Z
    lower-cased; a null text has none.
    """
    data, offsets = text_bytes(batch.column("text"))
    inside = TERM[data]
    starts, ends = runs(inside, offsets)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    flat = LOWER[data[inside]]
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(flat)]
    ).dictionary_encode()
    owners = np.repeat(np.arange(batch.num_rows), np.diff(per_text(starts, offsets)))
    return found.dictionary, found.indices.to_numpy().astype(np.int64), owners


def shards(docs: DataFrame, vocabulary: list[bytes] | None) -> DataFrame:
    """The index: a row per shard of documents, with its posting lists one after the other.

    A shard's documents stand by id.  A list's entries are a document's place in the shard and
    the term's count in it.  With a vocabulary only its terms have lists; lengths count all.
    """
    wanted = None if vocabulary is None else pa.array(vocabulary, pa.large_binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=SHARD_BYTES):
            ids = batch.column("doc_id")
            order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            terms, numbers, owners = terms_of(batch)
            lengths = np.bincount(place[owners], minlength=len(order))
            if wanted is not None:
                kept = pc.is_in(terms, value_set=wanted).to_numpy(zero_copy_only=False)
                renumbered = np.cumsum(kept) - 1
                inside = kept[numbers]
                numbers, owners = renumbered[numbers[inside]], owners[inside]
                terms = terms.filter(pa.array(kept))
            entry, counts = np.unique(numbers * len(order) + place[owners], return_counts=True)
            sizes = np.bincount(entry // max(1, len(order)), minlength=len(terms))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
                    pa.array([lengths.astype(np.int64).tobytes()], pa.binary()),
                    pa.array([terms.to_pylist()], pa.list_(pa.binary())),
                    pa.array([sizes.tolist()], pa.list_(pa.int64())),
                    pa.array([(entry % max(1, len(order))).astype(np.int32).tobytes()]),
                    pa.array([counts.astype(np.int32).tobytes()], pa.binary()),
                ],
                ["docs", "lengths", "terms", "sizes", "places", "counts"],
            )

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, SHARD)


def corpus_size(index: DataFrame) -> tuple[int, int]:
    """How many documents have a term, and how many terms all have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64)
            sums = [pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())])]
            yield pa.RecordBatch.from_arrays(sums, ["documents", "terms"])

    sums = index.select("lengths").mapInArrow(run, "documents long, terms long")
    found = sums.agg(F.sum("documents"), F.sum("terms")).first()
    return found[0] or 0, found[1] or 0


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times): the terms of each item; rows with one id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            terms, numbers, owners = terms_of(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id").take(pa.array(owners)),
                    terms.take(pa.array(numbers)).cast(pa.binary()),
                ],
                ["item_id", "term"],
            )

    chosen = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    each = chosen.mapInArrow(run, "item_id long, term binary")
    return each.groupBy("item_id", "term").agg(F.count("*").alias("times"))


def weight(documents: int, holding: int) -> int:
    """A term's weight by the number of documents that hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(counts: np.ndarray, lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a term's count gives a document of a length, before the term's weight."""
    scaled = 100 - 75 + (75 * lengths * documents) // terms
    return (1_000_000_000 * counts) // (1000 * counts + 8 * scaled)


class Postings:
    """A shard's posting lists side by side, with a sparse table of range maxima over them."""

    def __init__(self, places: np.ndarray, values: np.ndarray, sizes: np.ndarray, width: int):
        self.places, self.values, self.width = places, values, max(1, width)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.keys = np.repeat(np.arange(len(sizes)) * self.width, sizes) + places
        # Level k names the greatest of 2^k entries from each on; ranges stay within a list,
        # so what a level says across the end of one is never read.
        level = np.arange(len(values), dtype=np.int32)
        self.levels = [level]
        span = 1
        while 2 * span <= sizes.max(initial=0):
            right = np.append(level[span:], level[len(level) - span :])
            level = np.where(values[right] > values[level], right, level)
            self.levels.append(level)
            span *= 2
        self.table = np.stack(self.levels)

    def greatest(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of greatest value in each range, which must not be empty."""
        level = np.frexp(end - first)[1] - 1  # the largest power of two in the range
        left = self.table[level, first]
        right = self.table[level, end - (1 << level)]
        return np.where(self.values[right] > self.values[left], right, left)


class Tops:
    """The best documents found so far, for each item."""

    def __init__(self, items: int, top: int):
        self.top, self.found = top, [[] for _ in range(items)]
        self.least = np.zeros(items, np.int64)  # a score must exceed this or tie with it

    def offer(self, item: int, score: int, doc: int) -> None:
        """A document with its score; equal scores go by the smaller id."""
        heap = self.found[item]
        if len(heap) < self.top:
            heapq.heappush(heap, (score, -doc))
        elif (score, -doc) > heap[0]:
            heapq.heapreplace(heap, (score, -doc))
        if len(heap) == self.top:
            self.least[item] = heap[0][0]

    def hopeless(self, item: int, bound: int, doc: int) -> bool:
        """Whether nothing from this document on with scores up to the bound can enter."""
        heap = self.found[item]
        return bound <= 0 or (len(heap) == self.top and (bound, -doc) <= heap[0])


def summed(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of consecutive, nonempty segments."""
    return np.add.reduceat(values, begins) if len(begins) else np.zeros(0, np.int64)


def search_shard(
    postings: Postings, ids: np.ndarray, queries: list[tuple[int, np.ndarray, np.ndarray]],
    tops: Tops,
) -> None:
    """Best-first search of a shard for all items (number, lists, factors) side by side.

    An interval of documents is its range of each posting list.  Its bound is the sum of the
    lists' range maxima; the interval with the greatest bound is split at the document of its
    largest maximum, which is scored.  A query ends when its greatest bound can't enter its top.
    """
    heaps: dict[int, list] = {}

    def push(items, lists, factors, firsts, ends, lows) -> None:
        """Bound intervals, given as parallel lists of arrays, and queue those with hope."""
        lengths = np.array([len(x) for x in lists])
        begins = np.cumsum(lengths) - lengths
        first, end = np.concatenate(firsts), np.concatenate(ends)
        factor = np.concatenate(factors)
        some = np.flatnonzero(first < end)
        best = np.zeros(len(first), np.int64)
        value = np.zeros(len(first), np.int64)
        best[some] = postings.greatest(first[some], end[some])
        value[some] = postings.values[best[some]] * factor[some]
        bounds = summed(value, begins)
        postings_in = summed(end - first, begins)
        for n, (item, low) in enumerate(zip(items, lows)):
            bound = int(bounds[n])
            if bound and bound >= tops.least[item] and not tops.hopeless(
                item, bound, int(ids[low]) if low < len(ids) else NO_ID
            ):
                a, b = begins[n], begins[n] + lengths[n]
                split = int(postings.places[best[a + int(value[a:b].argmax())]])
                live = first[a:b] < end[a:b]
                heapq.heappush(
                    heaps[item],
                    (-bound, low, split, int(postings_in[n]), lists[n][live], factors[n][live],
                     first[a:b][live], end[a:b][live]),
                )

    for item, lists, factors in queries:
        heaps[item] = []
        if len(lists):
            push([item], [lists], [factors], [postings.starts[lists]], [postings.ends[lists]], [0])
    while True:
        taken = []
        for item, heap in heaps.items():
            for _ in range(WIDTH):
                if not heap:
                    break
                entry = heapq.heappop(heap)
                if tops.hopeless(item, -entry[0], int(ids[entry[1]])):
                    if -entry[0] < tops.least[item]:
                        heap.clear()
                    continue
                taken.append((item, entry))
        if not taken:
            return
        small = [(i, e) for i, e in taken if e[3] <= LEAF]
        if small:
            score_all(postings, ids, small, tops)
        large = [(i, e) for i, e in taken if e[3] > LEAF]
        if large:
            push(*split_all(postings, ids, large, tops))


def score_all(postings: Postings, ids: np.ndarray, taken: list, tops: Tops) -> None:
    """Score every document of intervals that hold few postings."""
    sizes = np.concatenate([e[7] - e[6] for _, e in taken])
    first = np.concatenate([e[6] for _, e in taken])
    factor = np.concatenate([e[5] for _, e in taken])
    owner = np.repeat(np.arange(len(taken)), [len(e[6]) for _, e in taken])
    entry = np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
    keys = np.repeat(owner, sizes) * postings.width + postings.places[entry]
    order = np.argsort(keys, kind="stable")
    values = (postings.values[entry] * np.repeat(factor, sizes))[order]
    keys = keys[order]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    scores, keys = summed(values, begins), keys[begins]
    items = np.array([i for i, _ in taken])[keys // postings.width]
    likely = np.flatnonzero((scores >= tops.least[items]) & (scores > 0))
    for item, score, place in zip(
        items[likely].tolist(),
        scores[likely].tolist(),
        (keys[likely] % postings.width).tolist(),
    ):
        tops.offer(item, score, int(ids[place]))


def split_all(postings: Postings, ids: np.ndarray, taken: list, tops: Tops) -> tuple:
    """Score the documents that intervals are split at; what is left and right of them."""
    lengths = np.array([len(e[4]) for _, e in taken])
    begins = np.cumsum(lengths) - lengths
    lists, factor = (np.concatenate([e[k] for _, e in taken]) for k in (4, 5))
    ends = np.concatenate([e[7] for _, e in taken])
    split = np.repeat(np.array([e[2] for _, e in taken]), lengths)
    at = np.searchsorted(postings.keys, lists * postings.width + split)
    there = at < ends
    there[there] = postings.places[at[there]] == split[there]
    gains = np.zeros(len(at), np.int64)
    gains[there] = postings.values[at[there]] * factor[there]
    scores = summed(gains, begins)
    after = at + there
    out: tuple[list, ...] = ([], [], [], [], [], [])
    for (item, e), score, a, n in zip(taken, scores.tolist(), begins.tolist(), lengths.tolist()):
        if score > 0:
            tops.offer(item, score, int(ids[e[2]]))
        left = (item, e[4], e[5], e[6], at[a : a + n], e[1])
        right = (item, e[4], e[5], after[a : a + n], e[7], e[2] + 1)
        for side in (left, right):
            for column, value in zip(out, side):
                column.append(value)
    return out


def best_of_tasks(
    index: DataFrame, rows: list, documents: int, terms: int, top: int
) -> DataFrame:
    """(item_id, doc_id, score): per task the best documents of each item of a block.

    ``rows`` are (item_id, term, times, documents that hold it).  What a task has found in one
    shard bounds its search of the next.
    """
    items = sorted({r[0] for r in rows}, key=lambda i: (i is None, i))
    number = {item: n for n, item in enumerate(items)}
    vocabulary = sorted({bytes(r[1]) for r in rows})
    place = {term: n for n, term in enumerate(vocabulary)}
    weights = np.zeros(len(vocabulary), np.int64)
    wanted: list[list[tuple[int, int]]] = [[] for _ in items]
    for item, term, times, holding in rows:
        weights[place[bytes(term)]] = weight(documents, holding)
        wanted[number[item]].append((place[bytes(term)], times))
    queries = [tuple(np.array(column, np.int64) for column in zip(*sorted(w))) for w in wanted]
    value_set = pa.array(vocabulary, pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = Tops(len(items), top)
        for batch in batches:
            for n in range(batch.num_rows):
                ids = pc.fill_null(batch.column("docs")[n].values, NO_ID).to_numpy()
                if len(ids) == 0:
                    continue
                lengths, places, counts = (
                    np.frombuffer(batch.column(c)[n].as_py(), kind)
                    for c, kind in (("lengths", "i8"), ("places", "i4"), ("counts", "i4"))
                )
                sizes = batch.column("sizes")[n].values.to_numpy()
                held = pc.index_in(batch.column("terms")[n].values, value_set=value_set)
                held = pc.fill_null(held, -1).to_numpy()
                gains = impacts(counts.astype(np.int64), lengths[places], documents, terms)
                gains = gains * np.repeat(weights[held] * (held >= 0), sizes)
                postings = Postings(places, gains, sizes, len(ids))
                list_of = np.full(len(vocabulary), -1, np.int64)
                list_of[held[held >= 0]] = np.flatnonzero(held >= 0)
                asked = []
                for item, (names, times) in enumerate(queries):
                    lists = list_of[names]
                    asked.append((item, lists[lists >= 0], times[lists >= 0]))
                search_shard(postings, ids, asked, tops)
        found = [(items[n], s, -d) for n, heap in enumerate(tops.found) for s, d in heap]
        ids = [None if d == NO_ID else d for _, _, d in found]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _, _ in found], pa.int64()),
                pa.array(ids, pa.int64()),
                pa.array([s for _, s, _ in found], pa.int64()),
            ],
            ["item_id", "doc_id", "score"],
        )

    return index.mapInArrow(run, "item_id long, doc_id long, score long")


def best_rows(rows: DataFrame, top: int) -> DataFrame:
    """The best rows of each item with their rank; first within shares of its rows."""
    order: list[Column] = [F.desc("score"), F.asc_nulls_last("doc_id")]
    share = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))
    few = rows.withColumn("share", share).withColumn(
        "rank", F.row_number().over(Window.partitionBy("item_id", "share").orderBy(*order))
    )
    few = few.where(F.col("rank") <= top)
    ranked = few.withColumn(
        "rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    )
    return ranked.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The best documents of each item: item_id, rank, doc_id, score.

    Every document is ranked by the summed impacts of the item's terms, repeats included; only
    scores above 0 count, and equal scores go by ascending doc_id, rows without an id last.
    Repeated rows of a document are ranked each.  Rows of ``items`` with one id are one item,
    also those without an id.  Null and empty texts have no terms.  The index is cut into
    shards by text, so no task holds more than one shard's lists; queries come in blocks of
    bounded size, each a pass over the index.
    """
    spark = docs.sparkSession
    asked = written(query_terms(items), "asked")
    distinct = asked.select("term").distinct()
    size = distinct.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    vocabulary = None
    if size <= VOCABULARY_BYTES:
        vocabulary = [bytes(r["term"]) for r in distinct.collect()]  # bounded by the check
    index = written(shards(docs, vocabulary), "index")
    documents, terms = corpus_size(index)
    lists = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("list"))
    holding = lists.groupBy(F.col("list.terms").alias("term")).agg(
        F.sum("list.sizes").alias("holding")
    )
    known = written(asked.join(holding, "term"), "known")
    total = known.agg(F.sum(F.octet_length("term") + 24)).first()[0] or 0
    blocks = max(1, math.ceil(total / QUERY_BYTES))
    found = []
    for block in range(blocks if total else 0):
        chosen = known.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        rows = chosen.select("item_id", "term", "times", "holding").collect()  # one block
        if rows:
            found.append(best_of_tasks(index, [tuple(r) for r in rows], documents, terms, top))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return best_rows(functools.reduce(DataFrame.union, found), top)
