"""Removal of byte strings that repeat anywhere, by prefix-free parsing.

Rolling-hash triggers cut texts into phrases.  The suffix array of the distinct phrases and that
of the parse, the sequence of their ranks, combine into the order of all suffixes, in which a
string that repeats stands beside its like.

Over a corpus this is done twice.  Coarse triggers, one in every window of LENGTH bytes, cut the
texts into stretches that may share windows only if they share the trigger; so unique text drops
out on counts of triggers, and equal stretches on digests.  What remains, stretches that share a
trigger but differ, goes to blocks of a bounded size, and each block is parsed and ordered.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import chunks, kept, mix, packed, text_bytes, written

LENGTH = 400
#: Bytes of the rolling hash whose least value in a window is its coarse trigger.
GRAM = 64
#: Inside a block: bytes of the trigger, and one position in so many is one.
WORD, EVERY = 16, 32
#: Bytes of a text that are looked at together, and of stretches in a block.
SLICE, BLOCK = 1 << 20, 1 << 20
#: Different stretches of one trigger in a block; a trigger with more has its stretches cut.
MOST = 1024
#: Widths of the cuts: windows of a stretch by their distance from the trigger.
WIDTHS = (16, 1)
FACTOR = 0x9E3779B97F4A7C15
STRETCH = "trigger long, context binary, key binary, start long, windows long, at long, copies long"
NAMES = ["trigger", "context", "key", "start", "windows", "at", "copies"]
PLACE = ["trigger", "start", "windows", "at", "copies"]


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` (a power of two) bytes from each position on."""
    hashed = data.astype(np.uint64) + np.uint64(1)
    span, factor = 1, FACTOR
    while span < size:
        hashed = hashed[:-span] * np.uint64(factor) + hashed[span:]
        span, factor = 2 * span, factor * factor % (1 << 64)
    return mix(hashed)


def least(values: np.ndarray, window: int) -> np.ndarray:
    """The least of the ``window`` values from each position on."""
    span = 1
    while 2 * span <= window:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = window - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def stretches_in(
    data: np.ndarray, offsets: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, trigger's place, trigger's hash) of all stretches of the texts.

    A window's trigger is the least of its hashes, the leftmost of equal ones: what the window
    holds decides it.  A stretch is a maximal run of windows of a text with one trigger.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    hashes = rolling(data, gram)
    bits = np.uint64(len(hashes).bit_length())
    ordered = (hashes >> bits << bits) + np.arange(len(hashes), dtype=np.uint64)
    places = (least(ordered, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(
        np.int64
    )
    counts = np.maximum(0, np.diff(offsets) - length + 1)
    windows = np.arange(counts.sum()) + np.repeat(offsets[:-1] - np.cumsum(counts) + counts, counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    at = places[windows]
    if len(at) == 0:
        return none, none, none, none
    begins = np.flatnonzero(
        np.append(True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]))
    )
    sizes = np.diff(np.append(begins, len(at)))
    return windows[begins], sizes, at[begins], hashes[at[begins]].view(np.int64)


def short_hash(value: bytes) -> bytes:
    """128 bits that stand for a string."""
    return hashlib.blake2b(value, digest_size=16).digest()


def stretches(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """A row per stretch of each text; rows without a trigger are windows known to repeat.

    Equal stretches of one text are one row, counted as two, and reported as repeats at once.
    """

    def pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        """Texts (row, first byte, bytes), long ones in slices that share length - 1 bytes."""
        data, offsets = text_bytes(batch.column("text"))
        for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            for first in range(a, max(a + 1, b - length + 1), SLICE):
                yield row, first - a, data[first : min(b, first + SLICE + length - 1)]

    def rows_of(group: list[tuple[int, int, np.ndarray]], keys: list, copies: list) -> list:
        data = np.concatenate([p for _, _, p in group])
        offsets = np.concatenate([[0], np.cumsum([len(p) for _, _, p in group])])
        starts, sizes, places, hashes = stretches_in(data, offsets, length, gram)
        owners = np.searchsorted(offsets, starts, side="right") - 1
        whole, out = data.tobytes(), []
        for start, size, place, hashed, owner in zip(
            starts.tolist(), sizes.tolist(), places.tolist(), hashes.tolist(), owners.tolist()
        ):
            context = short_hash(whole[start : start + size - 1 + length])
            row, first, _ = group[owner]
            begin = first + start - int(offsets[owner])
            out.append((hashed, context, keys[row], begin, size, place - start, copies[row]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            keys, copies = batch.column("key").to_pylist(), batch.column("copies").to_pylist()
            found, group, size = [], [], 0
            for piece in pieces(batch):
                group.append(piece)
                size += len(piece[2])
                if size >= SLICE:
                    found += rows_of(group, keys, copies)
                    group, size = [], 0
            if group:
                found += rows_of(group, keys, copies)
            yield record_batch(once_per_text(found))

    return texts.select("key", "text", "copies").mapInArrow(run, STRETCH)


def once_per_text(rows: list[tuple]) -> list[tuple]:
    """Of a text's equal stretches the first, counted as two; all of them as repeats."""
    times = Counter((r[2], r[1], r[4]) for r in rows)
    if len(times) == len(rows):
        return rows
    out, told = [], set()
    for r in rows:
        name = (r[2], r[1], r[4])
        if times[name] == 1:
            out.append(r)
            continue
        if name not in told:
            told.add(name)
            out.append((*r[:6], 2))
        last = out[-1]
        if last[0] is None and last[2] == r[2] and last[3] + last[4] == r[3]:
            out[-1] = (None, None, r[2], last[3], last[4] + r[4], None, None)
        else:
            out.append((None, None, r[2], r[3], r[4], None, None))
    return out


def record_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Stretches as a batch."""
    columns = list(zip(*rows)) if rows else [()] * 7
    kinds = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)


# A block: the parse, its suffix arrays, and the order they combine into ------------------


def dense_ranks(values: np.ndarray) -> np.ndarray:
    """The rank of each value among the distinct ones, from 1."""
    return np.unique(values, return_inverse=True)[1].ravel() + 1


def doubled(rank: np.ndarray, step: int, ends: np.ndarray) -> np.ndarray:
    """Ranks by what stands ``step`` further on, too; beyond its end a string has rank 0."""
    place = np.arange(len(rank))
    inside = place + step < ends
    after = np.zeros(len(rank), np.int64)
    after[inside] = rank[place[inside] + step]
    return dense_ranks(rank * (int(rank.max(initial=0)) + 1) + after)


def dictionary_order(phrases: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The dictionary's suffix array as ranks: of every suffix of every phrase, by its first
    ``length`` bytes, equal ones alike; and where each phrase begins."""
    sizes = np.array([len(p) for p in phrases], np.int64)
    data = np.frombuffer(b"".join(phrases) + bytes(8), np.uint8)
    ends = np.repeat(np.cumsum(sizes), sizes)
    left = ends - np.arange(len(ends))
    packed = np.zeros(len(ends), np.uint64)
    for k in range(7):
        byte = np.where(left > k, data[k : k + len(ends)], 0).astype(np.uint64)
        packed = packed << np.uint64(8) | byte
    rank = dense_ranks(packed << np.uint64(8) | np.minimum(left, 7).astype(np.uint64))
    depth, longest = 7, min(length, int(sizes.max(initial=0)))
    while depth < longest:
        step = min(depth, length - depth)
        rank = doubled(rank, step, ends)
        depth += step
    return rank, np.cumsum(sizes) - sizes


def parse_order(ranks: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The parse's suffix array: its positions by the phrases from there to the text's end."""
    rank, step = dense_ranks(ranks), 1
    longest = int((ends - np.arange(len(ends))).max(initial=0))
    while step < longest:
        rank = doubled(rank, step, ends)
        step *= 2
    return np.argsort(rank, kind="stable")


def common_prefix(
    data: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray
) -> np.ndarray:
    """How many bytes from x and y on agree, up to ``most``."""
    found = np.zeros(len(x), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        same = data[x[live] + found[live]] == data[y[live] + found[live]]
        live = live[same]
        found[live] += 1
        live = live[found[live] < most[live]]
    return found


class RangeLeast:
    """Least values of ranges of an array, by a sparse table."""

    def __init__(self, values: np.ndarray):
        self.levels, span = [values], 1
        while 2 * span <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-span], last[span:]))
            span *= 2

    def __call__(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least of values[first:end], which must not be empty."""
        level = np.frexp(end - first)[1] - 1
        out = np.empty(len(first), np.int64)
        for k in np.unique(level):
            at = level == k
            left, right = first[at], end[at] - (1 << int(k))
            out[at] = np.minimum(self.levels[k][left], self.levels[k][right])
        return out


def repeated_windows(strings: list[bytes], windows: list[int], length: int = LENGTH) -> np.ndarray:
    """Which of the first windows of each string stand among them more than once.

    The windows of all strings follow one another in the result.  A phrase ends with a trigger
    and begins with the one before, so no suffix of a phrase that holds a trigger begins another:
    suffixes of the text go by the suffix of their phrase, then by the parse behind it.
    """
    data = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    hashes = rolling(data, WORD)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    marks = np.flatnonzero(hashes % np.uint64(EVERY) == 0)
    marks = marks[marks + WORD <= ends[owner[marks]]] + WORD
    cuts = np.unique(np.concatenate([marks, ends]))  # where phrases end
    of_cut = owner[cuts - 1]
    first = np.maximum(begins[of_cut], np.append(0, cuts[:-1]) - WORD)
    whole = data.tobytes()
    phrases = [whole[a:b] for a, b in zip(first.tolist(), cuts.tolist())]
    dictionary = sorted(set(phrases))
    number = {phrase: n for n, phrase in enumerate(dictionary)}
    parse = np.array([number[p] for p in phrases], np.int64)
    suffix_rank, phrase_at = dictionary_order(dictionary, length)

    last_cut = np.searchsorted(cuts, ends)[of_cut] + 1  # the parse of a string ends here
    order = parse_order(parse, last_cut)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    behind = np.append(0, cuts[:-1])  # the text of a phrase without the trigger before it
    x, y = behind[order[:-1]], behind[order[1:]]
    room = np.minimum(ends[of_cut][order[:-1]] - x, ends[of_cut][order[1:]] - y)
    shared = RangeLeast(common_prefix(data, x, y, np.minimum(room, length)))

    counts = np.array(windows, np.int64)
    at = np.arange(counts.sum()) + np.repeat(begins - np.cumsum(counts) + counts, counts)
    cut = np.searchsorted(cuts, at + WORD)
    tail = cuts[cut] - at  # bytes up to the end of the window's first phrase
    phrase = parse[cut]
    lengths = np.array([len(p) for p in dictionary], np.int64)
    suffix = suffix_rank[phrase_at[phrase] + lengths[phrase] - tail]
    long = tail >= length
    rest = np.where(long, 0, place[np.minimum(cut + 1, len(cuts) - 1)])
    order = np.lexsort((rest, suffix))
    x, y = order[:-1], order[1:]
    same = suffix[x] == suffix[y]
    unsure = np.flatnonzero(same & ~long[x])
    a, b = rest[x[unsure]], rest[y[unsure]]
    same[unsure] = shared(a, b) >= length - tail[x[unsure]]
    out = np.zeros(len(at), bool)
    out[x[same]] = True
    out[y[same]] = True
    return out


def flagged_runs(flags: np.ndarray, start: int) -> list[tuple[int, int]]:
    """(first, number) of the runs of flagged windows."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(start + a, b - a) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def in_blocks(contested: DataFrame, length: int) -> DataFrame:
    """(key, start, windows) of windows that repeat among stretches (trigger, ..., bytes).

    Stretches of one trigger stand together; a block ends between triggers.
    """

    def results(block: list[tuple]) -> pa.RecordBatch:
        flags = repeated_windows([r[4] for r in block], [r[3] for r in block], length)
        rows, at = [], 0
        for _, key, start, windows, _, copies in block:
            if copies < 2:
                rows += [(key, *r) for r in flagged_runs(flags[at : at + windows], start)]
            at += windows
        columns = list(zip(*rows)) if rows else [()] * 3
        kinds = [pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "start", "windows"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = [], 0
        for batch in chunks(batches, "bytes", BLOCK):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= BLOCK and row[0] != block[-1][0]:
                    yield results(block)
                    block, size = [], 0
                block.append(row)
                size += len(row[4])
        if block:
            yield results(block)

    rows = contested.select("trigger", "key", "start", "windows", "bytes", "copies")
    dealt = rows.repartition("trigger").sortWithinPartitions("trigger")
    return dealt.mapInArrow(run, "key binary, start long, windows long")


def bytes_of(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Each stretch (key, trigger, start, windows, at, copies) of texts' ``rows`` with its bytes.

    Stretches overlap and can have ``length`` times their text's bytes: a batch has about SLICE.
    """

    def result(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.binary(), *[pa.int64()] * len(PLACE), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", *PLACE, "bytes"]
        )

    for batch in batches:
        out, size = [], 0
        for key, text, rows in zip(*(batch.column(c) for c in ("key", "text", "rows"))):
            name, data = key.as_py(), text.as_py().encode()
            for place in zip(*(rows.values.field(c).to_numpy().tolist() for c in PLACE)):
                part = data[place[1] : place[1] + place[2] - 1 + length]
                out.append((name, *place, part))
                size += len(part)
                if size >= SLICE:
                    yield result(out)
                    out, size = [], 0
        if out:
            yield result(out)


def with_bytes(wanted: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The stretches with their bytes; the texts stay where they are."""
    per_text = wanted.groupBy("key").agg(F.collect_list(F.struct(*PLACE)).alias("rows"))
    schema = f"key binary, {', '.join(f'{c} long' for c in PLACE)}, bytes binary"
    joined = texts.join(per_text, "key").select("key", "text", "rows")
    return joined.mapInArrow(lambda batches: bytes_of(batches, length), schema)


def cut_stretches(hot: DataFrame, width: int, length: int) -> DataFrame:
    """Stretches (with bytes) cut into classes of ``width`` distances from their trigger.

    A class's new trigger is what all its windows share: length - width + 1 bytes.  A class of
    one distance is one window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "bytes", SLICE):
            rows = []
            for key, start, windows, at, copies, data in zip(
                *(batch.column(c).to_pylist() for c in
                  ("key", "start", "windows", "at", "copies", "bytes"))
            ):
                first = 0
                while first < windows:  # window ``first`` is ``at - first`` before the trigger
                    nearest = (at - first) // width * width
                    end = min(windows, at - nearest + 1)
                    common = data[at - nearest : at - nearest + length - width + 1]
                    mark = int.from_bytes(short_hash(common)[:8], "little", signed=True)
                    context = short_hash(data[first : end - 1 + length])
                    rows.append((mark, context, key, start + first, end - first, at - first, copies))
                    first = end
            yield record_batch(rows)

    return hot.mapInArrow(run, STRETCH)


# The corpus -------------------------------------------------------------------------------


def text_key(text: Column) -> Column:
    """128 bits of a text's SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """The distinct texts (key, text, copies), kept where their keys are dealt to."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(text_key(text).alias("key"), text.alias("text"))
    distinct = keyed.groupBy("key").agg(
        F.first("text").alias("text"), F.count("*").alias("copies")
    )
    return kept(distinct, adaptive=False)


def repeats(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, start, windows): windows of the distinct texts that start anywhere else, too.

    Texts with copies are whole repeats and not among the rows, but repeat others.
    """
    # Each task writes a file: as many as keep the cores busy, with 20,000 texts or so.
    cores = texts.sparkSession.sparkContext.defaultParallelism
    tasks = max(4 * cores, texts.count() // 20_000 + 1)
    found = texts.where(F.octet_length("text") >= length).coalesce(tasks)
    rows = written(stretches(found, length, gram), "stretches")
    known = rows.where("trigger is null").select("key", "start", "windows")
    rows = rows.where("trigger is not null")
    parts = [known]
    for width in (*WIDTHS, None):
        shared = rows.groupBy("trigger").agg(F.count("*").alias("n")).where("n > 1")
        # Equal stretches of one text were counted as one, but have told of themselves.
        rows = packed(rows.join(shared.select("trigger"), "trigger", "left_semi"), "shared")
        classes = packed(
            rows.groupBy("trigger", "context").agg(
                F.sum(F.least("copies", F.lit(2))).alias("copies"),
                F.min(F.struct("key", "start", "windows", "at")).alias("one"),
            ),
            "classes",
        )
        equal = classes.where("copies > 1").select("trigger", "context")
        lone = rows.where("copies = 1").join(equal, ["trigger", "context"], "left_semi")
        parts.append(lone.select("key", "start", "windows"))
        unlike = classes.groupBy("trigger").agg(F.count("*").alias("kinds")).where("kinds > 1")
        contested = classes.select("trigger", "copies", "one.*").join(unlike, "trigger")
        few = contested.where(F.col("kinds") <= MOST) if width else contested
        parts.append(in_blocks(with_bytes(few, texts, length), length))
        if width is None or not unlike.where(F.col("kinds") > MOST).limit(1).count():
            break
        many = with_bytes(contested.where(F.col("kinds") > MOST), texts, length)
        rows = packed(cut_stretches(many, width, length), "cuts")
    union = parts[0]
    for part in parts[1:]:
        union = union.union(part)
    return union


def cut_texts(texts: DataFrame, windows: DataFrame, length: int) -> DataFrame:
    """(key, n_removed, n_spans, kept) of the texts with repeated windows.

    ``kept`` is the text's remaining bytes.
    """
    per_text = windows.groupBy("key").agg(
        F.collect_list(F.struct("start", "windows")).alias("runs")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, removed, spans, kept = [], [], [], []
            for key, text, runs in zip(*(batch.column(c) for c in ("key", "text", "runs"))):
                data = text.as_py().encode()
                starts = runs.values.field("start").to_numpy()
                ends = starts + runs.values.field("windows").to_numpy() - 1 + length
                order = np.argsort(starts)
                starts, ends = starts[order], np.maximum.accumulate(ends[order])
                new = np.append(True, starts[1:] > ends[:-1])
                first, last = starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, -1)]
                edges = [0, *np.column_stack([first, last]).ravel().tolist(), len(data)]
                keys.append(key.as_py())
                removed.append(int((last - first).sum()))
                spans.append(len(first))
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()), pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()), pa.array(kept, pa.binary()),
                ],
                ["key", "n_removed", "n_spans", "kept"],
            )

    joined = texts.join(per_text, "key").select("key", "text", "runs")
    return joined.mapInArrow(run, "key binary, n_removed long, n_spans long, kept binary")


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Each document without its repeated bytes: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if it lies in a string of ``length`` bytes that starts at another place of any
    document, the same one included.  Texts are UTF-8, matches lie within one document, and
    strings are judged on the input.  A null text is empty; texts shorter than ``length`` lose
    nothing.  Equal texts, repeated rows among them, are parsed once and lose everything.  Rows
    without an id are documents like others.
    """
    texts = distinct_texts(docs)
    windows = repeats(texts, length, gram)
    # A text with copies goes whole; its windows still repeat others'.
    cut = cut_texts(texts.where("copies = 1"), windows, length).select(
        "key", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
    whole = texts.where((F.col("copies") > 1) & (F.octet_length("text") >= length)).select(
        "key",
        F.octet_length("text").cast("long").alias("n_removed"),
        F.lit(1).cast("long").alias("n_spans"),
        F.sha2(F.lit(""), 256).alias("kept_sha256"),
    )
    changed = packed(cut.union(whole), "changed")
    texts.unpersist()
    # A hundred bytes a document: few files, however many partitions the texts needed.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    pieces = max(cores, docs.count() // 100_000 + 1)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("sha256"),
    )
    key = F.unhex(F.substring("sha256", 1, 32))
    joined = rows.withColumn("key", key).join(changed, "key", "left")
    return joined.coalesce(pieces).select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )
