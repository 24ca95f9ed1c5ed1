"""Mixing sources to target weights from shuffled blocks of fixed length."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.llm.common import (
    WHITE,
    append_columns,
    chunks,
    exclusive_total,
    free_name,
    per_text,
    runs,
    text_bytes,
    written,
)

BLOCK_WORDS = 128
SHARD_BLOCKS = 4096
MAX_EPOCHS = 3
SHARD_GROUP = 1024
TASK_SHARDS = 8
SEED = 17


def word_counts(batch: pa.RecordBatch) -> pa.Array:
    """Number of runs of anything but the six ASCII white-space characters."""
    data, offsets = text_bytes(batch.column("text"))
    starts, _ = runs(~WHITE[data], offsets)
    return pa.array(np.diff(per_text(starts, offsets)), pa.int64())


def water_fill(sizes: list[int], weights: list[float], most: int = MAX_EPOCHS) -> list[float]:
    """Shares of the whole by weight, none above ``most`` times a source's size.

    What a source can't take is shared by weight among the others, until none is above.
    """
    targets, left, active = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while active:
        weight = sum(weights[i] for i in active)
        full = [i for i in active if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in active:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = float(most * sizes[i])
        left -= sum(targets[i] for i in full)
        active -= set(full)
    return targets


def recipe(rows: DataFrame, block_words: int) -> DataFrame:
    """One row per source: its number by code point (null last), size, target, blocks, slots.

    The sources are the entries of a mixing recipe, so they are few enough for the driver.
    """
    totals = [tuple(r) for r in rows.groupBy("source").agg(F.sum("size")).collect()]
    totals.sort(key=lambda r: (r[0] is None, (r[0] or "").encode()))
    sizes = [int(r[1]) for r in totals]
    targets = water_fill(sizes, [1 + i % 3 for i in range(len(sizes))])
    out = []
    for number, (name, size) in enumerate(totals):
        blocks = math.ceil(size / block_words)
        # The last block may be short, so a slot counts as the mean block.
        slots = round(targets[number] * blocks / size) if size else 0
        slots = min(slots, MAX_EPOCHS * blocks)
        out.append((name, number, int(size), targets[number], blocks, slots))
    schema = (
        "source string, number int, source_size long, target double, blocks long, slots long"
    )
    return rows.sparkSession.createDataFrame(out, schema)


def shard_counts(sources: DataFrame, shard_blocks: int, seed: int) -> DataFrame:
    """How many blocks of each source every output shard gets, and the count before it.

    Every shard draws its counts from a multinomial with the sources' shares, by a seed of
    its own.  Draws beyond a source's slots are handed, in shard order, to the sources that
    the draws left short, so each source ends with exactly its slots.
    """
    wanted = [tuple(r) for r in sources.orderBy("number").select("slots", "blocks").collect()]
    slots = np.array([s for s, _ in wanted], np.int64)
    total = int(slots.sum())
    shards = math.ceil(total / shard_blocks)
    shares = slots / max(1, total)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard in pdf["id"]:
                size = min(shard_blocks, total - int(shard) * shard_blocks)
                drawn = np.random.default_rng([seed, int(shard)]).multinomial(size, shares)
                yield pd.DataFrame(
                    {"shard": shard, "number": np.arange(len(drawn)), "drawn": drawn}
                )

    spark = sources.sparkSession
    draws = spark.range(shards).mapInPandas(draw, "shard long, number int, drawn long")
    draws = written(draws, "draws").withColumn("part", F.floor(F.col("shard") / SHARD_GROUP))
    draws = _before(draws, ["number"], "drawn", "before").join(
        sources.select("number", "slots", "blocks"), "number"
    )
    draws = draws.withColumn(
        "own", F.greatest(F.lit(0), F.least("drawn", F.col("slots") - F.col("before")))
    ).withColumn("surplus", F.col("drawn") - F.col("own"))
    spare = draws.groupBy("shard", "part").agg(F.sum("surplus").alias("spare"))
    spare = _before(spare.withColumn("all", F.lit(0)), ["all"], "spare", "spare_before")
    short = draws.groupBy("number").agg(F.sum("own").alias("got"), F.first("slots").alias("s"))
    by_number = Window.partitionBy(F.lit(0)).orderBy("number")
    short = short.select(
        "number",
        (F.col("s") - F.col("got")).alias("lack"),
        (
            F.sum(F.col("s") - F.col("got")).over(by_number) - (F.col("s") - F.col("got"))
        ).alias("lack_from"),
    )
    inside = lambda at: F.greatest(
        F.lit(0), F.least(at - F.col("lack_from"), F.col("lack"))
    )
    joined = draws.join(short, "number").join(spare.drop("part", "all"), "shard")
    filled_before = inside(F.col("spare_before"))
    filled = inside(F.col("spare_before") + F.col("spare"))
    return joined.select(
        "shard",
        "number",
        "blocks",
        (F.col("own") + filled - filled_before).alias("count"),
        (F.least("before", "slots") + filled_before).alias("first"),
    ).where("count > 0")


def draw_slots(counts: DataFrame, tasks: int, seed: int) -> DataFrame:
    """(shard, number, slot, block) of every output slot.

    A source's slots run on over the shards.  Each full round over its blocks is one epoch
    and goes through a permutation of its own, so no block comes again before all have come.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard, number, blocks, count, first in pdf.itertuples(index=False):
                slot = np.arange(first, first + count)
                block = np.empty(count, np.int64)
                for epoch in np.unique(slot // blocks):
                    here = slot // blocks == epoch
                    key = (seed, number, int(epoch))
                    block[here] = permuted(slot[here] % blocks, int(blocks), key)
                yield pd.DataFrame(
                    {"shard": shard, "number": number, "slot": slot, "block": block}
                )

    columns = counts.select("shard", "number", "blocks", "count", "first")
    return columns.repartition(tasks, "shard").mapInPandas(
        run, "shard long, number int, slot long, block long"
    )


def permuted(index: np.ndarray, n: int, key: tuple[int, ...]) -> np.ndarray:
    """Images of indices under a pseudorandom permutation of 0..n-1.

    A four-round Feistel network over the next even number of bits; images outside the range
    go through it again until they are inside.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(list(key)).integers(1, 1 << 62, 4, dtype=np.uint64)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def mix_sources(
    docs: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The drawn pieces, and the placed documents with their source's figures.

    Documents of a source stand in one stream of words, cut into blocks.  Pieces: shard,
    slot, block, number, at (a document's place in the stream), doc_id, start, length in words.
    Documents: doc_id, number, at, size, source_size, target.  Null and empty texts have size
    0 and are never drawn.  A null source is a source.  Repeated rows are rows of their own.
    An empty table gives empty results.  The same table gives the same mix on each run.
    """
    sized = append_columns(
        docs.select(
            F.col("doc_id").cast("long"),
            F.col("source").cast("string"),
            F.xxhash64("text").alias("text_hash"),
            "text",
        ),
        lambda batch: [word_counts(batch)],
        ["size"],
        ["long"],
    ).drop("text")
    rows = written(sized, "sizes")
    sources = recipe(rows, block_words)
    numbered = rows.join(
        F.broadcast(sources.select("source", "number", "source_size", "target")),
        rows["source"].eqNullSafe(sources["source"]),
    ).select("doc_id", rows["source"], "text_hash", "number", "size", "source_size", "target")
    placed = exclusive_total(
        numbered, ["number"], ["doc_id", "text_hash"], F.col("size"), "at", rows.count()
    )
    placed = written(placed, "placed")
    first = F.floor(F.col("at") / block_words)
    last = F.floor((F.col("at") + F.col("size") - 1) / block_words)
    parts = placed.where("size > 0").select(
        "doc_id", "number", "at", "size", F.explode(F.sequence(first, last)).alias("block")
    )
    begin = F.greatest(F.col("at"), F.col("block") * block_words)
    end = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words)
    parts = parts.select(
        "doc_id", "number", "at", "block", (begin - F.col("at")).alias("start"),
        (end - begin).alias("length"),
    )
    wanted = sources.agg(F.sum("slots")).first()[0] or 0
    tasks = max(1, math.ceil(wanted / (shard_blocks * TASK_SHARDS)))
    slots = draw_slots(shard_counts(sources, shard_blocks, seed), tasks, seed)
    # Sizes of what Python makes are guesses, so no side may be broadcast by them.
    return slots.hint("merge").join(parts, ["number", "block"]), placed


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    pieces, placed = mix_sources(docs, **options)
    drawn = pieces.groupBy("number", "at").agg(F.sum("length").alias("drawn"))
    taken = F.when(F.col("size") > 0, F.coalesce("drawn", F.lit(0))).otherwise(0)
    return placed.join(drawn, ["number", "at"], "left").select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of ``docs``: one for each document and epoch, its text what was drawn.

    The words keep their order and the white space between neighbours; n_chars, where there
    is such a column, follows the new text.
    """
    pieces, placed = mix_sources(docs, **options)
    blocks = placed.groupBy("number").agg(
        F.ceil(F.sum("size") / options.get("block_words", BLOCK_WORDS)).alias("blocks")
    )
    plan = (
        pieces.join(F.broadcast(blocks), "number")
        .withColumn("epoch", F.floor(F.col("slot") / F.col("blocks")))
        .groupBy("number", "at", "doc_id", "epoch")
        .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("parts"))
        .groupBy("number", "at", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("epoch", "parts"))).alias("epochs"))
    )
    text_key, plan_name = free_name(docs, "_text_key"), free_name(docs, "_plan")
    kind = ["doc_id", "source", text_key]
    # Rows alike in id, source and text are one document, drawn as often as all of them.
    plans = (
        placed.where("size > 0")
        .join(plan.drop("doc_id"), ["number", "at"])
        .groupBy("doc_id", "source", F.col("text_hash").alias(text_key))
        .agg(F.flatten(F.collect_list("epochs")).alias(plan_name))
    )
    rows = docs.withColumn(text_key, F.xxhash64("text"))
    key = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in kind))
    rows = rows.withColumn(text_key, key)
    plans = plans.select(key.alias(text_key), plan_name)
    once = rows.dropDuplicates([text_key])
    return _cut(once.join(plans, text_key).select(*docs.columns, plan_name), docs, plan_name)


def _cut(rows: DataFrame, docs: DataFrame, plan: str) -> DataFrame:
    columns, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = text_bytes(batch.column("text"))
            starts, ends = runs(~WHITE[data], offsets)
            first = per_text(starts, offsets)
            source_row, texts = [], []
            for i, epochs in enumerate(batch.column(plan).to_pylist()):
                for epoch in epochs:
                    drawn = []
                    for a, b in joined_parts(epoch["parts"]):
                        span = slice(starts[first[i] + a], ends[first[i] + b - 1])
                        drawn.append(data[span].tobytes())
                    source_row.append(i)
                    texts.append(b" ".join(drawn).decode())
            taken = batch.take(pa.array(source_row, pa.int64()))
            new = {"text": texts, "n_chars": [len(t) for t in texts]}
            arrays = [
                pa.array(new[c]).cast(taken.column(c).type) if c in new else taken.column(c)
                for c in columns
            ]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return rows.mapInArrow(run, schema)


def joined_parts(parts: list[dict]) -> list[tuple[int, int]]:
    """Sorted pieces as ranges of words, neighbours made one."""
    out: list[tuple[int, int]] = []
    for part in parts:
        a, b = part["start"], part["start"] + part["length"]
        if out and out[-1][1] == a:
            a = out.pop()[0]
        out.append((a, b))
    return out


def _before(df: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """Sum of a value over earlier shards, by groups of shards and then within a group."""
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = (
        Window.partitionBy(*by, "part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    )
    zero: Column = F.lit(0)
    bases = df.groupBy(*by, "part").agg(F.sum(value).alias("_sum"))
    bases = bases.select(*by, "part", F.coalesce(F.sum("_sum").over(earlier), zero).alias("_base"))
    return (
        df.withColumn("_local", F.coalesce(F.sum(value).over(within), zero))
        .join(bases, [*by, "part"])
        .withColumn(out, F.col("_base") + F.col("_local"))
        .drop("_base", "_local")
    )
