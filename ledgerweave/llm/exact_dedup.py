"""Exact dedup by a minimal perfect hash over the digests already seen."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import append_columns, chunks, free_name, written

BUCKET_KEYS = 2000
KEYS_PER_SEED = 4
CLASS_SCHEMA = "digest binary, keep_id long, group_size long, seen boolean"
STORE_SCHEMA = (
    "bucket long, seeds array<long>, digests array<binary>, keep array<long>, sizes array<long>"
)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of each row: SHA-256 of the text's UTF-8 with A-Z lower-cased."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), digest_array(batch)], ["doc_id", "digest"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, digest binary"
    )


def digest_array(batch: pa.RecordBatch) -> pa.Array:
    """The digests of a batch's texts; bytes.lower() changes A-Z alone."""
    texts = batch.column("text").cast(pa.large_binary()).to_pylist()
    return pa.array([hashlib.sha256((t or b"").lower()).digest() for t in texts], pa.binary())


def bucket_of(buckets: int) -> Column:
    """A digest's bucket: its first seven bytes are uniform already."""
    return F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long") % buckets


def build_store(history: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of historical digests, each a minimal perfect hash.

    A key's slot follows from its own hash and a seed shared by a few keys.  Slot i holds the
    full digest, the id that stays and the number of rows.  ``history`` has distinct digests
    with keep_id and group_size.
    """

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = pdf["digest"].tolist()
        seeds, slots = perfect_hash(keys)
        order = np.empty(len(keys), np.int64)
        order[slots] = np.arange(len(keys))
        return pd.DataFrame(
            {
                "bucket": [pdf["bucket"].iloc[0]],
                "seeds": [seeds.tolist()],
                "digests": [[keys[i] for i in order]],
                "keep": [[None if pd.isna(v) else int(v) for v in pdf["keep_id"].iloc[order]]],
                "sizes": [pdf["group_size"].iloc[order].tolist()],
            }
        )

    keyed = history.withColumn("bucket", bucket_of(buckets))
    return keyed.groupBy("bucket").applyInPandas(build, STORE_SCHEMA)


def look_up(store: DataFrame, batch: DataFrame, buckets: int) -> DataFrame:
    """Classes of history and batch together.

    Each distinct digest of the batch goes to its bucket's slot.  Only where the slot's full
    digest equals it byte for byte is it a repeat; the hash sends everything else to some slot
    too, and those group by themselves.
    """

    def probe(stored: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(stored):
            held = list(stored.iloc[0]["digests"])
            keep, sizes = list(stored.iloc[0]["keep"]), list(stored.iloc[0]["sizes"])
            keep = [None if v is None or v != v else int(v) for v in keep]
            seeds = np.asarray(stored.iloc[0]["seeds"], np.int64)
        else:
            held, keep, sizes, seeds = [], [], [], np.zeros(0, np.int64)
        keys = asked["digest"].tolist()
        slots = slots_of(keys, seeds, len(held))
        for key, slot, last, size in zip(keys, slots, asked["keep_id"], asked["group_size"]):
            last = None if pd.isna(last) else int(last)
            if len(held) and held[slot] == key:
                known = [v for v in (keep[slot], last) if v is not None]
                keep[slot], sizes[slot] = max(known, default=None), sizes[slot] + size
            else:
                rows.append((key, last, size, False))
        rows += [(d, k, s, True) for d, k, s in zip(held, keep, sizes)]
        out = pd.DataFrame(rows, columns=["digest", "keep_id", "group_size", "seen"])
        return out.astype({"keep_id": "Int64"})

    keyed = batch.withColumn("bucket", bucket_of(buckets))
    return (
        store.groupBy("bucket").cogroup(keyed.groupBy("bucket")).applyInPandas(probe, CLASS_SCHEMA)
    )


def exact_dedup(docs: DataFrame, is_history: Column) -> DataFrame:
    """Which documents stay: doc_id, keep_id, group_size, kept, seen, text_sha256.

    ``is_history`` splits the rows into those already stored and a new batch.  Of equal
    texts the row with the largest doc_id stays.  Null texts equal the empty text.  Rows equal
    in id and text are one document, returned once and counted each in group_size.  A row
    without an id stays only if no equal text has one.  ``seen``: the history has the text.
    Groups are summed before any shuffle, so many copies of one text cost one row per task.
    """
    rows = written(
        digests(docs).groupBy("doc_id", "digest").agg(F.count("*").alias("copies")), "digests"
    )
    buckets = max(1, math.ceil(rows.count() / BUCKET_KEYS))

    def distinct(part: DataFrame) -> DataFrame:
        return part.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
        )

    old = F.coalesce(is_history, F.lit(False))
    store = written(build_store(distinct(rows.where(old)), buckets), "digest-store")
    classes = look_up(store, distinct(rows.where(~old)), buckets)
    return rows.join(classes, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "seen",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def earlier_half(docs: DataFrame) -> Column:
    """Condition for the lower half of the range of ids: what counts as history by default."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return F.col("doc_id") < F.lit(((low or 0) + (high or 0) + 1) // 2)


def keep_latest(docs: DataFrame) -> DataFrame:
    """The rows of the documents that stay, with all their columns, each once."""
    digest, key = free_name(docs, "_digest"), free_name(docs, "_key")
    kept = exact_dedup(docs, earlier_half(docs)).where("kept")
    kept = kept.select(_key_of("doc_id").alias(key), F.unhex("text_sha256").alias(digest))
    rows = append_columns(docs, lambda batch: [digest_array(batch)], [digest], ["binary"])
    # One id may stand on several texts, so the digest has to agree as well.
    matched = rows.withColumn(key, _key_of("doc_id")).join(kept, [key, digest])
    return matched.dropDuplicates([key, digest]).select(*docs.columns)


def _key_of(column: str) -> Column:
    """An id as a join key: null equals null."""
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


# The hash ----------------------------------------------------------------------------


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 4)
    return words[:, 1], words[:, 2], words[:, 3] | np.uint64(1)


def perfect_hash(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Seeds and each key's slot, for distinct 32-byte keys.

    Keys share a seed in groups of about four.  The largest groups look first for a seed
    that sends all their keys to free slots; single keys take what is left, and their seed
    then names the slot itself, as -1 - slot.
    """
    n = len(keys)
    groups = math.ceil(n / KEYS_PER_SEED)
    seeds, slots = np.zeros(groups, np.int64), np.zeros(n, np.int64)
    a, b, c = _halves(keys)
    group = (a % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(groups + 1))
    taken = np.zeros(n, bool)
    tries = np.arange(1, 65, dtype=np.uint64)
    for g in np.argsort(-(edges[1:] - edges[:-1]), kind="stable"):
        members = order[edges[g] : edges[g + 1]]
        if len(members) < 2:
            break
        seed = None
        first = np.uint64(0)
        while seed is None:
            rounds = tries + first
            spots = (b[members][None, :] + rounds[:, None] * c[members][None, :]) >> np.uint64(11)
            spots = np.sort(spots % np.uint64(n), axis=1).astype(np.int64)
            fits = ~taken[spots].any(1) & (np.diff(spots, axis=1) > 0).all(1)
            if fits.any():
                seed = int(rounds[fits.argmax()])
            first += np.uint64(len(tries))
        spot = (b[members] + np.uint64(seed) * c[members]) >> np.uint64(11)
        slots[members] = (spot % np.uint64(n)).astype(np.int64)
        taken[slots[members]] = True
        seeds[g] = seed
    single = [g for g in range(groups) if edges[g + 1] - edges[g] == 1]
    free = np.flatnonzero(~taken)
    for g, slot in zip(single, free):
        seeds[g], slots[order[edges[g]]] = -1 - slot, slot
    return seeds, slots


def slots_of(keys: list[bytes], seeds: np.ndarray, n: int) -> np.ndarray:
    """The slot of each key in a hash of n keys; anything for keys that aren't in it."""
    if not keys or n == 0:
        return np.zeros(len(keys), np.int64)
    a, b, c = _halves(keys)
    seed = seeds[(a % np.uint64(len(seeds))).astype(np.int64)]
    spot = (b + np.abs(seed).astype(np.uint64) * c) >> np.uint64(11)
    return np.where(seed < 0, -1 - seed, (spot % np.uint64(n)).astype(np.int64))
