"""Shared helpers: texts as bytes, words, hashes, tables on the way, distributed ranks."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerweave.sources.tables import scratch_path

CHUNK_BYTES = 1 << 20
WORD_FACTOR = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the folder all executors share: lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, adaptive: bool = True) -> DataFrame:
    """The rows, computed when first needed, on the executors' disks until ``unpersist``.

    An adaptive plan splits skewed joins; one that isn't leaves the rows partitioned as they were,
    so that joins by the same key need no exchange.
    """
    conf, name = df.sparkSession.conf, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = conf.get(name)
    conf.set(name, str(adaptive).lower())
    try:
        return df.persist(StorageLevel.DISK_ONLY)
    finally:
        conf.set(name, before)


def packed(df: DataFrame, name: str) -> DataFrame:
    """As ``written``, in few files however many partitions the rows were made in.

    Without Hadoop's native library each file starts several processes (chmod), which share their
    executor's memory until they run.  So the rows are computed once, with all tasks, wait on the
    executors' disks, and go to a file per core or million rows.
    """
    rows = kept(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    out = written(rows.coalesce(max(cores, rows.count() // 1_000_000 + 1)), name)
    rows.unpersist()
    return out


def learnable(id_column: str = "doc_id") -> Column:
    """Rows that training may use: crc32 of the id as text is not divisible by five.  A row
    without an id isn't used."""
    return F.crc32(F.col(id_column).cast("string")) % 5 != 0


def held_out(id_column: str = "doc_id") -> Column:
    """Rows kept from training for good; a row without an id counts as one."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(True))


def hash_sample(df: DataFrame, key: str, target: int, total: int, seed: int = 0) -> DataFrame:
    """About ``target`` of ``total`` rows, chosen by a hash of the key: the same on each run.

    The number drawn is binomial, so it exceeds the target by a few square roots at most.
    """
    if total <= target:
        return df
    share = target / total
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 40)) < int(share * (1 << 40))
    return df.where(drawn)


def exclusive_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    rows: int,
    rows_per_bucket: int = 2000,
) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the same group, for groups of any size.

    Rows are dealt into hash buckets of a bounded size and ordered within them; a second,
    small window adds up the buckets.  So a hot group is spread over many tasks.  Rows equal
    in ``by`` and ``order`` are interchangeable.
    """
    buckets = max(1, math.ceil(rows / rows_per_bucket))
    dealt = df.withColumns(
        {"_bucket": F.pmod(F.xxhash64(*order), F.lit(buckets)), "_value": value}
    )
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy(*by, "_bucket")
        .agg(F.sum("_value").alias("_sum"))
        .select(*by, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    )
    within = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = F.coalesce(F.sum("_value").over(within), F.lit(0))
    return (
        dealt.withColumn("_local", local)
        .join(bases, [*by, "_bucket"])
        .withColumn(out, F.col("_base") + F.col("_local"))
        .drop("_bucket", "_value", "_local", "_base")
    )


# Texts inside tasks ------------------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``most`` bytes of text, or of one longer text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(
            zero_copy_only=False
        )
        ends = np.cumsum(lengths)
        start = 0
        while start < len(ends):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in the given inclusive ranges."""
    member = np.zeros(256, bool)
    for first, last in ranges:
        member[first : last + 1] = True
    return member


WHITE = byte_class((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every maximal run within a text."""
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    last = first_ends(offsets)
    stops[last] = inside[last]
    return starts, np.flatnonzero(stops) + 1


def first_ends(offsets: np.ndarray) -> np.ndarray:
    """The last byte of every text that has one."""
    return offsets[1:][offsets[:-1] < offsets[1:]] - 1


def per_text(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of sorted positions before each text's begin: a text owns those up to the next."""
    return np.searchsorted(positions, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    begin = np.cumsum(lengths) - lengths
    place = np.arange(total) - np.repeat(begin, lengths)
    source = place + np.repeat(starts, lengths)
    powers = np.cumprod(
        np.concatenate([[1], np.full(int(lengths.max()), WORD_FACTOR, np.uint64)]).astype(np.uint64)
    )
    terms = (data[source].astype(np.uint64) + np.uint64(1)) * powers[place]
    return mix(np.add.reduceat(terms, begin) + lengths.astype(np.uint64))


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Lists of the given lengths cut from one flat array."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def append_columns(
    docs: DataFrame, compute, names: Sequence[str], types: Sequence[str]
) -> DataFrame:
    """All columns of ``docs`` and those that ``compute(batch)`` returns as Arrow arrays."""
    schema = docs.schema
    for name, kind in zip(names, types):
        schema = type(schema)(schema.fields[:]).add(name, kind)
    columns = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *compute(batch)], columns)

    return docs.mapInArrow(run, schema)


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that no column of ``docs`` has, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
