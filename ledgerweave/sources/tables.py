"""Writing tables in a clustered layout, and reading them back."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerweave.sources.schema import LAYOUTS, Layout, row_key

ROWS_PER_FILE = 2_500_000  # about 128 MB of ledger rows
BYTES_PER_FILE = 128 << 20
TRIAL_ROWS = 400_000  # written to see how many bytes a row takes
TRIAL_FILES = 4
ZORDER_BITS = 6
FINE_RANGES = 4


def file_count(rows: int, rows_per_file: int = ROWS_PER_FILE) -> int:
    """How many files hold ``rows`` rows."""
    return max(1, math.ceil(rows / rows_per_file))


def rows_per_file(rows: int, least: int, files: int) -> int:
    """How many rows of a table a file holds: ``least``, or more if that made over ``files``.

    Beyond ROWS_PER_FILE a file doesn't grow; then there are more files.
    """
    return max(least, min(ROWS_PER_FILE, math.ceil(rows / files)))


def size_files(df: DataFrame, rows: int, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Spread rows evenly over the number of files they need."""
    return df.repartition(file_count(rows, rows_per_file))


def file_sizes(spark: SparkSession, target: str) -> DataFrame:
    """The bytes of each data file of a saved table; only the files' list is read."""
    place = target if "/" in target else _location(spark, target)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.option("pathGlobFilter", "*.parquet").load(place).select("path", "length")


def saved_row_bytes(spark: SparkSession, target: str) -> float:
    """How many bytes of its files a row of a saved table takes; 0 if it has no rows.

    Read from the files' list and their footers.
    """
    rows = read_table(spark, target).count()
    return file_sizes(spark, target).agg(F.sum("length")).first()[0] / rows if rows else 0.0


def trial_row_bytes(df: DataFrame, rows: int, trial_rows: int = TRIAL_ROWS) -> float:
    """How many bytes of a file a row takes, by writing a sample of about ``trial_rows`` rows."""
    spark = df.sparkSession
    path = scratch_path(spark, "trial")
    sample = df if rows <= trial_rows else df.sample(trial_rows / rows, seed=1)
    save_table(sample.repartition(TRIAL_FILES), path, rows_per_file=0)
    return saved_row_bytes(spark, path)


def save_by_bytes(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    rows: int | None = None,
    bytes_per_file: int = BYTES_PER_FILE,
    row_bytes: float | None = None,
) -> int:
    """Write a table in files of about ``bytes_per_file``, whatever its rows' width.

    An append takes the width from the table's own files, another write from a trial, unless
    ``row_bytes`` says it.  Rows are dealt round, so files differ little even where wide rows
    stand together.  Returns the number of files.
    """
    spark = df.sparkSession
    rows = df.count() if rows is None else rows
    if row_bytes is None and mode == "append" and _exists(spark, target):
        row_bytes = saved_row_bytes(spark, target)
    row_bytes = row_bytes or (trial_row_bytes(df, rows) if rows else 0.0)
    files = max(1, round(rows * row_bytes / bytes_per_file))
    save_table(df.repartition(files), target, mode=mode, rows_per_file=0)
    return files


def _exists(spark: SparkSession, target: str) -> bool:
    """Whether there is such a table."""
    if "/" not in target:
        return spark.catalog.tableExists(target)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.exists(place)


def cluster(
    df: DataFrame, by: Sequence[str], row_id: str, partitions: int | None = None
) -> DataFrame:
    """Rows with nearby values of ``by`` in the same partition, and sorted in it.

    The row id closes the range key, so the rows of one hot value are split over as many
    partitions as they need.  Without ``partitions`` the number follows the data's size.
    """
    keys = [F.col(c) for c in (*by, row_id)]
    ranged = (
        df.repartitionByRange(*keys)
        if partitions is None
        else df.repartitionByRange(partitions, *keys)
    )
    return ranged.sortWithinPartitions(*by)


def zorder_key(df: DataFrame, by: Sequence[str], bits: int = ZORDER_BITS) -> Column:
    """The interleaved bits of several columns, each cut into 2^bits cells of equal depth.

    Sorting by it keeps rows close in every column together.
    """
    key = F.lit(0).cast("bigint")
    for i, column in enumerate(by):
        cell = _cell(F.col(column), equal_depth_bounds(df, column, 1 << bits), 1 << bits)
        for bit in range(bits):
            one = F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(by) + i))
    return key


def equal_depth_bounds(df: DataFrame, column: str, cells: int) -> list:
    """The least value of each but the first of ``cells`` ranges with about as many rows each.

    Spark's range exchange deals the column, in its own order and type, into a few times as
    many fine ranges from a sample; their exact counts then say where each cell begins.  A
    value that fills several cells takes one.  Only the fine ranges come back.
    """
    fine = cells * FINE_RANGES
    ranged = df.select(column).where(F.col(column).isNotNull()).repartitionByRange(fine, column)
    found = (
        ranged.groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min(column).alias("least"), F.count("*").alias("rows"))
        .orderBy("range")
        .collect()
    )
    total, before, bounds = sum(r["rows"] for r in found), 0, []
    for r in found:
        # The range begins the next cell if that is nearer than the cell's end is.
        if before and (before + r["rows"] / 2) * cells >= (len(bounds) + 1) * total:
            bounds.append(r["least"])
        before += r["rows"]
    return bounds


def zorder(
    df: DataFrame, by: Sequence[str], row_id: str, partitions: int | None = None
) -> DataFrame:
    """``cluster`` along the interleaved key of several columns."""
    keyed = df.withColumn("_zorder", zorder_key(df, by))
    return cluster(keyed, ["_zorder"], row_id, partitions).drop("_zorder")


def save_table(
    df: DataFrame,
    target: str,
    layout: Layout = Layout(),
    row_id: str | None = None,
    rows: int | None = None,
    mode: str = "overwrite",
    rows_per_file: int = ROWS_PER_FILE,
    already_partitioned: bool = False,
    buckets: int | None = None,
    bucket_by: Sequence[str] = (),
) -> None:
    """Write a table, by catalog name or by path (anything with a slash).

    A layout ranges the rows by partition and cluster columns before the write, so a task
    touches few partitions and every file covers a narrow range of the cluster columns.
    ``already_partitioned`` rows are only sorted where they are.  An overwrite is written beside
    the table, which takes its place when it is complete: if it fails, the former one stays.
    ``bucket_by`` deals a catalog table into ``buckets`` by those columns, one task each.
    """
    by = [*layout.partition_by, *layout.cluster_by]
    if bucket_by and ("/" in target or by):
        raise ValueError("only catalog tables without another layout have buckets")
    if bucket_by:
        df = df.repartition(buckets, *bucket_by)
    elif by and already_partitioned:
        df = df.sortWithinPartitions(*by)
    elif by:
        df = cluster(df, by, row_id, None if rows is None else file_count(rows, rows_per_file))
    writer = (
        df.write.format("parquet")
        .mode(mode)
        .option("compression", "zstd")
        .option("maxRecordsPerFile", rows_per_file)
    )
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    spark = df.sparkSession
    if mode != "overwrite":
        writer.save(target) if "/" in target else writer.saveAsTable(target)
    elif "/" in target:
        fresh = f"{target.rstrip('/')}__{uuid.uuid4().hex}"
        writer.save(fresh)
        _swap_folders(spark, fresh, target.rstrip("/"))
    else:
        fresh = f"{target}__{uuid.uuid4().hex}"
        # A place of its own, which stays the table's whatever its name will be.
        writer.option("path", _place_of(spark, fresh)).saveAsTable(fresh)
        _swap_tables(spark, fresh, target)


def _place_of(spark: SparkSession, name: str) -> str:
    """A folder for a new table, beside its database's others."""
    *database, table = name.split(".")
    found = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase())
    return f"{found.locationUri.rstrip('/')}/{table}"


def _location(spark: SparkSession, name: str) -> str:
    """Where a table's files are."""
    described = spark.sql(f"describe table extended {name}").collect()
    return next(r["data_type"] for r in described if r["col_name"] == "Location")


def _swap_folders(spark: SparkSession, fresh: str, target: str) -> None:
    """Put a complete folder in a former one's place; only then does the former one go."""
    jvm = spark.sparkContext._jvm
    new, place, former = (
        jvm.org.apache.hadoop.fs.Path(p) for p in (fresh, target, f"{fresh}_former")
    )
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = store.exists(place)
    if there and not store.rename(place, former):
        raise OSError(f"can't move {target}")
    if not store.rename(new, place):
        if there:
            store.rename(former, place)
        raise OSError(f"can't move {fresh} to {target}")
    if there:
        store.delete(former, True)


def _swap_tables(spark: SparkSession, fresh: str, target: str) -> None:
    """Give a complete table a former one's name; only then does the former one go."""
    if not spark.catalog.tableExists(target):
        spark.sql(f"alter table {fresh} rename to {target}")
        return
    former = f"{fresh}_former"
    spark.sql(f"alter table {target} rename to {former}")
    spark.sql(f"alter table {fresh} rename to {target}")
    place = _location(spark, former)
    spark.sql(f"drop table {former}")
    _delete(spark, place)


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that no table has any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.delete(place, True)


def save_declared(
    df: DataFrame,
    table: str,
    target: str,
    rows: int | None = None,
    mode: str = "overwrite",
    already_partitioned: bool = False,
) -> None:
    """Write a declared table in its layout."""
    save_table(
        df,
        target,
        LAYOUTS.get(table, Layout()),
        row_key(table),
        rows,
        mode,
        already_partitioned=already_partitioned,
    )


def replace_partitions(
    spark: SparkSession,
    df: DataFrame,
    target: str,
    layout: Layout,
    row_id: str,
    rows: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Put rows in place of those partitions of a saved table that they fall in.

    The other partitions keep their files.  The rows may come from the table itself: the new
    files are complete before an old one goes.  A partition that gets no row stays as it is.
    """
    if not layout.partition_by:
        raise ValueError("only partitions can be replaced, and the layout has none")
    by = [*layout.partition_by, *layout.cluster_by]
    ranged = cluster(df, by, row_id, None if rows is None else file_count(rows, rows_per_file))
    if "/" in target:
        (
            ranged.write.format("parquet")
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .option("maxRecordsPerFile", rows_per_file)
            .partitionBy(*layout.partition_by)
            .save(target)
        )
        return
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        ranged.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
    finally:
        spark.conf.set(name, before)
    spark.catalog.refreshTable(target)


def overlapping_partitions(saved: DataFrame, partition: str, column: str) -> list:
    """The partitions with files whose ranges of a column overlap by more than an end.

    One row per file is looked at, within its partition; at most one per partition comes back.
    The files of one clustered write don't overlap, those of an append lie across them.
    """
    files = saved.groupBy(partition, F.input_file_name().alias("_file")).agg(
        F.min(column).alias("_low"), F.max(column).alias("_high")
    )
    before = Window.partitionBy(partition).orderBy("_low", "_high")
    reached = F.max("_high").over(before.rowsBetween(Window.unboundedPreceding, -1))
    crossing = files.withColumn("_reached", reached).where(F.col("_low") < F.col("_reached"))
    return sorted(r[0] for r in crossing.select(partition).distinct().collect())


def recluster_appended(
    spark: SparkSession,
    target: str,
    layout: Layout,
    row_id: str,
    rows: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> list:
    """Cluster again those partitions of a saved table that appends have left overlapping.

    Returns them; the others keep their files.  The layout's first columns decide.
    """
    partition, column = layout.partition_by[0], layout.cluster_by[0]
    chosen = overlapping_partitions(read_table(spark, target), partition, column)
    if chosen:
        saved = read_table(spark, target).where(F.col(partition).isin(chosen))
        replace_partitions(spark, saved, target, layout, row_id, rows, rows_per_file)
    return chosen


def recluster(
    spark: SparkSession,
    source: str,
    target: str,
    by: Sequence[str],
    row_id: str,
    rows: int,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Rewrite a saved table along the interleaved key of ``by``."""
    files = file_count(rows, rows_per_file)
    save_table(zorder(read_table(spark, source), by, row_id, files), target)


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """Read back what ``save_table`` wrote."""
    return spark.read.parquet(target) if "/" in target else spark.table(target)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder every executor can reach, for tables written on the way.

    The cluster names the shared folder in ``spark.checkpoint.dir``.  Only a local session
    without one gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="ledgerweave-")
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def scratch_table(name: str) -> str:
    """A catalog name that no other job uses, for tables written on the way."""
    return f"{name}_{uuid.uuid4().hex}"


def _cell(value: Column, bounds: Sequence, cells: int) -> Column:
    """The cell of a value by how many of the bounds lie at or below it; null counts as lowest.

    Columns with fewer values than cells are spread over all of them, so that they weigh as
    much in the interleaved key as others.
    """
    if not bounds:
        return F.lit(0).cast("bigint")
    spread = F.floor(_passed(value, bounds) * F.lit(cells) / F.lit(len(bounds) + 1))
    return F.when(value.isNull(), 0).otherwise(spread).cast("bigint")


def _passed(value: Column, bounds: Sequence, before: int = 0) -> Column:
    """How many of the ascending bounds lie at or below a value, by halving, and ``before``."""
    if not bounds:
        return F.lit(before)
    half = len(bounds) // 2
    lower, upper = bounds[:half], bounds[half + 1 :]
    below = value < F.lit(bounds[half])
    return F.when(below, _passed(value, lower, before)).otherwise(
        _passed(value, upper, before + half + 1)
    )
