"""How tables lie on storage: order, narrow copies, small files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.ranking import number_copies


#: Size that a file should have.
TARGET_BYTES = 128 * 1024 * 1024


def write_ordered(
    df: DataFrame,
    path: str,
    order_by: Sequence[str],
    spread_by: Sequence[str] = (),
    compression: str = "snappy",
    unique: bool = True,
) -> DataFrame:
    """Write a table ordered by key, so that min/max statistics skip row groups.

    ``spread_by`` adds columns to the range key: rows that share one frequent
    key then lie in several files rather than in one.  If even all columns may
    repeat, ``unique=False`` spreads the copies by a number per copy.
    """
    key, rows = [*order_by, *spread_by], df
    if not unique:
        rows, key = number_copies(df, "__copy"), [*key, "__copy"]
    ordered = rows.repartitionByRange(*key).sortWithinPartitions(*key)
    ordered.select(*df.columns).write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int
) -> DataFrame:
    """Write a table in hash buckets of the key; joins on it need no shuffle."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        df.repartition(buckets, *keys)
        .write.format("parquet")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )
    return spark.table(table)


def covering_extract(
    df: DataFrame,
    key: Sequence[str],
    included: Sequence[str],
    path: str,
    where: Column | None = None,
    unique: bool = True,
) -> DataFrame:
    """A narrow copy, ordered by key: key and included columns, maybe filtered.

    Pass ``unique=False`` if the narrow rows repeat.
    """
    narrow = (df if where is None else df.filter(where)).select(*key, *included)
    return write_ordered(narrow, path, key, included, unique=unique)


def file_sizes(df: DataFrame, partition: str) -> DataFrame:
    """Files behind a table: partition value, path, bytes and rows."""
    return (
        df.select(
            partition,
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("bytes"),
        )
        .groupBy(partition, "file", "bytes")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


# Thresholds of the maintenance decision.
MIN_FILES = 8
LIGHT_PERCENT = 20
REBUILD_PERCENT = 40


def layout_report(
    df: DataFrame, partition: str, target_bytes: int = TARGET_BYTES
) -> DataFrame:
    """Share of undersized files per partition, and what to do about it.

    A partition is worth a look with more than 8 files of which more than 20 %
    are smaller than half the target; above 40 % it is rebuilt.
    """
    small = F.col("bytes") < F.lit(target_bytes / 2)
    summary = (
        file_sizes(df, partition)
        .groupBy(partition)
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("bytes").alias("total_bytes"),
            F.sum("n_rows").alias("n_rows"),
            (F.count_if(small) * 100 / F.count(F.lit(1))).alias("small_percent"),
        )
    )
    listed = (F.col("n_files") > MIN_FILES) & (F.col("small_percent") > LIGHT_PERCENT)
    return summary.withColumn(
        "action",
        F.when(~listed, "keep")
        .when(F.col("small_percent") <= REBUILD_PERCENT, "merge")
        .otherwise("rebuild"),
    )


@contextmanager
def unsorted_files(spark: SparkSession) -> Iterator[None]:
    """Inside, a task writes the rows of its first partition value as they come.

    Otherwise a write by partition sorts each task's rows by that value first, and so
    holds all rows of a file in memory.  A task that meets another value still does
    from there on.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(max(1, int(before or 0))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def dealt_pieces(
    df: DataFrame, partition: str, listed: Sequence[tuple], schema
) -> DataFrame:
    """The rows of the listed partitions, each cut into its number of pieces.

    ``listed`` has a partition value and its pieces per row, at most one per directory, and
    ``schema`` the type of the value first.  A row's piece goes by its place in its file:
    pieces are even whatever the rows hold, and a task that runs again gets the same rows.
    Every piece has a task of its own.
    """
    firsts, needed = [], 0
    for value, files in listed:
        firsts.append((value, files, needed))
        needed += files
    kind = schema[0].dataType.simpleString()
    todo = df.sparkSession.createDataFrame(firsts, f"__value {kind}, __files long, __first long")
    values = [value for value, _ in listed]
    key = F.col(partition)
    wanted = key.isin([v for v in values if v is not None])
    if None in values:
        wanted = wanted | key.isNull()
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    pieces = df.filter(wanted).select("*", place.alias("__place")).join(
        F.broadcast(todo), key.eqNullSafe(F.col("__value"))
    )
    piece = (F.col("__first") + F.pmod("__place", "__files")).cast("int")
    return (
        pieces.select(*df.columns, piece.alias("__piece"))
        .repartitionById(needed, "__piece")
        .select(*df.columns)
    )


def target_pieces(
    df: DataFrame, partition: str, listed: list, schema, target_bytes: int
) -> DataFrame:
    """The rows of the listed partitions, dealt so that each has files of target size.

    ``listed`` has a partition value and its bytes per row.  A partition is cut into as
    many pieces as it needs files.
    """
    files = [
        (row[partition], int(max(1, -(-row["total_bytes"] // target_bytes)))) for row in listed
    ]
    return dealt_pieces(df, partition, files, schema)


def compact(
    df: DataFrame, path: str, partition: str, target_bytes: int = TARGET_BYTES
) -> list:
    """Rewrite the listed partitions of a table in files of about the target size.

    Other partitions are not read.  The new files are written next to the table and
    only then take the place of the old ones, so a rewrite that dies leaves the table
    as it was; ``VersionedTable.compact`` also keeps the old files for open readers.
    Returns the partition values that were rewritten, at most one per directory.
    """
    report = layout_report(df, partition, target_bytes).filter(F.col("action") != "keep")
    todo = report.select(partition, "total_bytes")
    listed = todo.collect()
    if not listed:
        return []
    spark, fresh = df.sparkSession, f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    pieces = target_pieces(df, partition, listed, todo.schema, target_bytes)
    with unsorted_files(spark):
        pieces.write.partitionBy(partition).parquet(fresh)
    # The files exist in full now; moving the folders reads and writes no row.
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(fs_path(fresh)):
        name = status.getPath().getName()
        if "=" in name:
            old = fs_path(f"{path}/{name}")
            fs.delete(old, True)
            fs.rename(status.getPath(), old)
    fs.delete(fs_path(fresh), True)
    return [row[partition] for row in listed]
