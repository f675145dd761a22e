"""How a table's files are laid out."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.stored import folder_of, read_stored, replace_partitions
from tidewell.session import path_bytes
from tidewell.sinks import recover
from tidewell.sources import row_position

FILE_BYTES = 256 * 1024**2
#: Rows that one task sorts, as they lie in memory; compressed in a file they may be a tenth of that.
SORT_BYTES = 256 * 1024**2
_FIXED = (T.NumericType, T.BooleanType, T.DatetimeType)


def partition_inventory(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows per partition value."""
    return df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n_rows"))


def file_inventory(spark: SparkSession, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Files, bytes and rows per partition folder (the whole table without ``partition_by``)."""
    per_file = (
        spark.read.parquet(path)
        .select(*partition_by, "_metadata.file_path", "_metadata.file_size")
        .groupBy(*partition_by, "file_path")
        .agg(F.max("file_size").alias("size"), F.count(F.lit(1)).alias("n"))
    )
    return per_file.groupBy(*partition_by).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("size").alias("n_bytes"),
        F.sum("n").alias("n_rows"),
    )


def compact(spark: SparkSession, path: str, target: str, partition_by: Sequence[str] = ()) -> None:
    """Rewrite a table with small files as one with few, at a new path.

    Spark brings each partition's rows together, cuts what is over the advisory
    size and joins what is under it, so a large partition still gets many tasks.
    """
    rows = spark.read.option("mergeSchema", True).parquet(path)
    writer = rows.hint("rebalance", *partition_by).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)


def compact_small(
    spark: SparkSession, path: str, partition_by: Sequence[str], file_bytes: int = FILE_BYTES
) -> int:
    """Rewrite, in place, only the partition folders with twice the files they need; how many those are.

    Their new files are complete beside the table before the old ones go. A folder of the right files
    is neither read nor written.
    """
    recover(spark, path)
    depth = len(partition_by)
    per_file = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
    needed = F.ceil(F.sum("file_size") / file_bytes).alias("needed")
    per_folder = per_file.groupBy(folder_of("file_path", depth).alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"), needed
    )
    small = [(r.folder, r.needed) for r in per_folder.filter(F.col("n_files") >= 2 * F.col("needed")).collect()]
    if not small:
        return 0
    folders = [unquote(folder) for folder, _ in small]
    rows = read_stored(spark, path, folders=folders)
    columns = rows.columns
    wanted = spark.createDataFrame(small, "_folder string, _files long")
    placed = rows.select("*", *row_position()).withColumn("_folder", folder_of("_file", depth)).join(wanted, "_folder")
    # At most `_files` tasks hold rows of one folder.
    slot = F.pmod(F.xxhash64("_file", "_row"), F.col("_files"))
    placed = placed.withColumn("_slot", slot).repartition(*partition_by, "_slot").select(*columns)
    replace_partitions(placed, path, partition_by, folders, place=False)
    return len(folders)


def _held_bytes(rows: DataFrame) -> int:
    """About the memory that sorting all rows takes: some 48 bytes each, 8 a value, and what has no fixed size."""
    sizes = [F.count(F.lit(1)) * (48 + 8 * len(rows.columns))]
    for field in rows.schema.fields:
        if not isinstance(field.dataType, _FIXED):
            sizes.append(F.coalesce(F.sum(F.octet_length(F.col(field.name).cast("string"))), F.lit(0)))
    return rows.agg(reduce(Column.__add__, sizes)).first()[0]


def cluster(
    spark: SparkSession,
    path: str,
    target: str,
    column: str,
    partition_by: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
) -> None:
    """Rewrite a table so that each file, of about ``file_bytes`` at most, covers a narrow range of ``column``.

    A scan for one value then skips most files by their minimum and maximum.
    A file is sorted by one task. Where rows are packed tightly, so that a file
    would hold more than about ``SORT_BYTES`` of them, there are more files.
    The row's place in the old files is part of the range key: a value that
    holds much of the table is cut over several tasks, and a task that is run
    again sends each row where it went before.
    """
    rows = spark.read.option("mergeSchema", True).parquet(path)
    columns = rows.columns
    n_files = max(1, math.ceil(path_bytes(spark, path) / file_bytes), math.ceil(_held_bytes(rows) / SORT_BYTES))
    placed: list[Column | str] = [*partition_by, column, "_file", "_row"]
    laid_out = (
        rows.select("*", *row_position())
        .withColumn("_file", F.xxhash64("_file"))
        .repartitionByRange(n_files, *placed)
        .select(*columns)
        .sortWithinPartitions(*partition_by, column)
    )
    writer = laid_out.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
