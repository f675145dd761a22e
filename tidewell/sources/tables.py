"""Table readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import path_exists


def read_path(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A Parquet folder. ``merge_schema`` shows columns that later appends brought in."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_named(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table with a declared schema unless there is one already."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def row_position() -> list[Column]:
    """Where a row is stored (file, row in file): unique, and the same when a task is retried.

    Only for a DataFrame that reads Parquet files directly.
    """
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    ]
