"""Databases and named tables in the session catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewell.sinks.files import counted


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"USE {name}")


def current_namespace(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT current_catalog() AS catalog, current_schema() AS database")


def ensure_named_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty managed table with a declared schema unless there is one already."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, source="parquet", schema=schema)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def save_managed(df: DataFrame, name: str) -> int:
    """Replace the managed table ``name``; rows written."""
    return counted(df, lambda d: d.write.mode("overwrite").format("parquet").saveAsTable(name))["n_rows"]


def register_folder(
    spark: SparkSession, name: str, path: str, partition_by: Sequence[str] = ()
) -> None:
    """Give an existing Parquet folder a name; its partition folders are picked up."""
    spark.catalog.createTable(name, path=path, source="parquet")
    if partition_by:
        spark.catalog.recoverPartitions(name)


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")
